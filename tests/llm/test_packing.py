import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexmill.llm import packing

SCHEMA = "doc_id long, text string, length long, ids string, nth int"


@pytest.fixture(scope="module")
def tokenizer():
    return packing._tokenizer(packing.TOKENIZER)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=120), st.sampled_from([60, 61, 100]))
def test_plan_uses_every_piece_once(lengths, capacity):
    counts, used = Counter(lengths), Counter()
    bins = 0
    for number, pattern in packing.plan_bins(counts, capacity):
        assert number > 0 and pattern and sum(n * times for n, times in pattern) <= capacity
        assert sum(times for n, times in pattern if 3 * n > capacity) <= 2
        bins += number
        for n, times in pattern:
            used[n] += number * times
    assert used == counts
    assert bins <= 1.5 * -(-sum(lengths) // capacity) + 1


def test_plan_size_depends_on_the_capacity_alone():
    few = packing.plan_bins({n: 3 for n in range(1, 2049)})
    many = packing.plan_bins({n: 3_000_000 for n in range(1, 2049)})
    assert len(many) < 3 * 2048 and len(few) < 3 * 2048


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("aéÉßΑΣς'́ \t\n\x0b\x1c\x85.,’s19|<>#_-İK字½²A")), max_size=40), st.sampled_from(["", "<|endoftext|>", " it's. <|ENDOFTEXT|>", "a<|endoftext|>."]))
def test_ids_of_words_are_ids_of_the_text(text, more):
    tokenizer = packing._tokenizer(packing.TOKENIZER) if not hasattr(packing, "_kept") else packing._kept
    packing._kept = tokenizer
    text += more
    encoder, out = packing.WordEncoder(tokenizer), b""
    for part in packing.slices(text, 9):
        words = packing.words_of(part)
        encoder.add(set(words))
        out += encoder.ids(words)
    assert np.frombuffer(out, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def rows_for(n, seed=3):
    r = random.Random(seed)
    words = ["the", "nation", "Straße", "été,", "x1", "anbleinnd.", "###"]
    rows = [(i, " ".join(r.choices(words, k=int(r.paretovariate(0.9) * 20) % 4000))) for i in range(n)]
    return rows + [(n, None), (n + 1, ""), (n + 2, " \n"), (n + 3, "w " * 30_000), (n + 4, "the " * 2047), (n + 5, "the " * 2048), (5, rows[5][1]), (None, "no id")]


@pytest.mark.parametrize("capacity", [64, 2048])
def test_pack_against_the_tokenizer(spark, tokenizer, capacity):
    rows = rows_for(60)
    df = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], SCHEMA).repartition(5)
    got = packing.pack(df, capacity=capacity, with_ids=True).collect()
    want = []
    for i, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for n, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at : at + capacity], "<u4").tobytes()
            want.append((i, n, at, len(part) // 4, zlib.crc32(part), part))
    assert sorted(map(repr, ((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], bytes(r["ids"])) for r in got))) == sorted(map(repr, want))
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r["length"] for r in got)
    assert len(bins) <= 1.12 * -(-total // capacity) + 1


def test_sequences_hold_the_ids_in_order(spark):
    df = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows_for(20)], SCHEMA)
    packed = packing.pack(df, capacity=128, with_ids=True)
    rows = packed.collect()
    for s in packing.sequences(packed).collect():
        parts = sorted((r["offset"], bytes(r["ids"])) for r in rows if r["sequence_id"] == s["sequence_id"])
        assert bytes(s["ids"]) == b"".join(p for _, p in parts) and s["length"] * 4 == len(s["ids"])


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA)).count() == 0


def test_known_words_of_a_slice_stay_when_memory_is_full(monkeypatch):
    """Beyond the limit only words that the slice does not have are forgotten, and ids do not change."""
    monkeypatch.setattr(packing, "CACHED_BYTES", 1)
    tokenizer = packing._tokenizer(packing.TOKENIZER)
    known = packing.WordEncoder(tokenizer)
    known.add({b"nation", b"shall", b"gone!"})
    learned = []
    known.merge = lambda text: learned.append(text) or tokenizer.model.tokenize(text)
    known.add({b"nation", b"shall", b"other", b"more..."})
    assert sorted(learned) == ["more", "other"] and b"gone!" not in known
    for words in ([b"nation", b"shall"], [b"other", b"more..."]):
        want = tokenizer.encode(b" ".join(words).decode(), add_special_tokens=False).ids
        assert np.frombuffer(known.ids(words), np.uint32).tolist() == want
    assert known.size == known.bytes_of(known)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | st.text(st.sampled_from(list("aéÉßΑΣς'́ \t\n\x0b\x1c\x85.,’s19|<>#_-İK字½²A")), max_size=30) | st.sampled_from(["a<|endoftext|>.", " it's. <|ENDOFTEXT|>", "w " * 40, "x" * 70]), max_size=8))
def test_ids_of_texts_are_those_of_the_tokenizer(texts):
    tokenizer = packing._tokenizer(packing.TOKENIZER) if not hasattr(packing, "_kept") else packing._kept
    packing._kept = tokenizer
    known = packing.WordEncoder(tokenizer)
    column = pa.array([None, *texts, ""], pa.string())[1:]  # a slice with an offset
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(packing, "SLICE_CHARS", 64)
        got = packing.ids_of_texts(column, known)
        apart = [g is None for g in got]
        got = [b"".join(packing.ids_in_parts(t, known)) if g is None else g for t, g in zip([*texts, ""], got, strict=True)]
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in [*texts, ""]]
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == want
    assert apart == ["<|" in (t or "") or len((t or "").encode()) > 64 for t in [*texts, ""]]


def test_a_text_is_not_split_into_words_one_by_one(tokenizer, monkeypatch):
    """Only texts that go in parts are split in Python; the words of the rest are told apart before they are looked up."""
    asked = []

    class Known(packing.WordEncoder):
        def __getitem__(self, word):
            asked.append(word)
            return super().__getitem__(word)

    monkeypatch.setattr(packing, "words_of", lambda text: pytest.fail("split in Python"))
    known = Known(tokenizer)
    known.add({b"nation", b"shall"})
    asked.clear()
    packing.ids_of_texts(pa.array(["nation shall " * 500, "shall nation " * 500]), known)
    assert len(asked) <= 4

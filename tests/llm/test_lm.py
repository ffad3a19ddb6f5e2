import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.llm import lm

SCHEMA = "doc_id long, text string, lang string, score double, word string, c0 long"
FIRST, INNER = [b"th", b"a", b"the", "é".encode()], [b"e", b"re", b"ere", b"r", b"tion", b"ion"]


def readings(word, first, inner):
    """Every way to read a word, as lists of weights."""
    if not word:
        yield [inner[None]]
        return

    def after(at):
        if at == len(word):
            yield [inner[None]]
        for to in range(at + 1, len(word) + 1):
            if word[at:to] in inner:
                for rest in after(to):
                    yield [inner[word[at:to]], *rest]

    for to in range(1, len(word) + 1):
        if word[:to] in first:
            for rest in after(to):
                yield [first[word[:to]], *rest]


def tables(lattice, k=0):
    a, b = lattice.weights[k]
    first = dict(zip(lattice.first.pieces, a, strict=True))
    inner = dict(zip([*lattice.inner.pieces, None], b, strict=True))
    return first, inner


@pytest.mark.parametrize("word", ["there", "thetion", "a", "ére", "reth", "aaaa"])
def test_forward_sums_all_readings(word):
    lattice, data = lm.Lattice.of(FIRST, INNER, 2), word.encode()
    first, inner = tables(lattice)
    every = [sum(x) for x in readings(data, first, inner)]
    got = lattice.log_probability(np.frombuffer(data, np.uint8)[None, :])
    assert got.shape == (1, 2) and got[0, 0] == pytest.approx(np.logaddexp.reduce(every))
    a, b = lattice.expected(np.frombuffer(data, np.uint8)[None, :])
    assert a.sum() == pytest.approx(1) and b[-1] == pytest.approx(1)
    share = [math.exp(x - got[0, 0]) for x in every]
    longest = sum(p * (len(r) - 2) for p, r in zip(share, readings(data, first, inner), strict=True))
    assert b[:-1].sum() == pytest.approx(longest)


@pytest.mark.parametrize("size", [1024, 1151, 1152, 1153, 3000])
def test_stretches_of_a_long_word_equal_one_pass(monkeypatch, size):
    r, lattice = random.Random(size), lm.Lattice.of(FIRST, INNER, 2)
    lattice.weights[1] = lattice.normal(*(np.arange(1.0, len(w) + 1) for w in lattice.weights[1]))
    words = [b"".join(r.choice([b"th", b"a", b"ere", b"tion", b"x", b"\xff", b"e"]) for _ in range(size))[:size] for _ in range(2)]
    data = np.frombuffer(b"".join(words), np.uint8).reshape(2, size)
    got = [lattice.log_probability(data), *lattice.expected(data, 1)]
    monkeypatch.setattr(lm, "LONG", size + 1)
    for x, y in zip(got, [lattice.log_probability(data), *lattice.expected(data, 1)], strict=True):
        assert np.allclose(x, y)


def test_a_word_of_a_megabyte():
    lattice = lm.Lattice.of(*lm.vocabulary(), 2)
    word = np.frombuffer(("the nation " * 100_000).replace(" ", "").encode()[: 1 << 20], np.uint8)[None, :]
    short = lattice.log_probability(word[:, :900])
    assert lattice.log_probability(word)[0, 0] / word.size == pytest.approx(short[0, 0] / 900, rel=0.01)
    first, inner = lattice.expected(word)
    assert first.sum() == pytest.approx(1) and inner[-1] == 1 and word.size / lattice.inner.longest < inner.sum() < word.size


def test_weights_are_distributions():
    lattice = lm.Lattice.of(*lm.vocabulary())
    for w in lattice.weights[0]:
        assert np.exp(w).sum() == pytest.approx(1)
    assert len(lattice.first.pieces) > 5000 and len(lattice.inner.pieces) > 5000


def test_piece_table_finds_exactly_its_pieces():
    table = lm.PieceTable([b"abc", b"bc", b"abcd"])
    words = [b"abc", b"abd", b"a", b"abcd", b"bc", b"zz"]
    for w in words:
        n = int(table.find(lm._hash(np.frombuffer(w, np.uint8)[None, :])[:, -1])[0])
        assert (table.pieces[n] if n < len(table.pieces) else None) == (w if w in table.pieces else None)


def rows_for(seed, n=120):
    r = random.Random(seed)
    words = {"en": ["the", "there", "with", "nation"], "fr": ["été", "nation", "où", "leçon"]}
    rows = []
    for i in range(n):
        lang = r.choice(["en", "fr"])
        rows.append((i, " ".join(r.choice([*words[lang], f"{r.choice(words[lang])}{r.randrange(9)}"]) for _ in range(r.randint(1, 30))), lang))
    return rows + [(n, None, "en"), (n + 1, "", None), (n + 2, " \t", "en"), (n + 3, "The\x1cTHE the", None), (n + 4, "x" * 5000, "xx"),
                   (n + 5, "the " * 40_000, "en"), (n + 5, "the " * 40_000, "en"), (None, "no id", "en")]


def plain(rows):
    """Base score and counts by dictionary."""
    import re

    split = [[w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w] + [None] for _, t, _ in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _, _ in rows]
    counts = Counter(w for words, h in zip(split, held, strict=True) if not h for w in words)
    total, distinct = sum(counts.values()), len(counts)
    return [
        (i, h, len(words), sum(counts[w] > 0 for w in words), total, sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words))
        for (i, _, _), words, h in zip(rows, split, held, strict=True)
    ]


def scores(spark, rows, **options):
    df = spark.createDataFrame([(*r, 0.5, "w", 1) for r in rows], SCHEMA).repartition(4)
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2
    return lm.lattice_scores(df, held, rounds=1, **options).collect()


@pytest.mark.parametrize("blocks", [None, 300])
def test_counts_and_base_score(spark, monkeypatch, blocks):
    if blocks:
        monkeypatch.setattr(lm, "BLOCK_BYTES", blocks)
    rows = rows_for(1)
    got = scores(spark, rows, class_col="lang")
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    for r, want in zip(sorted(map(tuple, got), key=key), sorted(plain(rows), key=key), strict=True):
        assert r[:5] == want[:5]
        assert r[5] == pytest.approx(want[5]) and r[6] < 0 and math.isfinite(r[6])


def plain_scores(rows, rounds):
    """Every reading of every word listed; counts by dictionary; natural logs turned to base ten at the end."""
    split = [[*(t or "").lower().encode().split(), None] for _, t, _ in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _, _ in rows]
    langs = sorted({lang for (_, _, lang), h in zip(rows, held, strict=True) if not h})
    counts = {k: Counter(w for words, (_, _, c), h in zip(split, rows, held, strict=True) if c == k and not h for w in words) for k in langs}
    everywhere, total = sum(counts.values(), Counter()), sum(sum(c.values()) for c in counts.values())
    lattice = lm.Lattice.of(FIRST, INNER, 1)
    start, values = tables(lattice), {}
    for k in langs:
        first, inner = start
        for _ in range(rounds):
            uses = [dict.fromkeys(first, 0.01), dict.fromkeys(inner, 0.01)]
            for w in set(counts[k]) - {None}:
                every = [[0] + [m for m in range(1, len(w)) if mask >> m & 1] + [len(w)] for mask in range(0, 1 << len(w), 2)]
                every = [[w[a:b] for a, b in zip(cut, cut[1:], strict=False)] for cut in every]
                every = [c for c in every if c[0] in first and all(p in inner for p in c[1:])]
                weight = [math.exp(first[c[0]] + sum(inner[p] for p in c[1:]) + inner[None]) for c in every]
                for c, x in zip(every, weight, strict=True):
                    uses[0][c[0]] += x / sum(weight)
                    for p in [*c[1:], None]:
                        uses[1][p] += x / sum(weight)
            first, inner = ({p: math.log(x / sum(u.values())) for p, x in u.items()} for u in uses)
        c, size = counts[k], sum(counts[k].values())
        once, twice = (sum(v == n for w, v in c.items() if w is not None) for n in (1, 2))
        off = once / (once + 2 * twice) if once else 0.5
        escape = (off * len(c) + 1) / (size + 1)

        def token(w, c=c, size=size, off=off, escape=escape, first=first, inner=inner):
            spelled = lm.END_SHARE if w is None else (1 - lm.ANYWHERE - lm.END_SHARE) * sum(math.exp(sum(x)) for x in readings(w, first, inner))
            return max(c[w] - off, 0) / (size + 1) + escape * (lm.ANYWHERE * everywhere[w] / total + spelled)

        share = (c[None] + 1) / sum(n[None] + 1 for n in counts.values())
        for i, words in enumerate(split):
            values.setdefault(i, []).append(math.log(share) + sum(math.log(token(w)) for w in words))
    return [np.logaddexp.reduce(values[i]) / math.log(10) for i in range(len(rows))]


@pytest.mark.parametrize("part_bytes", [None, 50])
def test_scores_against_a_plain_version(spark, monkeypatch, part_bytes):
    if part_bytes:
        monkeypatch.setattr(lm, "PART_BYTES", part_bytes)
    monkeypatch.setattr(lm, "vocabulary", lambda path: (FIRST, INNER))
    r, words = random.Random(5), {"en": ["the", "there", "a", "nation"], "fr": ["été", "rere", "thé"]}
    rows = [(i, " ".join(r.choice([*words[c], f"a{r.randrange(9)}"]) for _ in range(r.randint(0, 9))), c) for i in range(60) for c in [r.choice(["en", "fr"])]]
    got = {x["doc_id"]: x["score"] for x in scores(spark, rows, class_col="lang")}
    assert [got[i] for i in range(60)] == pytest.approx(plain_scores(rows, 1), rel=1e-5)


def test_classes_help_on_unseen_texts(spark):
    rows = rows_for(2, 300)
    one, two = scores(spark, rows), scores(spark, rows, class_col="lang")
    assert sum(r["score"] for r in two if r["held_out"]) > sum(r["score"] for r in one if r["held_out"])


def test_token_probabilities_sum_to_one_at_most():
    """Seen words, the end and a word of each kind never take more than everything."""
    model = lm.TokenModel(np.array([10.0, 7.0]), np.array([4.0, 3.0]), np.array([0.5, 0.5]), np.array([2.0, 1.0]))
    counts = np.array([[5.0, 0.0], [2.0, 4.0], [1.0, 2.0]])
    sure = np.exp(model.tokens(counts, np.log(np.full((3, 2), 0.3)))).sum(axis=0) + np.exp(model.end())
    assert (sure <= 1 + 1e-9).all()


def test_no_training_rows_and_no_rows(spark):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    got = scores(spark, [(i, "the nation", "en") for i in held], class_col="lang")
    assert [(r["n_known"], r["train_tokens"]) for r in got] == [(0, 0)] * 3 and all(math.isfinite(r["score"]) for r in got)
    assert scores(spark, []) == []

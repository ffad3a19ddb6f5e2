"""The stages one by one against plain versions, on small tables made for them."""

import os
import random
import re

import pytest

import corpus_pipeline
from lexmill.llm import langid, packing, queries

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language id", "exact dedup", "near dedup", "mix sources", "pack"]


@pytest.fixture(scope="module")
def small_training(spark):
    keep = langid.fit.__defaults__
    langid.fit.__defaults__ = (*keep[:-1], langid.Options(docs_per_language=60, steps=80, batch=128))
    yield
    langid.fit.__defaults__ = keep


def docs(spark):
    r = random.Random(0)
    words = {"en": "the and with shall through nation".split(), "de": "und größe nicht über schön".split()}
    rows = []
    for i in range(200):
        lang = r.choice(["en", "de"])
        rows.append((i, " ".join(f"{r.choice(words[lang])}" for _ in range(r.randint(8, 80))), lang, f"src{i % 4}", 1))
    copies = [(300 + i, rows[5][1].replace(" ", "  "), rows[5][2], "src0", 1) for i in range(40)]
    near = [(400 + i, rows[6][1] + " nation" * (i % 2), rows[6][2], "src1", 1) for i in range(10)]
    junk = [(500, None, "en", None, None), (501, "", "en", "src9", 0), (502, "12 3 -- 4", None, None, 1), (5, rows[5][1], "en", None, 1), (None, rows[7][1], "de", "src2", 1)]
    return spark.createDataFrame(rows + copies + near + junk, SCHEMA)


def five_word_runs(text):
    words = re.sub("[A-Z]", lambda m: m[0].lower(), text).split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_every_stage_on_what_the_one_before_left(spark, tmp_path, small_training):
    table = docs(spark)
    table.write.parquet(f"{tmp_path}/documents.parquet")
    before = table.collect()
    state = table
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, state, str(tmp_path))
        if name != "pack":
            assert out.columns == table.columns
        out.write.parquet(f"{tmp_path}/{name}")
        state = spark.read.parquet(f"{tmp_path}/{name}")
        after = state.collect()
        if name == "language id":
            named = [r for r in before if r["text"] and any(c.isalpha() for c in r["text"])]
            assert sorted(map(repr, after)) == sorted(map(repr, named))
        if name == "exact dedup":
            best = {}
            for r in before:
                key = re.sub(r"[\x20\x09-\x0D]", "", r["text"])
                order = (-len(r["text"]), r["doc_id"] is None, r["doc_id"] or 0)
                best[key] = min(best.get(key, order), order)
            assert sorted((-len(r["text"]), r["doc_id"] is None, r["doc_id"] or 0) for r in after) == sorted(best.values())
        if name == "near dedup":
            sets = {r["doc_id"]: five_word_runs(r["text"]) for r in before if r["doc_id"] is not None}
            label = {i: i for i in sets}
            for _ in range(len(sets)):
                new = {i: min(label[j] for j in sets if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])) for i in sets}
                if new == label:
                    break
                label = new
            assert sorted(r["doc_id"] for r in after if r["doc_id"] is not None) == sorted(set(label.values()))
        if name == "mix sources":
            assert {repr(r) for r in after} <= {repr(r) for r in before} and len(after) > len(before) / 2
        if name == "pack":
            tokenizer = packing._tokenizer(packing.TOKENIZER)
            want = sorted((r["doc_id"] is None, r["doc_id"] or 0, len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1) for r in before)
            assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["length"]) for r in after) == want
        before = after


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver tables are absent")
def test_run_is_the_stages_in_order(spark, small_training):
    got = corpus_pipeline.run(spark, SMALL)
    rows = got.collect()
    assert rows and got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert all(sum(n for _, n in parts) <= 2048 for parts in bins.values())


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES])
def test_stages_of_an_empty_table(spark, tmp_path, stage):
    empty = spark.createDataFrame([], SCHEMA)
    assert stage(spark, empty, str(tmp_path)).count() == 0


def test_each_operator_has_a_query():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))

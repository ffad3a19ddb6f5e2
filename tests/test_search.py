"""The inverted index against a plain scan, and what a search reads."""

import random
from collections import Counter

import pytest

from lexmill.operators import search, words

WORDS = ["budget", "annexe", "loi", "décret", "santé", "école"] + [f"mot{c}" for c in "abcdefghij"]


def corpus():
    r = random.Random(4)
    weights = [2 ** -(i / 2) for i in range(len(WORDS))]
    rows = [(i, " ".join(r.choices(WORDS, weights, k=r.randint(0, 30)))) for i in range(500)]
    return rows + [(1000, None), (1001, ""), (1002, "xy z"), (None, "budget"), (1003, "budget " * 5000), (1004, "BUDGET, Loi;budget"), (1005, rows[3][1])]


def plain(rows, asked, k):
    counts = {i: Counter(w for w in (t or "").lower().replace(",", " ").replace(";", " ").split() if len(w) >= 3) for i, t in rows if i is not None}
    df = Counter(w for c in counts.values() for w in c)
    weight = {w: search.word_weight(len(counts), df[w]) for w in asked if df[w]}
    scores = {i: sum(weight[w] * (1000 * c[w] // (c[w] + 1)) for w in weight if c[w]) for i, c in counts.items()}
    return sorted(((i, s) for i, s in scores.items() if s), key=lambda x: (-x[1], x[0]))[:k]


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("index"))
    search.build_index(spark.createDataFrame(corpus(), "doc long, text string"), "doc", root, docs_per_block=20)
    return root


@pytest.mark.parametrize(("asked", "k", "first"), [("budget", 10, 2), ("Budget LOI motj", 25, 1), ("école motb école", 3, 8), ("loi", 1000, 2), ("nulle part", 5, 2), ("au", 5, 2)])
def test_against_a_plain_scan(spark, root, asked, k, first):
    got = [(r["id"], r["score"]) for r in search.search(spark, root, asked, k, first_blocks=first).collect()]
    assert got == plain(corpus(), {w for w in asked.lower().split() if len(w) >= 3}, k)


def test_only_postings_of_the_words_are_read(spark, root):
    rows = search.postings_of(spark, root, ["budget"])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    assert "In(word" in plan or "EqualTo(word" in plan
    assert {r["word"] for r in rows.collect()} == {"budget"}
    assert max(len(r["postings"]) for r in rows.collect()) < 60  # a common word is many bounded rows


def test_an_empty_table(spark, tmp_path):
    search.build_index(spark.createDataFrame([], "doc long, text string"), "doc", f"{tmp_path}/i")
    assert search.search(spark, f"{tmp_path}/i", "budget").count() == 0


def test_top_words_need_no_exchange(spark):
    df = spark.createDataFrame(corpus(), "doc long, text string")
    top = words.document_top_words(df, "doc", 3)
    assert "Exchange" not in top._jdf.queryExecution().executedPlan().toString()
    want = []
    for i, t in corpus():
        c = Counter(w for w in (t or "").lower().replace(",", " ").replace(";", " ").split() if len(w) >= 3)
        want += [(i, w, n, p) for p, (w, n) in enumerate(sorted(c.items(), key=lambda x: (-x[1], x[0]))[:3], 1)]
    assert sorted(map(tuple, top.collect()), key=repr) == sorted(want, key=repr)


def test_blocks_are_folded_where_their_texts_are(spark, monkeypatch):
    rows = [(f"d{i}", t) for i, t in corpus() if i is not None]
    counted = words.counted_words(spark.createDataFrame(rows, "id string, text string").repartition(3), "id")
    folded = search.block_postings(counted, docs_per_block=20)
    plan = folded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1  # the repartition above; the words do not move
    want = sorted((w, f"d{i}", n) for i, t in corpus() if i is not None for w, n in Counter(x for x in (t or "").lower().replace(",", " ").replace(";", " ").split() if len(x) >= 3).items())
    for limit in (search.WORDS_PER_BLOCK, 25, 1):  # the last: one text with words a block
        monkeypatch.setattr(search, "WORDS_PER_BLOCK", limit)
        got = search.block_postings(counted, docs_per_block=20).collect()
        assert len({(r["word"], r["block"]) for r in got}) == len(got)
        assert sorted((r["word"], p["id"], p["n"]) for r in got for p in r["postings"]) == want
        docs = {}
        for r in got:
            assert [p["n"] for p in r["postings"]] == sorted((p["n"] for p in r["postings"]), reverse=True)
            docs.setdefault(r["block"], set()).update(p["id"] for p in r["postings"])
        assert max(map(len, docs.values())) <= (1 if limit == 1 else 20)

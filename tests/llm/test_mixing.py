import random

import pytest
from pyspark.sql import functions as F

from lexmill.llm import mixing
from lexmill.llm.texts import n_words

SCHEMA = "doc_id long, text string, source string, size int, rank int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, 2) for i, t, s in rows], SCHEMA)


def plain_targets(sizes, weights=(5, 2, 1), cap=3):
    """Share, then hand on what is over a limit until nothing is."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in fixed]
        rest = total - sum(cap * sizes[s] for s in fixed)
        level = rest / sum(w[s] for s in free) if free else 0
        target = {s: cap * sizes[s] if s in fixed else w[s] * level for s in order}
        over = {s for s in free if target[s] > cap * sizes[s] * (1 + 1e-12)}
        if not over:
            return target
        fixed |= over


def random_rows(seed, n, sources):
    r = random.Random(seed)
    return [(i, "w " * int(r.paretovariate(1.2) * 3), r.choice(sources)) for i in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_targets_and_sizes(spark, seed):
    rows = random_rows(seed, 400, ["a", "b", "c", "d", None, "é", "Z"] + ["big"] * 6)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    want = plain_targets(sizes)  # a closing document leaves less open than the shortest that did not fit
    planned = mixing.plan(docs(spark, rows))
    got = planned.copies(planned.sizes, "id").collect()
    taken = {}
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert 0 <= r["__copies"] <= 3
        taken[r["source"]] = taken.get(r["source"], 0) + r["size"] * r["__copies"]
    for s, t in want.items():
        largest = max(len(x.split()) for _, x, y in rows if y == s)
        assert abs(taken[s] - t) <= largest, s
    off = sorted(abs(taken[s] - t) / t for s, t in want.items() if t)
    assert off[len(off) // 2] < 0.1
    again = mixing.plan(docs(spark, rows).repartition(5))
    assert sorted(map(repr, again.copies(again.sizes, "id").collect())) == sorted(map(repr, got))


def test_inclusion_follows_the_odds(spark):
    """Over many seeds a document is taken as often as its source's fraction says."""
    rows = [(i, "w " * 5, "s0") for i in range(60)] + [(100 + i, "w " * 5, "s1") for i in range(60)]
    total = {}
    for seed in range(12):
        planned = mixing.plan(docs(spark, rows), seed=seed)
        for r in planned.copies(planned.sizes, "id").collect():
            total[r["id"]] = total.get(r["id"], 0) + r["__copies"]
    share = sum(total[i] for i in range(60)) / (12 * 60)
    assert share == pytest.approx(10 / 7, abs=0.02)
    assert len({total[i] for i in range(60)}) > 3  # not always the same documents


def test_pareto_rank_orders_by_odds(spark):
    got = spark.range(1).select(
        mixing.pareto_rank(F.lit(0.5), F.lit(0.5)).alias("a"), mixing.pareto_rank(F.lit(0.5), F.lit(0.8)).alias("b"),
        mixing.pareto_rank(F.lit(0.9), F.lit(0.5)).alias("c"), mixing.pareto_rank(F.lit(0.1), F.lit(0.0)).alias("d"),
    ).first()
    assert got["a"] == pytest.approx(1) and got["b"] == pytest.approx(0.25) and got["c"] == pytest.approx(9) and got["d"] == float("inf")


def test_edges(spark):
    rows = [(1, None, "a"), (2, "", None), (3, "one two", None), (3, "one two", None), (None, "x y z", "b"), (None, "x", "b"), (4, "v " * 50_000, "b")]
    planned = mixing.plan(docs(spark, rows))
    got = planned.copies(planned.sizes, "id").collect()
    assert len(got) == 7 and all(r["size"] * r["__copies"] <= 3 * r["size"] for r in got)
    assert len({r["__copies"] for r in got if r["id"] == 3}) == 1  # repeated rows go together
    mixed = mixing.mix(docs(spark, rows))
    assert mixed.columns == ["doc_id", "text", "source", "size", "rank"]
    words = mixed.select(F.sum(n_words(F.col("text"))).alias("n")).first()["n"]
    assert words == sum(r["size"] * r["__copies"] for r in got)


def test_no_words_and_no_rows(spark):
    assert mixing.mix(docs(spark, [(1, None, "a"), (2, " ", "b")])).count() >= 0
    assert mixing.mix(docs(spark, [])).count() == 0
    planned = mixing.plan(docs(spark, []))
    assert planned.copies(planned.sizes, "id").count() == 0


def test_native(spark):
    plan = mixing.mix(docs(spark, [(1, "a b", "x"), (2, "c", "y")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_clashing_names_and_a_source_of_whole_copies(spark):
    rows = [(i, "a b c d", "small", i, "r") for i in range(5)] + [(100 + i, "w " * 50, "large", i, "r") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, rank int, target string")
    planned = mixing.plan(docs)
    got = planned.copies(docs)
    assert got.columns == ["doc_id", "text", "source", "rank", "source_size", "target", "__copies"]
    small = got.where("source = 'small'").collect()
    assert [r["__copies"] for r in small] == [3] * 5 or sum(r["__copies"] for r in small) * 4 <= 60
    assert sorted(r["rank"] for r in small) == list(range(5))
    again = mixing.mix(docs)
    assert again.columns == docs.columns and again.where("target = 'r'").count() == again.count()
    assert planned.sources.df.where("fraction = 0").count() == planned.sources.df.where("fraction = 0 AND cut IS NULL").count()

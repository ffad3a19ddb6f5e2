"""Large keys are cut into ranges; the result must equal one plain window per key."""

import random

import pytest
from pyspark.sql import functions as F

from lexmill.operators import ranges, sequence, throttle
from lexmill.operators.skew import lookup_join, ordered, running


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    data = [("hot" if rng.random() < 0.4 else f"k{rng.randrange(30)}", i, rng.choice([None, *range(9)])) for i in range(800)]
    return spark.createDataFrame(data, "k string, pos long, v long").repartition(6)


def expected(data):
    out, by_key = {}, {}
    for k, pos, v in sorted(data, key=lambda r: r[1]):
        s = by_key.setdefault(k, {"sum": None, "max": None, "last": None, "prev": None})
        before = s["max"]
        prev = s["prev"]
        if v is not None:
            s["sum"] = (s["sum"] or 0) + v
            s["max"] = v if s["max"] is None else max(s["max"], v)
            s["last"] = v
        out[(k, pos)] = (s["sum"], s["max"], before, s["last"], prev)
        s["prev"] = v
    return out


@pytest.mark.parametrize("max_rows", [10, 100, 10_000])
def test_running_values(rows, max_rows):
    v = F.col("v")
    got = running(
        rows,
        ["k"],
        [F.col("pos")],
        {"s": ("sum", v), "m": ("max", v), "b": ("max_before", v), "l": ("last", v), "p": ("previous", v)},
        max_rows,
    )
    want = expected([tuple(r) for r in rows.collect()])
    have = {(r["k"], r["pos"]): (r["s"], r["m"], r["b"], r["l"], r["p"]) for r in got.collect()}
    assert have == want


@pytest.mark.parametrize("place", [lambda i: 10**9 if i == 7 else i, lambda i: i // 5000])
def test_ranges_of_a_large_key_hold_equal_numbers(spark, place):
    """One outlier, or thousands of equal leading values: the cut follows the number of rows."""
    data = [("hot", place(i), i) for i in range(20_000)] + [("cold", i, i) for i in range(50)]
    df = spark.createDataFrame(data, "k string, pos long, tie long").repartition(8)
    cut = ordered(df, ["k"], [F.col("pos"), F.col("tie")], 1000)
    assert cut.split and cut.df.groupBy("k", "__seg").count().agg(F.max("count")).first()[0] <= 2000


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_lookup_equals_broadcast(spark, rows, how):
    lookup = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3)], "k string, w int")
    small = lookup_join(rows, lookup, ["k"], how)
    salted = lookup_join(rows, lookup, ["k"], how, max_bytes=1, salts=5, hot_rows=30)
    assert sorted(map(repr, small.collect())) == sorted(map(repr, salted.collect()))


@pytest.mark.parametrize("variant", ["extractor", "qa"])
def test_sequence_counts_do_not_depend_on_the_cut(rows, variant):
    df = rows.where("v is not null").withColumn("v", F.col("v").cast("int"))
    plain = sequence.sequence_scores(df, "k", "v", [F.col("pos")], variant)
    cut = sequence.sequence_scores(df, "k", "v", [F.col("pos")], variant, max_rows=20)
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, cut.collect()))


def merge_by_hand(spans):
    out = []
    for low, high, n in sorted(spans):
        if out and low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], high), out[-1][2] + n)
        else:
            out.append((low, high, n))
    return out


@pytest.mark.parametrize("max_rows", [15, 10_000])
def test_ranges(spark, max_rows):
    rng = random.Random(3)
    spans = [(low, low + rng.randrange(0, 6)) for low in (rng.randrange(0, 2000) for _ in range(300))]
    df = spark.createDataFrame([("loi", 2020, a, b, 1) for a, b in spans], "document_type string, year int, number_min long, number_max long, document_count long")
    merged = ranges.merge_ranges(df, max_rows=max_rows)
    got = sorted((r["number_min"], r["number_max"], r["document_count"]) for r in merged.collect())
    assert got == merge_by_hand([(a, b, 1) for a, b in spans])

    points = spark.createDataFrame([("loi", 2020, n) for n in range(0, 2010, 3)], "document_type string, year int, number long")
    inside = {r["number"]: r["contained"] for r in ranges.contained(points, df, max_rows=max_rows).collect()}
    touching = {r["number"]: r["n_ranges"] for r in ranges.touching_counts(points, df, max_rows=max_rows).collect()}
    for n in range(0, 2010, 3):
        assert inside[n] == any(a <= n <= b for a, b in spans)
        assert touching[n] == sum(a <= n + 1 and b >= n - 1 for a, b in spans)


@pytest.mark.parametrize("max_rows", [12, 10_000])
def test_adaptive_delay_equals_the_fold(spark, max_rows):
    rng = random.Random(11)
    data = [(rng.choice(["a", "a", "b"]), i * 20, rng.random() < 0.15) for i in range(400)]
    df = spark.createDataFrame(data, "host string, sec long, hit boolean").withColumn(
        "ts", F.timestamp_seconds("sec").cast("timestamp_ntz")
    )
    got = throttle.adaptive_delay(df, ["host"], "ts", [F.col("sec")], F.col("hit"), 1200, max_rows)
    have = {(r["host"], r["sec"]): r["delay_ms"] for r in got.collect()}
    want, state = {}, {}
    for host, sec, hit in data:
        s = state.setdefault(host, {"span": None, "n": 0, "h": 0, "d": 0})
        if sec // 1200 != s["span"]:
            s.update(span=sec // 1200, n=0, h=0)
        s["n"] += 1
        if hit:
            s["h"] += 1
            r = s["h"] / s["n"]
            s["d"] = 5000 if r >= 0.5 else 2000 if r >= 0.3 else 1000 if r > 0.1 else max(0, s["d"] - 500)
            want[(host, sec)] = s["d"]
    assert have == want

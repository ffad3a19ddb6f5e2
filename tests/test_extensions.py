"""User functions that fail, chunkers of the user's own, and logs of many batches."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lexmill.operators import chunkers, transform
from lexmill.streaming import cycle, novelty, throttle
from lexmill.streaming.logs import BatchLog


def halving():
    def halve(batch):
        if (batch["x"] == 13).any():
            raise ValueError("unlucky")
        out = pd.DataFrame({"k": batch["k"], "y": [v / 2 if v != 500 else "no number" for v in batch["x"]]})
        return out[batch["x"] % 10 != (0 if 500 not in set(batch["x"]) else 11)]

    return transform.Transformation("halve", halve, "k string, y double")


def test_two_bad_rows_of_a_thousand(spark):
    df = spark.createDataFrame([(f"k{i}", i, f"extra{i}") for i in range(1000)], "k string, x long, error string").repartition(3)
    step = halving()
    good, bad = step.apply_or_quarantine(df, ["k", "x"])
    assert {(r["k"], r["x"], r["error"].split(":")[0], r["step"]) for r in bad.collect()} == {("k13", 13, "ValueError", "halve"), ("k500", 500, "ArrowInvalid", "halve")}
    assert {r["k"]: r["y"] for r in good.collect()} == {f"k{i}": i / 2 for i in range(1000) if i % 10 and i != 13}
    with pytest.raises(Exception, match="unlucky"):
        step.apply(df).collect()


def test_nothing_to_transform(spark):
    good, bad = halving().apply_or_quarantine(spark.createDataFrame([], "k string, x long"), ["k"])
    assert good.count() == bad.count() == 0 and bad.columns == ["k", "error", "step"]


def test_a_chunker_and_its_inverse(spark):
    chunkers.register(chunkers.Chunker("threes", lambda t: [t[i : i + 3] for i in range(0, len(t), 3)] or [""], "|".join))
    r = random.Random(0)
    rows = [(f"d{i}", "".join(r.choices("abé \n", k=r.randint(0, 40)))) for i in range(50)] + [("null", None), ("long", "xyz" * 50_000)]
    df = spark.createDataFrame(rows, "name string, body string").repartition(4)
    chunks = chunkers.split(df, "name", "threes", "body")
    assert chunks.columns == ["name", "chunk_index", "total_chunks", "chunk"]
    got = {x["name"]: (x["n_chunks"], x["text"]) for x in chunkers.join(chunks.orderBy(F.rand(1)), "name", "threes").collect()}
    want = {n: (max(1, -(-len(t) // 3)), "|".join(t[i : i + 3] for i in range(0, len(t), 3))) if t is not None else (1, None) for n, t in rows}
    assert got == want
    with pytest.raises(KeyError, match="no chunker"):
        chunkers.split(df, "name", "unknown", "body")


def test_a_batch_reads_a_bounded_number_of_files(spark, tmp_path):
    log = BatchLog(spark, f"{tmp_path}/log", "k string, v long", every=4)

    def latest(rows):
        return rows.groupBy("k").agg(F.max_by(F.struct("v", "batch"), "batch").alias("s")).select("k", "s.*").coalesce(1)

    want = {}
    for n in range(14):
        for _ in range(1 + (n in (4, 8, 9))):  # some batches come twice, also right after a new base
            before = log.before(n, latest)
            assert len(before.inputFiles()) <= 4
            assert {r["k"]: (r["v"], r["batch"]) for r in latest(before).collect()} == want
            log.write(spark.createDataFrame([(f"k{n % 5}", n), ("all", n)], "k string, v long").coalesce(1), n)
        want |= {f"k{n % 5}": (n, n), "all": (n, n)}
    assert log.read().count() == 28


def test_streams_over_an_empty_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()

    def source(schema):
        return spark.readStream.schema(schema).parquet(f"{tmp_path}/in")

    hit = F.col("hit")
    log = BatchLog(spark, f"{tmp_path}/w", throttle.WINDOW_SCHEMA)
    assert throttle.run_windows(source("ts timestamp_ntz, hit boolean"), "ts", hit, log, f"{tmp_path}/c1").count() == 0
    out = BatchLog(spark, f"{tmp_path}/o", "host string, id long, ts timestamp_ntz, hit boolean, n_requests long, n_throttled long, rate double, delay_ms int")
    states = BatchLog(spark, f"{tmp_path}/s", "host string, span long, requests long, throttled long, delay_ms int")
    paced = throttle.run_pacing(source("host string, id long, ts timestamp_ntz, hit boolean"), ["host"], "ts", [F.col("id")], hit, states, out, f"{tmp_path}/c2")
    assert paced.count() == 0
    words = BatchLog(spark, f"{tmp_path}/n", novelty.WORD_SCHEMA)
    novelty.new_words(source("text string"), spark.createDataFrame([], "word string"), words, f"{tmp_path}/c3").awaitTermination()
    assert words.read().count() == 0
    assert cycle.best_extractions(BatchLog(spark, f"{tmp_path}/e", cycle.EXTRACTION_SCHEMA)).count() == 0

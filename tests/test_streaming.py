import random

from pyspark.sql import functions as F

from lexmill.operators import throttle as operators
from lexmill.streaming import novelty, throttle
from lexmill.streaming.logs import BatchLog


def test_novelty_keeps_its_memory_over_restarts(spark, tmp_path):
    source, checkpoint = f"{tmp_path}/in", f"{tmp_path}/cp"
    log = BatchLog(spark, f"{tmp_path}/out", novelty.WORD_SCHEMA)
    known = spark.createDataFrame([("connu",)], "word string")

    def drain(*bodies):
        spark.createDataFrame([(b,) for b in bodies], "text string").write.mode("append").parquet(source)
        stream = spark.readStream.schema("text string").parquet(source)
        novelty.new_words(stream, known, log, checkpoint).awaitTermination()
        return sorted(r["word"] for r in log.read().collect())

    assert drain("connu nouveau", "nouveau mot") == ["mot", "nouveau"]
    assert drain("mot encore") == ["encore", "mot", "nouveau"]


def test_repeated_batch_replaces_itself(spark, tmp_path):
    log = BatchLog(spark, str(tmp_path), "k string, v int")
    for batch_id, v in ((0, 1), (1, 5), (1, 3)):
        log.write(spark.createDataFrame([("a", v)], "k string, v int"), batch_id)
    assert [tuple(r) for r in log.best(["k"], [F.col("v")]).collect()] == [("a", 3)]


def probe_log(spark, n=300):
    rng = random.Random(5)
    rows = [(rng.choice("aab"), i, i * 20, rng.random() < 0.3) for i in range(n)]
    return spark.createDataFrame(rows, "host string, id long, sec long, hit boolean").withColumn(
        "ts", F.timestamp_seconds("sec").cast("timestamp_ntz")
    )


def test_pacing_in_batches_equals_one_run(spark, tmp_path):
    log = probe_log(spark)
    whole = operators.adaptive_delay(log, ["host"], "ts", [F.col("id")], F.col("hit"), 1200)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in log.schema.fields)
    out = BatchLog(spark, f"{tmp_path}/out", f"{kinds}, n_requests long, n_throttled long, rate double, delay_ms int")
    states = BatchLog(spark, f"{tmp_path}/states", "host string, span long, requests long, throttled long, delay_ms int")
    got = None
    for low, high in ((0, 7), (7, 110), (110, 111), (111, 300)):
        log.where((F.col("id") >= low) & (F.col("id") < high)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(log.schema).parquet(f"{tmp_path}/in")
        got = throttle.run_pacing(stream, ["host"], "ts", [F.col("id")], F.col("hit"), states, out, f"{tmp_path}/cp", 1200)
    columns = ["host", "id", "n_requests", "n_throttled", "delay_ms"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, whole.select(columns).collect()))


def test_late_rows_are_counted(spark, tmp_path):
    log = probe_log(spark)
    out = BatchLog(spark, f"{tmp_path}/out", throttle.WINDOW_SCHEMA)
    for part in (F.col("id") >= 200, F.col("id") < 200):
        log.where(part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(log.schema).parquet(f"{tmp_path}/in")
        got = throttle.run_windows(stream, "ts", F.col("hit"), out, f"{tmp_path}/cp")
    want = operators.throttle_windows(log, "ts", F.col("hit"))
    columns = ["window_start", "n_requests", "n_throttled"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))

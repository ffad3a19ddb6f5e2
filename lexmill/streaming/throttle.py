"""Throttling statistics and adaptive pacing on a stream of probe results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.operators.throttle import PACE, adaptive_delay, pace_state, throttle_windows
from lexmill.streaming.logs import BatchLog

WINDOW_SCHEMA = "window_start timestamp_ntz, n_requests long, n_throttled long, rate double"


def run_windows(
    log: DataFrame, ts: str, throttled: Column, out: BatchLog, checkpoint: str, interval: str = "5 minutes"
) -> DataFrame:
    """Drain the available input and return the statistics of every tumbling interval.

    Each batch writes its own counts and they are added up when read, so a row may come as late as
    it likes; no watermark drops it.
    """
    query = (
        log.writeStream.foreachBatch(lambda batch, n: out.write(throttle_windows(batch, ts, throttled, interval), n))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    sums = out.read().groupBy("window_start").agg(F.sum("n_requests").alias("n_requests"), F.sum("n_throttled").alias("n_throttled"))
    return sums.withColumn("rate", F.col("n_throttled") / F.col("n_requests"))


def run_pacing(
    log: DataFrame,
    keys: Sequence[str],
    ts: str,
    order: Sequence[Column],
    throttled: Column,
    states: BatchLog,
    out: BatchLog,
    checkpoint: str,
    interval_seconds: int = 300,
) -> DataFrame:
    """Drain the available input and return the pauses; the same rule as the batch form.

    Between batches a key is one row of `states` (the keys and the columns of PACE). Rows are
    ordered within a batch; where batches follow each other in time, the result is that of one run
    over the whole log. A repeated batch starts from the state before it.
    """
    keys = list(keys)

    def latest(rows: DataFrame) -> DataFrame:
        rest = F.struct(*PACE, "batch")
        return rows.groupBy(*keys).agg(F.max_by(rest, "batch").alias("s")).select(*keys, "s.*")

    def step(batch: DataFrame, number: int) -> None:
        before = latest(states.before(number, latest)).drop("batch")
        before = before.join(batch.select(*keys).distinct(), keys, "left_semi")
        paced = adaptive_delay(batch, keys, ts, order, throttled, interval_seconds, state=before)
        out.write(paced, number)
        paced = out.batch(number)
        states.write(pace_state(batch, paced, keys, ts, order, throttled, interval_seconds, before), number)

    query = log.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return out.read().drop("batch")

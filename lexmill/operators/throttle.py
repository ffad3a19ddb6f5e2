"""Throttling statistics and adaptive pacing over a probe log."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.scoring import DELAY_STEP_MS, MAX_ATTEMPTS, delay_reset, delay_tier
from lexmill.operators.skew import MAX_ROWS_PER_TASK, micros, ordered, running_values


def throttle_windows(log: DataFrame, ts: str, throttled: Column, interval: str = "5 minutes") -> DataFrame:
    """Requests, throttled replies and their ratio per tumbling interval; works on streams too."""
    return (
        log.groupBy(F.window(ts, interval).alias("w"))
        .agg(F.count(F.lit(1)).alias("n_requests"), F.count_if(throttled).alias("n_throttled"))
        .select(
            F.col("w.start").alias("window_start"),
            "n_requests",
            "n_throttled",
            (F.col("n_throttled") / F.col("n_requests")).alias("rate"),
        )
    )


def with_delay_tier(windows: DataFrame, previous: Column | None = None) -> DataFrame:
    return windows.withColumn("delay_ms", delay_tier(F.col("rate"), previous if previous is not None else F.lit(0)))


PACE = ("span", "requests", "throttled", "delay_ms")


def _spans(log: DataFrame, keys: Sequence[str], ts: str, throttled: Column, seconds: int, state: DataFrame | None) -> DataFrame:
    """Log rows with their interval and weights, and one row per key that stands for the earlier log."""
    spans = log.withColumns(
        {
            "__t": micros(F.col(ts)), "__n": F.lit(1).cast("long"), "__h": throttled.cast("long"),
            "__from": F.lit(None).cast("long"),
        }
    ).withColumn("__span", F.floor(F.col("__t") / F.lit(seconds * 1_000_000)))
    if state is None:
        return spans
    earlier = state.select(
        *keys, F.lit(-(1 << 62)).cast("long").alias("__t"), F.col("requests").alias("__n"), F.col("throttled").alias("__h"),
        F.col("delay_ms").cast("long").alias("__from"), F.col("span").alias("__span"),
    )
    return spans.unionByName(earlier, allowMissingColumns=True)


def adaptive_delay(
    log: DataFrame,
    keys: Sequence[str],
    ts: str,
    order: Sequence[Column],
    throttled: Column,
    interval_seconds: int = 300,
    max_rows: int = MAX_ROWS_PER_TASK,
    state: DataFrame | None = None,
) -> DataFrame:
    """The pause in force after each throttled reply, per key in time order.

    Replies are counted in intervals aligned with the clock. A reply either sets an absolute pause
    or takes 500 ms off the current one, so the state is the last value set minus 500 ms for every
    decay since. Storing (value set + 500 * decays so far) turns the fold into running sums and a
    running last, which combine across time ranges; no key's history is gathered in one place.
    `state` (see `pace_state`) continues an earlier log.
    """
    keys = list(keys)
    spans = _spans(log, keys, ts, throttled, interval_seconds, state)
    by_time = [F.col("__t"), *order]
    rows = ordered(spans, keys, by_time, max_rows)
    rows = running_values(
        rows, by_time, {"n_requests": ("sum", F.col("__n")), "n_throttled": ("sum", F.col("__h"))}, within=["__span"]
    )
    rated = (
        rows.df.where("__h = 1 or __from is not null")
        .withColumn("rate", F.col("n_throttled") / F.col("n_requests"))
        .withColumn("__set", F.coalesce("__from", delay_reset(F.col("rate")).cast("long")))
    )
    decay = F.col("__set").isNull().cast("long")
    rows = running_values(replace(rows, df=rated, stored=False), by_time, {"__decays": ("sum", decay)})
    lifted = F.when(F.col("__set").isNotNull(), F.col("__set") + F.col("__decays") * DELAY_STEP_MS)
    held = running_values(rows, by_time, {"__level": ("last", lifted)}).df
    delay = F.greatest(F.lit(0), F.coalesce("__level", F.lit(0)) - F.col("__decays") * DELAY_STEP_MS)
    return held.where("__from is null").withColumn("delay_ms", delay.cast("int")).drop(
        "__seg", "__t", "__n", "__h", "__from", "__span", "__set", "__decays", "__level"
    )


def pace_state(
    log: DataFrame,
    paced: DataFrame,
    keys: Sequence[str],
    ts: str,
    order: Sequence[Column],
    throttled: Column,
    interval_seconds: int = 300,
    state: DataFrame | None = None,
) -> DataFrame:
    """What `adaptive_delay` needs to go on after `log`: the latest interval with its counts, and the pause.

    `paced` is its result for the same log and state. One row per key in the log; all parts are
    aggregates that combine before their shuffle.
    """
    keys = list(keys)
    spans = _spans(log, keys, ts, throttled, interval_seconds, state).join(log.select(*keys).distinct(), keys, "left_semi")
    counts = spans.groupBy(*keys, "__span").agg(
        F.sum("__n").alias("requests"), F.sum("__h").alias("throttled"), F.max("__from").alias("was")
    )
    latest = counts.groupBy(*keys).agg(
        F.max("__span").alias("span"), F.max_by(F.struct("requests", "throttled"), "__span").alias("c"), F.max("was").alias("was")
    )
    last = paced.groupBy(*keys).agg(F.max_by("delay_ms", F.struct(micros(F.col(ts)), *order)).alias("now"))
    return latest.join(last, keys, "left").select(
        *keys, "span", "c.requests", "c.throttled", F.coalesce("now", "was", F.lit(0)).cast("int").alias("delay_ms")
    )


def retry_outcome(attempts: DataFrame, id_col: str, attempt: str, code: str, tie: Sequence[Column] = ()) -> DataFrame:
    """Final code per id: the first reply other than 429 within three attempts, else 429."""
    order = F.struct(F.col(attempt), *tie)
    decided = (F.col(code) != 429) & (F.col(attempt) <= MAX_ATTEMPTS)
    return attempts.groupBy(id_col).agg(
        F.coalesce(F.min_by(F.col(code), F.when(decided, order)), F.lit(429)).alias("code"),
        F.least(F.count_if(F.col(attempt) <= MAX_ATTEMPTS), F.lit(MAX_ATTEMPTS)).alias("n_considered"),
    )

"""Closed integer ranges of missing numbers, per document type and year."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.operators.skew import MAX_ROWS_PER_TASK, ordered, running, running_values

KEYS = ("document_type", "year")


def merge_ranges(ranges: DataFrame, keys: Sequence[str] = KEYS, max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """Collapse overlapping or adjacent ranges; document_count is summed.

    There are few (type, year) groups and each is large, so both passes run over number ranges of
    a group in parallel and only carry one value from range to range.
    """
    keys = list(keys)
    # Equal ranges are added up first, which also makes (number_min, number_max) a total order.
    merged = ranges.groupBy(*keys, "number_min", "number_max").agg(
        F.sum("document_count").alias("document_count")
    )
    order = [F.col("number_min"), F.col("number_max")]
    rows = ordered(merged, keys, order, max_rows)
    rows = running_values(rows, order, {"__reach": ("max_before", F.col("number_max"))})
    opens = F.coalesce(F.col("number_min") > F.col("__reach") + 1, F.lit(True)).cast("long")
    rows = running_values(rows, order, {"__island": ("sum", opens)})
    return (
        rows.df.groupBy(*keys, "__island")
        .agg(
            F.min("number_min").alias("number_min"),
            F.max("number_max").alias("number_max"),
            F.sum("document_count").alias("document_count"),
        )
        .drop("__island")
    )


def numbers_to_ranges(numbers: DataFrame, keys: Sequence[str] = KEYS, max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """Islands of consecutive numbers."""
    points = numbers.select(*keys, "number").distinct().select(
        *keys,
        F.col("number").alias("number_min"),
        F.col("number").alias("number_max"),
        F.lit(1).cast("long").alias("document_count"),
    )
    return merge_ranges(points, keys, max_rows)


def _sweep(points: DataFrame, edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Range edges and points in one ordered stream; edges sort before points at equal position."""
    left = edges.select(*keys, "position", F.lit(0).alias("is_point"), "value", F.lit(None).cast("long").alias("number"))
    right = points.select(
        *keys,
        F.col("number").cast("long").alias("position"),
        F.lit(1).alias("is_point"),
        F.lit(None).cast("long").alias("value"),
        F.col("number").cast("long").alias("number"),
    )
    return left.unionByName(right)


def contained(points: DataFrame, ranges: DataFrame, keys: Sequence[str] = KEYS, max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """Flag each distinct number that lies in some range.

    A sweep replaces the range join: a number is contained iff the furthest end of the ranges
    opened so far reaches it. No (number, range) pair is formed.
    """
    keys = list(keys)
    edges = (
        ranges.groupBy(*keys, F.col("number_min").cast("long").alias("position"))
        .agg(F.max("number_max").cast("long").alias("value"))
    )
    stream = _sweep(points.select(*keys, "number").distinct(), edges, keys)
    order = [F.col("position"), F.col("is_point")]
    swept = running(stream, keys, order, {"__reach": ("max", F.col("value"))}, max_rows)
    return swept.where("is_point = 1").select(
        *keys, "number", F.coalesce(F.col("__reach") >= F.col("number"), F.lit(False)).alias("contained")
    )


def touching_counts(points: DataFrame, ranges: DataFrame, keys: Sequence[str] = KEYS, max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """How many ranges overlap or touch each distinct number (min <= n + 1 and max >= n - 1)."""
    keys = list(keys)
    one = F.lit(1).cast("long")
    opened = ranges.select(*keys, (F.col("number_min") - 1).cast("long").alias("position"), one.alias("delta"))
    closed = ranges.select(*keys, (F.col("number_max") + 2).cast("long").alias("position"), (-one).alias("delta"))
    edges = opened.unionByName(closed).groupBy(*keys, "position").agg(F.sum("delta").alias("value"))
    stream = _sweep(points.select(*keys, "number").distinct(), edges, keys)
    order = [F.col("position"), F.col("is_point")]
    swept = running(stream, keys, order, {"__open": ("sum", F.col("value"))}, max_rows)
    return swept.where("is_point = 1").select(
        *keys, "number", F.coalesce("__open", F.lit(0).cast("long")).alias("n_ranges")
    )


def listing(ranges: DataFrame) -> DataFrame:
    return ranges.orderBy("document_type", F.col("year").desc(), "number_min")

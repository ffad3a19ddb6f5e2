"""Candidate ids from resumable cursors, minus what is known to be missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.session import materialize

BLOCK = 4096


def start_cursors(stored: DataFrame, spark, cursor_type: str, year: int, max_number: int) -> DataFrame:
    """One cursor per document type (loi first), resumed from the stored position.

    A "fetch-current" cursor restarts at the top when its stored year is over.
    """
    wanted = spark.createDataFrame([(0, "loi"), (1, "decret")], "cursor_pos int, document_type string")
    mine = stored.where(F.col("cursor_type") == cursor_type).select(
        "document_type", "current_year", "current_number"
    )
    resumed = F.col("current_year").isNotNull()
    if cursor_type == "fetch-current":
        resumed = resumed & (F.col("current_year") >= year)
    return wanted.join(mine, "document_type", "left").select(
        "cursor_pos",
        "document_type",
        F.when(resumed, F.col("current_year")).otherwise(year).alias("year"),
        F.when(resumed, F.col("current_number")).otherwise(max_number).alias("number"),
    )


def candidates(
    cursors: DataFrame,
    not_found: DataFrame,
    max_per_cursor: int | None = None,
    max_total: int | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """Numbers from each cursor down to 1 that are not known to be missing, newest first.

    Missing numbers do not use up the quota. Numbers are handled in blocks: the missing numbers of
    a block form one array of at most `block` entries, block totals decide which blocks are needed,
    and only those are expanded, each by array operations up to its share of the quota. So neither
    a long cursor nor a long missing list lands in one task.
    """
    cursors = materialize(cursors, "cursors")  # a row per document type, read three times
    keys = ["document_type", "year", "b"]
    tops = cursors.select("document_type", "year", F.col("number").alias("top"))
    missing = (
        not_found.select("document_type", "year", F.col("number").cast("long").alias("missing"))
        .join(tops, ["document_type", "year"])
        .where((F.col("missing") <= F.col("top")) & (F.col("missing") > 0))
        .withColumn("b", F.floor((F.col("top") - F.col("missing")) / block))
        .groupBy(*keys)
        .agg(F.collect_set("missing").alias("missing"))
    )
    blocks = (
        cursors.where("number > 0")
        .withColumn("number", F.col("number").cast("long"))
        .withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("number") - 1) / block))))
        .withColumn("hi", F.col("number") - F.col("b") * block)
        .withColumn("lo", F.greatest(F.col("hi") - block + 1, F.lit(1)))
        .drop("number")
    )
    if max_per_cursor is None and max_total is None:
        kept = blocks.withColumn("take", F.lit(block))
    else:
        lost = missing.select(*keys, F.size("missing").alias("lost"))
        free = blocks.join(lost, keys, "left").withColumn(
            "free", F.col("hi") - F.col("lo") + 1 - F.coalesce("lost", F.lit(0))
        )
        huge = F.lit(2**62).cast("long")
        per_cursor = F.lit(max_per_cursor).cast("long") if max_per_cursor else huge
        overall = F.lit(max_total).cast("long") if max_total else huge
        # The windows see one narrow row per block; the last one sees one row per document type.
        earlier = Window.partitionBy("cursor_pos").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
        free = free.withColumn("before", F.coalesce(F.sum("free").over(earlier), F.lit(0)))
        can = F.least(F.sum("free"), per_cursor).alias("can")
        upto = F.sum("can").over(Window.partitionBy(F.lit(0)).orderBy("cursor_pos"))
        share = F.least(overall, F.col("upto")) - F.least(overall, F.col("upto") - F.col("can"))
        quota = (
            free.groupBy("cursor_pos").agg(can).withColumn("upto", upto).select("cursor_pos", share.alias("quota"))
        )
        kept = (
            free.join(quota, "cursor_pos")
            .withColumn("take", F.least(F.col("quota") - F.col("before"), F.lit(block)).cast("int"))
            .where("take > 0 and free > 0")
        )
    gaps = F.coalesce("missing", F.array().cast("array<bigint>"))
    numbers = F.slice(F.array_except(F.expr("sequence(hi, lo, -1)"), gaps), F.lit(1), F.col("take"))
    return (
        kept.select("cursor_pos", *keys, "hi", "lo", "take")
        .repartition("document_type", "year", "b")
        .join(missing, keys, "left")
        .select("cursor_pos", "document_type", "year", F.explode(numbers.cast("array<int>")).alias("number"))
    )


def advance_cursors(
    cursors: DataFrame,
    taken: DataFrame,
    max_number: int,
    min_year: int = 1960,
    max_per_cursor: int | None = None,
    max_total: int | None = None,
) -> DataFrame:
    """Next position of each cursor after a run.

    A cursor that filled its quota goes on below its last number. One that ran out moves to the
    year before, at the configured maximum; below `min_year` it is finished (min_year, 0). A cursor
    that had no quota left stays where it is.
    """
    seen = taken.groupBy("cursor_pos").agg(F.min("number").alias("last"), F.count(F.lit(1)).alias("n"))
    joined = cursors.join(seen, "cursor_pos", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    huge = F.lit(2**62).cast("long")
    earlier = Window.partitionBy(F.lit(0)).orderBy("cursor_pos").rowsBetween(Window.unboundedPreceding, -1)
    used = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    overall = F.lit(max_total).cast("long") if max_total else huge
    per_cursor = F.lit(max_per_cursor).cast("long") if max_per_cursor else huge
    stepped = joined.withColumn("quota", F.least(per_cursor, overall - used)).withColumn(
        "next", F.when(F.col("n") >= F.col("quota"), F.col("last") - 1).otherwise(0)
    )
    idle = F.col("quota") <= 0
    done, over = F.col("next") <= 0, F.col("year") - 1 < min_year
    return stepped.select(
        "cursor_pos",
        "document_type",
        F.when(idle, F.col("year"))
        .when(done & over, F.lit(min_year))
        .when(done, F.col("year") - 1)
        .otherwise(F.col("year"))
        .alias("current_year"),
        F.when(idle, F.col("number"))
        .when(done & over, F.lit(0))
        .when(done, F.lit(max_number))
        .otherwise(F.col("next"))
        .cast("int")
        .alias("current_number"),
    )


def not_yet_seen(candidates_: DataFrame, results: DataFrame, on: list[str]) -> DataFrame:
    """Candidates without a recorded result; a rate-limited result counts as not seen."""
    seen = results.where(F.col("status") != "RATE_LIMITED").select(*on)
    return candidates_.join(seen, on, "left_anti")


def hold_at_unprobed(moved: DataFrame, candidates_: DataFrame, probed: DataFrame) -> DataFrame:
    """Cursors after a run, held at the highest candidate that has no outcome yet.

    `candidates_` has type, year, number, document_id; `probed` has document_id. Numbers are taken
    downwards, so a held cursor meets everything below again and no id is passed over.
    """
    waiting = candidates_.join(probed.select("document_id").distinct(), "document_id", "left_anti")
    first = waiting.groupBy(F.col("type").alias("document_type")).agg(
        F.max_by("year", "number").alias("__year"), F.max("number").cast("int").alias("__number")
    )
    held = F.col("__number").isNotNull()
    return moved.join(first, "document_type", "left").select(
        "cursor_type", "document_type",
        F.when(held, F.col("__year")).otherwise(F.col("current_year")).alias("current_year"),
        F.when(held, F.col("__number")).otherwise(F.col("current_number")).alias("current_number"),
    )

"""Exact deduplication by sorting contents.

Rows are range-partitioned by the leading characters of the normalised text (splitters are sampled,
and each holds a bounded prefix and a digest, never a whole text), sorted within each range with
Spark's external sort, and neighbours are compared in full. A text with more copies than a task
should hold is found beforehand by a narrow count per digest and dealt over several ranges; each of
them compares its neighbours in full and hands on its best row and their number, which are then merged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.texts import without_space
from lexmill.session import materialize

PREFIX_CHARS = 24
HOT_COPIES = 4096  # fewer copies of a text are never dealt over several ranges


def _partitions(df: DataFrame) -> int:
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def hot_texts(docs: DataFrame, text_col: str, per_task: int | None = None) -> DataFrame:
    """Texts with more than `per_task` copies, and the number of ranges they are dealt over: (__sha, __salts).

    One narrow aggregate, combined before its shuffle. At most rows / per_task texts are listed;
    with the default limit that is four for each shuffle partition, whatever the data.
    """
    limit = per_task or max(HOT_COPIES, docs.count() // (4 * _partitions(docs)))
    return (
        docs.select(F.sha2(without_space(F.col(text_col)), 256).alias("__sha"))
        .groupBy("__sha")
        .agg(F.count(F.lit(1)).alias("__copies"))
        .where(F.col("__copies") > limit)
        .select("__sha", F.ceil(F.col("__copies") / limit).alias("__salts"))
    )


def _neighbours(rows: DataFrame, hot: DataFrame, how: str, text: Column) -> DataFrame:
    """`rows` (__id, __carry and the text) with what their range knows of equal texts: __first, __rank, __size.

    A text in `hot` has one such answer for each of its ranges.
    """
    norm = without_space(text)
    rows = rows.select("*", F.sha2(norm, 256).alias("__sha"), F.substring(norm, 1, PREFIX_CHARS).alias("__prefix"))
    # Bounded: a few rows for each shuffle partition, see hot_texts.
    rows = rows.join(F.broadcast(hot), "__sha", how)
    # Repeated rows of one id share a salt, so one range decides which of them stays.
    salt = F.coalesce(F.pmod(F.xxhash64("__id"), F.col("__salts")), F.lit(0))
    rows = rows.withColumn("__salt", salt.cast("long")).drop("__salts")
    ranged = rows.repartitionByRange("__prefix", "__sha", "__salt")
    # The normalised form does not cross the shuffle; it is computed again on the other side.
    ranged = ranged.select("*", norm.alias("__norm"), F.length(F.coalesce(text, F.lit(""))).alias("__n"))
    same = Window.partitionBy("__prefix", "__sha", "__salt", "__norm")
    first = same.orderBy(F.col("__n").desc(), F.col("__id").asc_nulls_last())
    answers = [F.first("__id").over(first).alias("__first"), F.row_number().over(first).alias("__rank"), F.count(F.lit(1)).over(same).alias("__size")]
    return ranged.select(*rows.columns, "__n", *answers)


def _merged(rows: DataFrame, hot: DataFrame, text: Column) -> DataFrame:
    """`hot` with the row that stays and the number of copies, from one row of each of a text's ranges."""
    best = F.struct((-F.col("__n")).alias("a"), F.col("__id").isNull().alias("b"), F.col("__id").alias("id"))
    told = _neighbours(rows, hot, "inner", text).where("__rank = 1")
    told = told.groupBy("__sha").agg(F.min(best).alias("__best"), F.sum("__size").alias("__hot_size"))
    return hot.join(told.select("__sha", "__hot_size", F.col("__best.id").alias("__hot_keep")), "__sha")


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: Sequence[str] = (),
    per_task: int | None = None,
) -> DataFrame:
    """One row per row of `docs`: id, keep_id, group_size, kept, text_sha256, and the struct `row` of the
    `carry` columns if there are any.

    Texts are equal when they are identical after deleting white space; null counts as empty. Of
    equal texts the one with the most code points stays, then the smallest id (null last). Of rows
    that repeat the winner's id and text exactly one is `kept`. An empty table gives no rows;
    columns outside the arguments are not touched, so their names cannot clash.
    """
    hot = materialize(hot_texts(docs, text_col, per_task), "hot-texts")
    own = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    if hot.isEmpty():
        decided = hot.select("*", F.lit(0).cast("long").alias("__hot_size"), F.lit(None).cast(own.schema["__id"].dataType).alias("__hot_keep"))
    else:
        decided = materialize(_merged(own, hot, F.col("__text")), "decided-texts")
    # A text that is carried anyway crosses the shuffle there, and only there.
    carry, inside = list(carry), text_col in carry
    text = F.col("__carry")[text_col] if inside else F.col("__text")
    rows = docs.select(
        F.col(id_col).alias("__id"),
        F.struct(*[F.col(c) for c in carry]).alias("__carry") if carry else F.lit(None).alias("__carry"),
        *[F.col(text_col).alias("__text")] * (not inside),
    )
    found = _neighbours(rows, decided, "left", text)
    is_hot = F.col("__hot_size").isNotNull()
    keep = F.when(is_hot, F.col("__hot_keep")).otherwise(F.col("__first"))
    kept = (F.col("__rank") == 1) & (~is_hot | F.col("__id").eqNullSafe(F.col("__hot_keep")))
    return found.select(
        F.col("__id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("__hot_size", "__size").cast("long").alias("group_size"),
        kept.alias("kept"),
        F.col("__sha").alias("text_sha256"),
        *[F.col("__carry").alias("row")] * bool(carry),
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns."""
    found = exact_groups(docs, id_col, text_col, carry=docs.columns)
    return found.where("kept").select("row.*")

"""Order checks over an article table (one row per article)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.scoring import sequence_penalty_score
from lexmill.operators.skew import MAX_ROWS_PER_TASK, running


def sequence_counts(
    articles: DataFrame,
    key: str,
    index: str,
    order: Sequence[Column],
    variant: str = "extractor",
    max_rows: int = MAX_ROWS_PER_TASK,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Per document: n_articles, gaps, duplicates, inversions, first_index, strict.

    Only the neighbour of each row is needed, so documents are never collected; the counts are
    plain sums and combine before the shuffle. `sized_by` names the keys where that is cheaper than
    storing the rows, as with a stored table.
    """
    places = [f"__o{i}" for i in range(len(order))]
    narrow = articles.select(key, index, *[c.alias(p) for c, p in zip(order, places)])
    stepped = running(narrow, [key], [F.col(p) for p in places], {"__prev": ("previous", F.col(index))}, max_rows, sized_by)
    step = F.col(index) - F.col("__prev")
    zero = F.lit(0).cast("long")
    # The rows lie by key already, so their distinct indexes are counted without another shuffle.
    whole_set = [] if variant == "extractor" else [F.count_distinct(index).alias("__d")]
    out = stepped.groupBy(key).agg(
        F.count(index).alias("n_articles"),
        F.sum(F.when(step > 1, step - 1).otherwise(zero)).alias("neighbour_gaps"),
        F.count_if(step == 0).alias("neighbour_duplicates"),
        F.count_if(step < 0).alias("inversions"),
        F.min(index).alias("low"),
        F.max(index).alias("high"),
        F.bool_and(F.coalesce(step == 1, F.lit(True))).alias("strict"),
        *whole_set,
    )
    if variant == "extractor":
        gaps, duplicates = F.col("neighbour_gaps"), F.col("neighbour_duplicates")
    else:
        gaps, duplicates = F.col("high") - F.col("low") + 1 - F.col("__d"), F.col("n_articles") - F.col("__d")
    return out.select(
        key, "n_articles", gaps.alias("gaps"), duplicates.alias("duplicates"), "inversions", "low", "strict"
    )


def sequence_scores(
    articles: DataFrame,
    key: str,
    index: str,
    order: Sequence[Column],
    variant: str = "extractor",
    max_rows: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """Sequence score per document; a lone article scores 1 if it is article 1, else 0.8."""
    counts = sequence_counts(articles, key, index, order, variant, max_rows)
    score = F.when(
        F.col("n_articles") == 1, F.when(F.col("low") == 1, F.lit(1.0)).otherwise(F.lit(0.8))
    ).otherwise(sequence_penalty_score(F.col("gaps"), F.col("duplicates"), F.col("inversions")))
    return counts.withColumn("sequence_score", score)

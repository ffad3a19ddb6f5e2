"""Counts and corpus reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions import text


def counts_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def status_distribution(registry: DataFrame) -> DataFrame:
    """Rows per status without FAILED; every row repeats how many were left out."""
    counted = counts_by(registry, "status")  # one row per status, so the window below is tiny
    failed = F.max(F.when(F.col("status") == "FAILED", F.col("n"))).over(Window.partitionBy(F.lit(0)))
    return counted.withColumn("n_excluded", F.coalesce(failed, F.lit(0))).where("status <> 'FAILED'")


def distinct_signatories(signatories: DataFrame) -> DataFrame:
    return signatories.select("name", "role").distinct().orderBy("name", "role")


def period(year: Column) -> Column:
    """Decade label."""
    start = F.floor(year / 10) * 10
    return F.format_string("%d-%d", start.cast("int"), (start + 9).cast("int"))


def period_statistics(extracted: DataFrame, bar: float = 0.7) -> DataFrame:
    """Success, confidence and articles per decade with a grand total (period null).

    Needs year, n_articles, confidence; a document succeeds when it has an article.
    """
    ok = F.col("n_articles") > 0
    return (
        extracted.withColumn("period", period(F.col("year")))
        .rollup("period")
        .agg(
            F.count(F.lit(1)).alias("n_documents"),
            F.avg(ok.cast("int")).alias("success_rate"),
            F.avg(F.when(ok, F.col("confidence"))).alias("mean_confidence"),
            F.min(F.when(ok, F.col("n_articles"))).alias("min_articles"),
            F.max(F.when(ok, F.col("n_articles"))).alias("max_articles"),
            F.sum("n_articles").alias("total_articles"),
            F.avg((F.col("confidence") >= bar).cast("int")).alias("share_above_bar"),
        )
    )


def extraction_report(texts: DataFrame, extractions: DataFrame) -> DataFrame:
    """One row per extraction with its figures and the misreadings seen in its text.

    `extractions` has document_id, confidence, n_articles, title, date, city, n_signatories.
    """
    # The narrow side becomes the hash table, so whole texts are never sorted.
    joined = extractions.hint("shuffle_hash").join(texts.select("document_id", "text"), "document_id", "left")
    issues = text.defect_flags(F.col("text"), F.col("date"))
    return joined.select(
        "document_id",
        "confidence",
        "n_articles",
        F.col("title").isNotNull().alias("has_title"),
        F.col("date").isNotNull().alias("has_date"),
        F.col("city").isNotNull().alias("has_city"),
        (F.col("n_signatories") > 0).alias("has_signatories"),
        F.col("text").isNull().alias("text_missing"),
        F.size(text.lines(F.coalesce("text", F.lit("")))).alias("n_lines"),
        F.coalesce(issues, F.array().cast("array<string>")).alias("issues"),
    )


def report_totals(report: DataFrame) -> DataFrame:
    return report.agg(
        F.count(F.lit(1)).alias("n_documents"),
        F.sum(F.size("issues")).alias("n_issues"),
        F.sum("n_articles").alias("n_articles"),
    )

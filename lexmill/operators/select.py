"""Choosing the documents a job works on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions import ids


def presence_flags(inventory: DataFrame) -> DataFrame:
    """One row per document: has_pdf, has_ocr, has_json."""
    return inventory.groupBy("document_id").agg(
        *[F.max((F.col("kind") == k).cast("int")).cast("boolean").alias(f"has_{k}") for k in ids.ARTIFACTS]
    )


def with_presence(registry: DataFrame, inventory: DataFrame, recorded: DataFrame | None = None) -> DataFrame:
    """Registry with has_pdf, has_ocr, has_json and (given download results) is_recorded."""
    out = registry.join(presence_flags(inventory), "document_id", "left")
    flags = [f"has_{k}" for k in ids.ARTIFACTS]
    if recorded is not None:
        seen = recorded.select("document_id").distinct().withColumn("is_recorded", F.lit(True))
        out = out.join(seen, "document_id", "left")
        flags.append("is_recorded")
    return out.withColumns({f: F.coalesce(F.col(f), F.lit(False)) for f in flags})


def vanished(registry: DataFrame, inventory: DataFrame) -> DataFrame:
    """Downloaded documents whose file is gone."""
    files = inventory.where("kind = 'pdf'").select("document_id").distinct()
    return registry.where("status = 'DOWNLOADED'").join(files, "document_id", "left_anti")


def should_download(force: bool = False):
    """Boolean column over status, is_recorded and has_pdf."""
    done = F.col("is_recorded") & F.col("has_pdf")
    return (
        F.when(done, F.lit(force))
        .when(F.col("is_recorded"), F.lit(True))
        .when(F.col("status").isin("FETCHED", "DOWNLOADED"), F.lit(True))
        .otherwise(F.lit(force))
    )


def to_download(
    registry: DataFrame,
    inventory: DataFrame,
    recorded: DataFrame,
    type_: str | None = None,
    limit: int | None = None,
    force: bool = False,
) -> DataFrame:
    """Fetched documents and downloaded ones without a file, newest first."""
    flagged = with_presence(
        registry.where(F.col("status").isin("FETCHED", "DOWNLOADED") & ids.type_filter(F.col("type"), type_)),
        inventory,
        recorded,
    )
    wanted = (F.col("status") == "FETCHED") | ~F.col("has_pdf")
    return newest_first(flagged.where(wanted & should_download(force)), limit)


def target_documents(registry: DataFrame, wanted: DataFrame, statuses: list[str], force: bool = False) -> DataFrame:
    """The named documents; without `force` only those in an eligible status."""
    chosen = registry.join(wanted.select("document_id").distinct(), "document_id", "left_semi")
    return chosen if force else chosen.where(F.col("status").isin(statuses))


def newest_first(df: DataFrame, limit: int | None = None) -> DataFrame:
    """year and number descending; a limit becomes a distributed top-k."""
    ordered = df.orderBy(F.col("year").desc(), F.col("number").desc())
    return ordered if limit is None else ordered.limit(limit)


def with_json(registry: DataFrame, inventory: DataFrame) -> DataFrame:
    files = inventory.where("kind = 'json'").select("document_id").distinct()
    return registry.where("status = 'EXTRACTED'").join(files, "document_id", "left_semi")


def without_json_count(registry: DataFrame, inventory: DataFrame) -> DataFrame:
    files = inventory.where("kind = 'json'").select("document_id").distinct()
    missing = registry.where("status = 'EXTRACTED'").join(files, "document_id", "left_anti")
    return missing.agg(F.count(F.lit(1)).alias("n_missing"))


def usable_payloads(payloads: DataFrame, content: str = "content") -> DataFrame:
    return payloads.where(F.length(content) > 0)


def duplicate_payloads(payloads: DataFrame, id_col: str, content: str = "content") -> DataFrame:
    """Payloads that occur more than once: (sha256, n_copies, first_id).

    A partial count per hash precedes the shuffle; copies are never listed in one group.
    """
    return (
        payloads.select(id_col, F.sha2(content, 256).alias("sha256"))
        .groupBy("sha256")
        .agg(F.count(F.lit(1)).alias("n_copies"), F.min(id_col).alias("first_id"))
        .where("n_copies > 1")
    )

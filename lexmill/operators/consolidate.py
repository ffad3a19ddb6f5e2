"""From extraction JSON to the three consolidated tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import jsondoc
from lexmill.functions.rowwise import once
from lexmill.operators.upsert import merge


def next_status(status: Column, readable: Column) -> Column:
    """CONSOLIDATED stays; anything but EXTRACTED, or unreadable JSON, becomes FAILED."""
    return (
        F.when(status == "CONSOLIDATED", status)
        .when((status == "EXTRACTED") & F.coalesce(readable, F.lit(False)), F.lit("CONSOLIDATED"))
        .otherwise(F.lit("FAILED"))
    )


def parse(extractions: DataFrame, registry: DataFrame) -> DataFrame:
    """Extractions joined to their registry row, with the JSON read into `doc` and a `readable` flag.

    A document is readable when it has a confidence, a source and an article array whose entries
    all carry an index.
    """
    # The narrow side becomes the hash table, so whole JSON texts are never sorted.
    joined = registry.hint("shuffle_hash").join(extractions.select("document_id", "json"), "document_id")
    return (
        jsondoc.with_document(joined)
        .withColumn(
            "readable",
            F.coalesce(
                F.col("doc._metadata.confidence").isNotNull()
                & F.col("doc._metadata.source").isNotNull()
                & F.col("doc.articles").isNotNull()
                & F.forall("doc.articles", lambda a: a["index"].isNotNull()),
                F.lit(False),
            ),
        )
        .drop("json")
    )


def gate(parsed: DataFrame, metadata: DataFrame) -> DataFrame:
    """Drop documents whose stored confidence is at least the new one."""
    stored = metadata.select("document_id", F.col("extraction_confidence").alias("__stored"))
    better = F.col("__stored").isNull() | (F.col("doc._metadata.confidence") > F.col("__stored"))
    return parsed.where("readable").join(stored, "document_id", "left").where(better).drop("__stored")


def metadata_rows(gated: DataFrame, as_of: Column) -> DataFrame:
    return gated.select(
        "document_id",
        F.col("type").alias("document_type"),
        F.col("year").alias("document_year"),
        F.col("number").alias("document_number"),
        F.col("doc.title").alias("title"),
        F.col("doc.promulgationDate").alias("promulgation_date"),
        F.col("doc.promulgationCity").alias("promulgation_city"),
        F.size("doc.articles").alias("total_articles"),
        F.col("url").alias("source_url"),
        F.col("doc._metadata.confidence").alias("extraction_confidence"),
        F.col("doc._metadata.source").alias("extraction_method"),
        F.col("doc._metadata.timestamp").alias("extraction_timestamp"),
        as_of.alias("consolidated_at"),
    )


def article_rows(gated: DataFrame, as_of: Column) -> DataFrame:
    """One row per (document, index); of repeated indexes the last one counts.

    A document's articles arrive in one array, so repeats are removed by sorting that array; no
    shuffle is needed.
    """
    flat = gated.select(
        "document_id",
        "type",
        "year",
        "number",
        F.col("doc._metadata.confidence").alias("confidence"),
        F.col("doc._metadata.source").alias("source"),
        F.col("doc.articles").alias("__articles"),
    )
    placed = F.array_sort(
        F.transform(
            "__articles",
            lambda a, i: F.struct(a["index"].alias("index"), i.alias("pos"), a["content"].alias("content")),
        )
    )
    last = F.filter(
        "__placed", lambda a, i: ~F.coalesce(F.get("__placed", i + 1)["index"] == a["index"], F.lit(False))
    )
    rows = once(flat, __placed=placed).withColumn("a", F.explode(last))
    return rows.select(
        "document_id",
        F.col("a.index").alias("article_index"),
        F.col("a.content").alias("content"),
        F.col("type").alias("document_type"),
        F.col("year").alias("document_year"),
        F.col("number").alias("document_number"),
        F.col("confidence").alias("extraction_confidence"),
        F.col("source").alias("extraction_method"),
        as_of.alias("consolidated_at"),
    )


def signatory_rows(gated: DataFrame, as_of: Column) -> DataFrame:
    rows = gated.select(
        "document_id", "type", "year", F.posexplode("doc.signatories").alias("pos", "s")
    )
    return rows.select(
        "document_id",
        (F.col("pos") + 1).alias("signatory_order"),
        F.col("s.role").alias("role"),
        F.col("s.name").alias("name"),
        F.try_to_date("s.mandateStart", "yyyy-MM-dd").alias("mandate_start"),
        F.try_to_date("s.mandateEnd", "yyyy-MM-dd").alias("mandate_end"),
        F.col("type").alias("document_type"),
        F.col("year").alias("document_year"),
        as_of.alias("consolidated_at"),
    )


def consolidate(
    parsed: DataFrame,
    metadata: DataFrame,
    articles: DataFrame,
    signatories: DataFrame,
    as_of: Column,
    prune_stale: bool = False,
) -> dict[str, DataFrame]:
    """New snapshots of the three tables.

    Rows of an earlier version that the new JSON no longer has stay unless `prune_stale`.
    """
    gated = gate(parsed, metadata)

    def always(old: Column, new: Column) -> Column:
        return F.lit(True)

    if prune_stale:
        articles = articles.join(gated.select("document_id"), "document_id", "left_anti")
        signatories = signatories.join(gated.select("document_id"), "document_id", "left_anti")
    return {
        "consolidated_metadata": merge(
            metadata,
            metadata_rows(gated, as_of),
            ["document_id"],
            always,
            keep_when_null=["title", "promulgation_date", "promulgation_city", "source_url"],
        ).drop("change"),
        "consolidated_articles": merge(
            articles, article_rows(gated, as_of), ["document_id", "article_index"], always
        ).drop("change"),
        "consolidated_signatories": merge(
            signatories,
            signatory_rows(gated, as_of),
            ["document_id", "signatory_order"],
            always,
            keep_when_null=["mandate_start", "mandate_end"],
        ).drop("change"),
    }


def status_counts(registry: DataFrame) -> DataFrame:
    return registry.agg(
        F.count_if(F.col("status") == "CONSOLIDATED").alias("n_consolidated"),
        F.count_if(F.col("status") == "FAILED").alias("n_failed"),
    )

"""Choosing between an extraction and its alternatives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions import jsondoc

# Thresholds of the cascade and the confidence given to a corrected text.
TEXT_THRESHOLD, JSON_THRESHOLD, CORRECTED_CONFIDENCE = 0.3, 0.5, 0.90


def _with_quality(df: DataFrame, json: str, out: str) -> DataFrame:
    return (
        jsondoc.with_root(df, json, "__root")
        .withColumn(out, jsondoc.quality_score(F.col("__root")))
        .drop("__root")
    )


def choose(
    base: DataFrame,
    corrected_text: DataFrame | None = None,
    corrected_json: DataFrame | None = None,
    full: DataFrame | None = None,
    text_threshold: float = TEXT_THRESHOLD,
    json_threshold: float = JSON_THRESHOLD,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Best result per document, with its JSON quality and an `accepted` flag.

    `base` has document_id, json, confidence, source; the optional tables have document_id, json
    (and confidence, source where they differ from the defaults) and hold at most one row per
    document. A corrected text is tried below the text threshold and wins on confidence; a
    corrected JSON, then a full extraction, are tried below the JSON threshold and win on quality.
    The columns `keep` of `base` stay.
    """
    keep = list(keep)
    out = base.select("document_id", *keep, "json", "confidence", "source")
    if corrected_text is not None:
        alt = corrected_text.select(
            "document_id",
            F.struct(
                F.col("json").alias("json"),
                F.lit(CORRECTED_CONFIDENCE).alias("confidence"),
                F.lit("OCR_CORRECTED").alias("source"),
            ).alias("__alt"),
        )
        use = F.coalesce(
            (F.col("confidence") < text_threshold) & (F.col("__alt.confidence") > F.col("confidence")), F.lit(False)
        )
        out = out.join(alt, "document_id", "left").select(
            "document_id",
            *keep,
            *[F.when(use, F.col(f"__alt.{c}")).otherwise(F.col(c)).alias(c) for c in ("json", "confidence", "source")],
        )
    out = _with_quality(out, "json", "quality")
    for table, source in ((corrected_json, "JSON_CORRECTED"), (full, "FULL")):
        if table is None:
            continue
        columns = table.columns
        alt = _with_quality(table, "json", "__q").select(
            "document_id",
            F.struct(
                F.col("json").alias("json"),
                (F.col("confidence") if "confidence" in columns else F.lit(CORRECTED_CONFIDENCE)).alias("confidence"),
                (F.col("source") if "source" in columns else F.lit(source)).alias("source"),
                F.col("__q").alias("quality"),
            ).alias("__alt"),
        )
        use = F.coalesce(
            (F.col("quality") < json_threshold) & (F.col("__alt.quality") > F.col("quality")), F.lit(False)
        )
        out = out.join(alt, "document_id", "left").select(
            "document_id",
            *keep,
            *[
                F.when(use, F.col(f"__alt.{c}")).otherwise(F.col(c)).alias(c)
                for c in ("json", "confidence", "source", "quality")
            ],
        )
    return out.withColumn("accepted", F.col("quality") >= json_threshold)

"""Identifiers, URLs, artifact paths, status and probe-code mapping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.schemas import DOCUMENT_TYPES, STATUSES

# Artifact kinds with their folder and file extension.
ARTIFACTS = {"pdf": ("pdfs", "pdf"), "ocr": ("ocr", "txt"), "json": ("articles", "json")}


def document_id(type_: Column, year: Column, number: Column) -> Column:
    return F.format_string("%s-%d-%d", type_, year, number)


def parse_document_id(doc_id: Column) -> Column:
    """struct(type, year, number); null unless the id has exactly three dash-separated parts."""
    parts = F.split(F.trim(doc_id), "-")
    parsed = F.struct(
        F.get(parts, 0).alias("type"),
        F.get(parts, 1).try_cast("int").alias("year"),
        F.get(parts, 2).try_cast("int").alias("number"),
    )
    return F.when(F.size(parts) == 3, parsed)


def document_url(base: str, type_: Column, year: Column, number: Column) -> Column:
    return F.concat(F.lit(base.rstrip("/") + "/"), document_id(type_, year, number))


def padded_url(base: str, type_: Column, year: Column, number: Column) -> Column:
    """Alternative with a two-digit number, null unless the number has one digit."""
    padded = F.concat_ws("-", type_, year.cast("string"), F.lpad(number.cast("string"), 2, "0"))
    return F.when(number < 10, F.concat(F.lit(base.rstrip("/") + "/"), padded))


def download_url(url: Column) -> Column:
    return F.concat(url, F.lit("/download"))


def artifact_path(root: str, kind: str, type_: Column, doc_id: Column) -> Column:
    folder, extension = ARTIFACTS[kind]
    return F.concat(F.lit(f"{root}/{folder}/"), type_, F.lit("/"), doc_id, F.lit(f".{extension}"))


def valid_document(type_: Column, doc_id: Column) -> Column:
    """Known type, and an id that is neither empty nor able to leave its folder."""
    safe = (
        (F.length(F.trim(doc_id)) > 0)
        & ~doc_id.contains("..")
        & ~doc_id.contains("/")
        & ~doc_id.contains("\\")
    )
    return F.coalesce(type_.isin(DOCUMENT_TYPES) & safe, F.lit(False))


def type_filter(type_: Column, wanted: str | None) -> Column:
    """Case-insensitive type match; an absent or blank argument keeps every row."""
    wanted = (wanted or "").strip().lower()
    return F.lower(type_) == wanted if wanted else F.lit(True)


def probe_status(code: Column, number: Column, padded_code: Column) -> Column:
    """struct(status, exists, padded) for one probed id."""
    use_padded = (code == 404) & (number < 10) & padded_code.isNotNull()
    final = F.when(use_padded, padded_code).otherwise(code)
    return F.struct(
        F.when(final == 200, "FETCHED").when(final == 429, "RATE_LIMITED").otherwise("FAILED").alias("status"),
        F.coalesce(final == 200, F.lit(False)).alias("exists"),
        F.coalesce(use_padded & (padded_code == 200), F.lit(False)).alias("padded"),
    )


def single_fetch_status(code: Column) -> Column:
    """struct(status, error) as recorded when one document is fetched on its own."""
    return F.struct(
        F.when(code == 200, "DOWNLOADED").when(code == 404, "NOT_FOUND").otherwise("FAILED").alias("status"),
        F.when(code == 200, F.lit(None).cast("string"))
        .when(code == 404, F.lit("Document not found (404)"))
        .otherwise(F.concat(F.lit("HTTP "), code.cast("string")))
        .alias("error_message"),
    )


def status_or_pending(status: Column) -> Column:
    """A status outside the closed domain becomes PENDING."""
    return F.when(status.isin(STATUSES), status).otherwise("PENDING")


def result_status(status: Column) -> Column:
    return F.coalesce(status, F.lit("UNKNOWN"))


def status_ordinal(status: Column) -> Column:
    pairs = [F.lit(x) for i, s in enumerate(STATUSES) for x in (s, i)]
    return F.create_map(*pairs)[status]

"""Extraction documents as JSON: building, reading the dialects, checking, scoring."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import scoring
from lexmill.functions.rowwise import once
from lexmill.schemas import DIALECT_JSON

# The fields whose presence inside `_metadata` is scored.
METADATA_FIELDS = [
    "confidence", "source", "timestamp", "documentId", "type", "year", "number",
    "promulgationDate", "promulgationCity", "articles",
]


def build_document(
    doc_id: Column,
    type_: Column,
    year: Column,
    number: Column,
    confidence: Column,
    source: Column,
    timestamp: Column,
    articles: Column,
    signatories: Column,
    title: Column,
    date: Column,
    city: Column,
) -> Column:
    """JSON text of one extraction; absent optional fields and an empty signatory list are omitted."""
    return F.to_json(
        F.struct(
            F.struct(
                confidence.alias("confidence"), source.alias("source"), timestamp.alias("timestamp")
            ).alias("_metadata"),
            doc_id.alias("documentId"),
            type_.alias("type"),
            year.alias("year"),
            number.alias("number"),
            title.alias("title"),
            date.alias("promulgationDate"),
            city.alias("promulgationCity"),
            F.transform(
                articles, lambda a: F.struct(a["index"].alias("index"), a["content"].alias("content"))
            ).alias("articles"),
            F.when(
                F.size(signatories) > 0,
                F.transform(
                    signatories,
                    lambda s: F.struct(
                        s["role"].alias("role"),
                        s["name"].alias("name"),
                        s["order"].alias("order"),
                        s["mandate_start"].cast("string").alias("mandateStart"),
                        s["mandate_end"].cast("string").alias("mandateEnd"),
                    ),
                ),
            ).alias("signatories"),
        )
    )


def with_document(df: DataFrame, json: str = "json", out: str = "doc") -> DataFrame:
    """Read any of the three dialects into the programmatic one; null for unreadable text."""
    return once(once(df, __d=F.from_json(json, DIALECT_JSON)), **{out: _normalize(F.col("__d"))}).drop("__d")


def _normalize(d: Column) -> Column:
    return F.when(
        d.isNotNull(),
        F.struct(
            F.struct(
                d["_metadata"]["confidence"].alias("confidence"),
                F.coalesce(d["_metadata"]["source"], d["_metadata"]["method"]).alias("source"),
                d["_metadata"]["timestamp"].alias("timestamp"),
            ).alias("_metadata"),
            d["documentId"].alias("documentId"),
            d["type"].alias("type"),
            F.coalesce(d["year"], d["annee"]).alias("year"),
            F.coalesce(d["number"], d["numero"].try_cast("int")).alias("number"),
            F.coalesce(d["title"], d["titre"]).alias("title"),
            F.coalesce(d["promulgationDate"], d["datePromulgation"]).alias("promulgationDate"),
            d["promulgationCity"].alias("promulgationCity"),
            F.transform(
                d["articles"],
                lambda a: F.struct(
                    F.coalesce(a["index"], a["number"], a["numero"]).try_cast("int").alias("index"),
                    F.coalesce(a["content"], a["contenu"]).alias("content"),
                ),
            ).alias("articles"),
            F.coalesce(
                F.transform(
                    d["signatories"],
                    lambda s, i: F.struct(
                        s["name"].alias("name"),
                        F.coalesce(s["role"], s["title"]).alias("role"),
                        F.coalesce(s["order"], i + 1).alias("order"),
                        s["mandateStart"].alias("mandateStart"),
                        s["mandateEnd"].alias("mandateEnd"),
                    ),
                ),
                F.transform(
                    d["signataires"],
                    lambda s, i: F.struct(
                        s["nom"].alias("name"),
                        F.coalesce(s["fonction"], s["titre"]).alias("role"),
                        (i + 1).alias("order"),
                        F.lit(None).cast("string").alias("mandateStart"),
                        F.lit(None).cast("string").alias("mandateEnd"),
                    ),
                ),
            ).alias("signatories"),
        ),
    )


def with_root(df: DataFrame, json: str = "json", out: str = "root") -> DataFrame:
    """Add the top-level fields of a JSON text as a map of raw texts, parsed once."""
    return once(df, **{out: F.from_json(json, "map<string,string>")})


def _array_size(root: Column, field: str) -> Column:
    """Elements of an array field; null when absent or not an array."""
    raw = root[field]
    return F.when(raw.startswith("["), F.json_array_length(raw))


def _not_array(root: Column, field: str) -> Column:
    return F.map_contains_key(root, field) & _array_size(root, field).isNull()


def has_structure(root: Column) -> Column:
    """`_metadata` present and a non-empty `articles` array; false for anything unreadable."""
    return F.coalesce(F.map_contains_key(root, "_metadata") & (_array_size(root, "articles") > 0), F.lit(False))


def metadata_score(root: Column, fields: Sequence[str] = tuple(METADATA_FIELDS)) -> Column:
    """Share of the named fields present inside `_metadata`; absent and null both count as missing."""
    inner = F.from_json(root["_metadata"], "map<string,string>")
    present = F.size(F.filter(F.map_entries(inner), lambda e: e["key"].isin(*fields) & e["value"].isNotNull()))
    return F.greatest(F.coalesce(present, F.lit(0)), F.lit(0)) / F.lit(float(len(fields)))


def article_indexes(root: Column) -> Column:
    """Indexes of the articles that carry one, in order."""
    parsed = F.from_json(root["articles"], "array<struct<index:int>>")
    return F.transform(F.filter(parsed, lambda a: a["index"].isNotNull()), lambda a: a["index"])


def quality_score(root: Column) -> Column:
    """Structure, metadata, article order and signatories in one score; unreadable JSON scores 0."""
    ordered = F.coalesce(scoring.strictly_sequential(article_indexes(root)), F.lit(False))
    articles = F.when(_array_size(root, "articles") >= 0, F.when(ordered, 1.0).otherwise(0.5)).otherwise(0.0)
    signed = F.coalesce(_array_size(root, "signatories") > 0, F.lit(False))
    score = (
        has_structure(root).cast("double") * 0.30
        + metadata_score(root) * 0.30
        + articles * 0.30
        + signed.cast("double") * 0.10
    )
    unusable = root.isNull() | _not_array(root, "articles") | _not_array(root, "signatories")
    return F.when(unusable, F.lit(0.0)).otherwise(score)


def model_reply_confidence(root: Column) -> Column:
    """Confidence of a structured reply in the French dialect."""
    n_articles = F.coalesce(_array_size(root, "articles"), F.lit(0))
    n_signed = F.coalesce(_array_size(root, "signataires"), F.lit(0))
    present = [root[f].isNotNull().cast("int") for f in ("titre", "numero", "annee", "type")]
    score = (
        F.least(F.lit(1.0), n_articles / F.lit(10.0)) * 0.40
        + reduce(lambda a, b: a + b, present) / F.lit(4.0) * 0.30
        + (n_articles > 0).cast("double") * 0.20
        + (n_signed > 0).cast("double") * 0.10
    )
    return F.when(root.isNotNull(), F.least(F.lit(1.0), score)).otherwise(F.lit(0.0))

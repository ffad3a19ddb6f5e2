"""Whole jobs over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill.catalog import query
from lexmill.catalog.audit_queries import _ALL, _BASE, _fold_sql, extraction_figures
from lexmill.catalog.chunk_queries import _patterns, built_json, json_parts_sql
from lexmill.catalog.merge_queries import _FETCH, _fetch_rows, stored_rows
from lexmill.catalog.registry_queries import _CURSORS, _missing
from lexmill.catalog.text_queries import _confidence_sql
from lexmill.catalog.views import (
    ARTICLES, BASE_URL, INVENTORY, LEGAL_TEXT, PRESENCE, PROBES, RECORDED, REGISTRY, WORD_SEPARATOR,
    Tables, ctes,
)
from lexmill.functions import ids, text
from lexmill.plans import batches, cascade, jobs
from lexmill.schemas import TABLES, empty
from lexmill.session import scratch_path
from lexmill.sources.tables import StateTables

AS_OF = "2025-01-01 00:00:00"

_LOG = """log AS (SELECT r.document_id, l.l_linenumber AS attempt, min(CASE l_returnflag WHEN 'R' THEN 404 WHEN 'A' THEN 429 ELSE 200 END) AS code
  FROM lineitem l JOIN registry r ON r.o_orderkey = l.l_orderkey GROUP BY 1, 2),
final AS (SELECT document_id, coalesce(min_by(code, attempt) FILTER (code <> 429 AND attempt <= 3), 429) AS code FROM log GROUP BY 1),
job AS (SELECT r.document_id, r.type, r.year, r.number, f.code FROM registry r JOIN final f USING (document_id)
  WHERE r.year = (SELECT year FROM top) AND NOT EXISTS (SELECT 1 FROM missing m WHERE m.type = r.type AND m.year = r.year AND m.number = r.number))"""


def _fetch_run(spark, path, mode="previous"):
    t = Tables(spark, path)
    registry = t.registry.withColumn("number", F.col("number").cast("int"))
    top = registry.agg(F.max("year")).first()[0]
    cursors = (
        registry.groupBy(F.col("type").alias("document_type"))
        .agg(F.max("number").alias("current_number"))
        .select(
            F.lit(f"fetch-{mode}").alias("cursor_type"), "document_type", F.lit(top).alias("current_year"),
            "current_number", F.lit(None).cast("timestamp_ntz").alias("updated_at"),
        )
    )
    code = F.when(F.col("l_returnflag") == "R", 404).when(F.col("l_returnflag") == "A", 429).otherwise(200)
    probes = (
        t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").alias("attempt"))
        .agg(F.min(code).alias("code"))
        .join(registry.select("o_orderkey", "document_id"), "o_orderkey")
        .select("document_id", "attempt", "code", F.lit(False).alias("padded"))
    )
    missing = _missing(t).select(
        "document_type", "year", F.col("number").cast("int").alias("number"), F.lit(AS_OF).cast("timestamp_ntz").alias("detected_at")
    )
    year = top if mode == "current" else top + 1
    options = jobs.FetchOptions(mode=mode, year=year, max_per_run=None, base_url=BASE_URL)
    return jobs.run_fetch(
        empty(spark, "registry"), empty(spark, "fetch_results"), cursors, missing, probes, AS_OF, options
    )


@query(
    "fetch_run_results",
    ctes(REGISTRY, PROBES, _CURSORS, _LOG)
    + f"""SELECT document_id, type AS document_type, year, CAST(number AS INTEGER) AS number, '{BASE_URL}/' || document_id AS url,
  CASE code WHEN 200 THEN 'FETCHED' WHEN 429 THEN 'RATE_LIMITED' ELSE 'FAILED' END AS status, code = 200 AS exists FROM job""",
)
def fetch_run_results(spark, path):
    return _fetch_run(spark, path)["fetch_results"].drop("fetched_at", "error_message")


@query(
    "fetch_current_results",
    ctes(REGISTRY, PROBES, _CURSORS, _LOG.split("\njob AS")[0].rstrip(","))
    + f"""SELECT document_id, type AS document_type, year, CAST(number AS INTEGER) AS number, '{BASE_URL}/' || document_id AS url,
  CASE code WHEN 200 THEN 'FETCHED' WHEN 429 THEN 'RATE_LIMITED' ELSE 'FAILED' END AS status, code = 200 AS exists
FROM registry JOIN final USING (document_id) WHERE year = (SELECT year FROM top)""",
)
def fetch_current_results(spark, path):
    """A current-year run looks at numbers known to be missing again."""
    return _fetch_run(spark, path, "current")["fetch_results"].drop("fetched_at", "error_message")


@query(
    "fetch_run_not_found",
    ctes(REGISTRY, PROBES, _CURSORS, _LOG)
    + """SELECT type AS document_type, year, CAST(number AS INTEGER) AS number FROM missing
UNION SELECT type, year, CAST(number AS INTEGER) FROM job WHERE code NOT IN (200, 429)""",
)
def fetch_run_not_found(spark, path):
    return _fetch_run(spark, path)["not_found"].drop("detected_at")


def _state(t: Tables):
    return t.registry.select(
        "type", "year", F.col("number").cast("int").alias("number"), "url", F.lit(None).cast("string").alias("pdf_path"),
        F.lit(None).cast("string").alias("ocr_path"), F.lit(None).cast("string").alias("sha256"), F.lit(True).alias("exists"), "status",
    )


def _recorded(t: Tables):
    nothing = F.lit(None).cast("string")
    return t.registry.join(t.recorded, "o_orderkey", "left_semi").select(
        "document_id", "url", nothing.alias("pdf_path"), nothing.alias("sha256"), F.lit(0).cast("long").alias("file_size"),
        F.lit(None).cast("timestamp_ntz").alias("downloaded_at"), nothing.alias("error_message"),
    )


@query(
    "download_run",
    ctes(REGISTRY, INVENTORY, RECORDED, PRESENCE)
    + """, got AS (SELECT p.document_id, sha256(html) AS sha256 FROM presence p JOIN pages ON page_id = o_orderkey
  WHERE (status = 'FETCHED' OR (status = 'DOWNLOADED' AND NOT has_pdf)) AND NOT (is_recorded AND has_pdf))
SELECT document_id, CASE WHEN g.document_id IS NOT NULL THEN 'DOWNLOADED' ELSE status END AS status, g.sha256 FROM registry LEFT JOIN got g USING (document_id)""",
)
def download_run(spark, path):
    t = Tables(spark, path)
    payloads = t.pages.join(t.registry, F.col("page_id") == F.col("o_orderkey")).select(
        "document_id", F.encode("html", "UTF-8").alias("content")
    )
    out = jobs.run_download(_state(t), t.registry_inventory, _recorded(t), payloads, AS_OF)["registry"]
    return jobs.with_ids(out).select("document_id", "status", "sha256")


def _downloaded(t: Tables):
    nothing = F.lit(None).cast("string")
    return t.legal_text.select(
        "type", "year", F.col("number").cast("int").alias("number"), F.lit("u").alias("url"), nothing.alias("pdf_path"),
        nothing.alias("ocr_path"), nothing.alias("sha256"), F.lit(True).alias("exists"), F.lit("DOWNLOADED").alias("status"),
    )


_SCORE = _confidence_sql(
    f"SELECT document_id, unnest(regexp_split_to_array(lower(text), '{WORD_SEPARATOR}')) AS word FROM legal_text",
    text.LEGAL_TERMS["extractor"],
    "least(0.2, n / 100.0 * 0.2)",
)


@query(
    "extract_run",
    f"""WITH scored AS ({_SCORE}), stored AS (SELECT CASE WHEN doc_id % 2 = 0 THEN 'loi' ELSE 'decret' END || '-' || (1990 + doc_id % 30) || '-' || doc_id AS document_id,
  CASE WHEN quality = 1 THEN 0.9 ELSE 0.1 END AS old FROM labels)
SELECT document_id, CAST(CASE WHEN old IS NULL OR confidence > old THEN confidence ELSE old END AS DOUBLE) AS confidence,
  CASE WHEN old IS NULL OR confidence > old THEN 'OCR' ELSE 'OLD' END AS source FROM scored LEFT JOIN stored USING (document_id) WHERE n_articles > 0""",
)
def extract_run(spark, path):
    t = Tables(spark, path)
    stored = t.labels.join(t.legal_text.select("doc_id", "document_id"), "doc_id").select(
        "document_id", F.lit("{}").alias("json"), F.when(F.col("quality") == 1, 0.9).otherwise(0.1).alias("confidence"),
        F.lit("OLD").alias("source"),
    )
    options = jobs.ExtractOptions(signatories=tuple(_patterns()))
    out = jobs.run_extract(
        _downloaded(t), t.legal_text, stored, t.dictionary, empty(spark, "unrecognized_words"), AS_OF, options
    )
    return out["extractions"].select("document_id", F.round("confidence", 6).alias("confidence"), "source")


@query(
    "consolidate_run",
    ctes(LEGAL_TEXT, ARTICLES, json_parts_sql(), recursive=True)
    + "SELECT t.document_id, CASE WHEN p.document_id IS NULL THEN 'EXTRACTED' ELSE 'CONSOLIDATED' END AS status FROM legal_text t LEFT JOIN parts p USING (document_id)",
)
def consolidate_run(spark, path):
    t = Tables(spark, path)
    metadata, articles, signatories = stored_rows(t)
    registry = _downloaded(t).withColumn("status", F.lit("EXTRACTED"))
    out = jobs.run_consolidate(registry, built_json(t), metadata, articles, signatories, AS_OF)
    return jobs.with_ids(out["registry"]).select("document_id", "status")


@query(
    "consolidate_batch",
    ctes(LEGAL_TEXT, ARTICLES, json_parts_sql(), recursive=True)
    + """SELECT t.document_id, CASE WHEN t.year % 5 <> 0 THEN 'DOWNLOADED' WHEN p.document_id IS NULL THEN 'EXTRACTED' ELSE 'CONSOLIDATED' END AS status,
  (SELECT count(*) FROM article_rows a WHERE a.document_id = t.document_id AND t.year % 5 = 0 AND p.document_id IS NOT NULL) AS n_articles
FROM legal_text t LEFT JOIN parts p USING (document_id)""",
)
def consolidate_batch(spark, path):
    """Stored tables, of which only the years with extracted documents are read and replaced; a repeat changes nothing."""
    t = Tables(spark, path)
    store = StateTables(spark, scratch_path(spark, "store"))
    status = F.when(F.col("year") % 5 == 0, "EXTRACTED").otherwise("DOWNLOADED")
    store.apply({"registry": _downloaded(t).withColumn("status", status), "extractions": built_json(t).select(
        "document_id", "json", F.get_json_object("json", "$._metadata.confidence").cast("double").alias("confidence"), F.lit("OCR").alias("source"))})
    for _ in range(2):
        store.apply(batches.consolidate(store, AS_OF))
    articles = store.read("consolidated_articles").groupBy("document_id").agg(F.count(F.lit(1)).alias("n"))
    rows = jobs.with_ids(store.read("registry")).join(articles, "document_id", "left")
    return rows.select("document_id", "status", F.coalesce("n", F.lit(0).cast("long")).alias("n_articles"))


@query(
    "fetch_upsert_batch",
    ctes(REGISTRY, PROBES, _FETCH.format("s.status = 'RATE_LIMITED'").replace("ON l_orderkey = o_orderkey)", "ON l_orderkey = o_orderkey WHERE year % 3 = 0)"))
    + "SELECT document_id, status, exists FROM merged",
)
def fetch_upsert_batch(spark, path):
    """The fetch upsert into a stored table; the batch touches a third of the years."""
    store = StateTables(spark, scratch_path(spark, "store"))

    def whole(rows):
        key = ids.parse_document_id(F.col("document_id"))
        nothing = F.lit(None).cast("string")
        return rows.select(
            "document_id", key["type"].alias("document_type"), key["year"].alias("year"), key["number"].alias("number"),
            nothing.alias("url"), "status", "exists", F.lit(AS_OF).cast("timestamp_ntz").alias("fetched_at"), nothing.alias("error_message"),
        )

    stored, incoming = map(whole, _fetch_rows(Tables(spark, path)))
    store.write("fetch_results", stored)
    rule = lambda o, n: o["status"] == "RATE_LIMITED"
    store.apply({"fetch_results": batches.merge(store, "fetch_results", incoming.where("year % 3 = 0"), ["document_id"], rule)})
    return store.read("fetch_results").select("document_id", "status", "exists")


@query(
    "fix_run",
    ctes(*_BASE, _ALL, _fold_sql("DESC", "CAST(NULL AS VARCHAR)"), recursive=True)
    + "SELECT d.document_id, coalesce(max_by(f.status_after, f.k), any_value(d.status)) AS status FROM docs d LEFT JOIN fold f USING (document_id) GROUP BY 1",
)
def fix_run(spark, path):
    t = Tables(spark, path)
    figures = extraction_figures(t).join(t.registry.select("o_orderkey", "document_id"), "o_orderkey")
    figures = figures.where("confidence IS NOT NULL")
    article = F.array_repeat(F.struct(F.lit(1).alias("index")), F.col("n_articles").cast("int"))
    json = F.to_json(
        F.struct(
            F.struct(
                "confidence",
                F.struct(
                    F.col("sequence_issues").alias("gaps"), F.lit(0).alias("duplicates"), F.lit(0).alias("outOfOrder")
                ).alias("sequenceIssues"),
                F.col("unknown_rate").alias("unrecognizedWordsRate"),
            ).alias("_metadata"),
            article.alias("articles"),
        )
    )
    extractions = figures.select("document_id", json.alias("json"))
    out = jobs.run_fix(_state(t), t.registry_inventory, _recorded(t), extractions)
    return jobs.with_ids(out["registry"]).select("document_id", "status")


# The cascade: two thirds of the documents start with poor JSON; labelled ones have a corrected
# text, good ones a corrected JSON, English ones a full extraction.
_CASCADE = """k AS (SELECT p.*, d.doc_id, d.lang, l.quality AS label, 0.69 + CASE WHEN NOT p.strict THEN -0.15 ELSE 0 END + CASE WHEN p.n_signatories > 0 THEN 0.1 ELSE 0 END AS good,
    CASE d.doc_id % 3 WHEN 0 THEN 0.0 WHEN 1 THEN 0.3 END AS poor
  FROM parts p JOIN documents d ON d.doc_id = p.number LEFT JOIN labels l ON l.doc_id = d.doc_id),
a AS (SELECT *, label IS NOT NULL AND confidence < 0.3 AND 0.9 > confidence AS use_text FROM k),
b AS (SELECT *, CASE WHEN use_text THEN 0.9 ELSE confidence END AS c1, CASE WHEN use_text THEN 'OCR_CORRECTED' ELSE 'OCR' END AS s1,
    CASE WHEN use_text THEN good ELSE coalesce(poor, good) END AS q1 FROM a),
c AS (SELECT *, label = 1 AND q1 < 0.5 AND good > q1 AS use_json FROM b),
d AS (SELECT *, coalesce(use_json, false) AS uj FROM c),
e AS (SELECT *, CASE WHEN uj THEN good ELSE q1 END AS q2, CASE WHEN uj THEN 0.9 ELSE c1 END AS c2, CASE WHEN uj THEN 'JSON_CORRECTED' ELSE s1 END AS s2 FROM d),
f AS (SELECT *, lang = 'en' AND q2 < 0.5 AND good > q2 AS use_full FROM e)"""


@query(
    "cascade_quality",
    ctes(LEGAL_TEXT, ARTICLES, json_parts_sql(), _CASCADE, recursive=True)
    + """SELECT document_id, CASE WHEN use_full THEN 'FULL' ELSE s2 END AS source, round(CAST(CASE WHEN use_full THEN 0.9 ELSE c2 END AS DOUBLE), 6) AS confidence,
  round(CAST(CASE WHEN use_full THEN good ELSE q2 END AS DOUBLE), 6) AS quality, round(CASE WHEN use_full THEN good ELSE q2 END, 6) >= 0.5 AS accepted FROM f""",
)
def cascade_quality(spark, path):
    t = Tables(spark, path)
    from lexmill.session import materialize

    built = materialize(built_json(t).withColumnRenamed("number", "doc_id").drop("type", "year"), "built")
    confidence = F.get_json_object("json", "$._metadata.confidence").cast("double")
    poor = F.when(F.col("doc_id") % 3 == 0, "{}").when(F.col("doc_id") % 3 == 1, '{"articles": [{"index": 1}]}')
    base = built.select(
        "document_id", F.coalesce(poor, "json").alias("json"), confidence.alias("confidence"), F.lit("OCR").alias("source")
    )
    labelled = built.join(t.labels, "doc_id", "left_semi")
    good = built.join(t.labels.where("quality = 1"), "doc_id", "left_semi")
    english = built.join(t.documents.where("lang = 'en'").select("doc_id"), "doc_id", "left_semi")
    best = cascade.choose(base, labelled, good, english)
    return best.select(
        "document_id", "source", F.round("confidence", 6).alias("confidence"), F.round("quality", 6).alias("quality"), "accepted"
    )


@query(
    "full_run",
    ctes(LEGAL_TEXT, ARTICLES, json_parts_sql(), recursive=True)
    + """SELECT t.document_id, CASE WHEN t.number % 4 = 0 THEN 'FAILED' WHEN t.number % 4 = 1 THEN 'RATE_LIMITED'
  WHEN p.document_id IS NULL THEN 'FAILED' ELSE 'CONSOLIDATED' END AS status FROM legal_text t LEFT JOIN parts p USING (document_id)""",
)
def full_run(spark, path):
    """Named documents through every job: some do not exist, some are turned away by the server."""
    t = Tables(spark, path)
    texts = t.legal_text
    code = F.when(F.col("number") % 4 == 0, 404).when(F.col("number") % 4 == 1, 429).otherwise(200)
    tables = {name: empty(spark, name) for name in TABLES} | {
        "probe_results": texts.select("document_id", F.lit(1).alias("attempt"), code.alias("code"), F.lit(False).alias("padded")),
        "payloads": texts.select("document_id", F.encode("text", "UTF-8").alias("content")),
        "texts": texts.select("document_id", "type", "text"),
        "dictionary": t.dictionary,
    }
    options = jobs.ExtractOptions(signatories=tuple(_patterns()))
    out = jobs.run_full(tables, texts.select("document_id"), AS_OF, options)["registry"]
    return jobs.with_ids(out).select("document_id", "status")

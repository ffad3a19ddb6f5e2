"""Queries that compute the next snapshot of a state table."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill.catalog import query
from lexmill.catalog.chunk_queries import built_json, json_parts_sql
from lexmill.catalog.views import ARTICLES, LEGAL_TEXT, PROBES, REGISTRY, Tables, ctes
from lexmill.functions import ids
from lexmill.operators import consolidate as cons
from lexmill.operators import upsert
from lexmill.session import materialize

# Stored results: orders that are F (fetched) or P (rate-limited); every probed order comes in again.
_FETCH = """stored AS (SELECT document_id, CASE status WHEN 'FETCHED' THEN 'FETCHED' ELSE 'RATE_LIMITED' END AS status, status = 'FETCHED' AS exists
  FROM registry WHERE status IN ('FETCHED', 'DOWNLOADED')),
incoming AS (SELECT document_id, CASE WHEN code = 404 AND n_attempts < 10 THEN padded_code ELSE code END AS final
  FROM registry JOIN probes ON l_orderkey = o_orderkey),
inc AS (SELECT document_id, CASE final WHEN 200 THEN 'FETCHED' WHEN 429 THEN 'RATE_LIMITED' ELSE 'FAILED' END AS status, final = 200 AS exists FROM incoming),
merged AS (SELECT coalesce(s.document_id, i.document_id) AS document_id,
    CASE WHEN s.document_id IS NULL OR (i.document_id IS NOT NULL AND ({0})) THEN i.status ELSE s.status END AS status,
    CASE WHEN s.document_id IS NULL OR (i.document_id IS NOT NULL AND ({0})) THEN i.exists ELSE s.exists END AS exists,
    CASE WHEN i.document_id IS NULL THEN 'kept' WHEN s.document_id IS NULL THEN 'new' WHEN {0} THEN 'updated' ELSE 'skipped' END AS change
  FROM stored s FULL JOIN inc i USING (document_id))"""


def _fetch_rows(t: Tables):
    status = F.when(F.col("status") == "FETCHED", "FETCHED").otherwise("RATE_LIMITED")
    stored = t.registry.where(F.col("status").isin("FETCHED", "DOWNLOADED")).select(
        "document_id", status.alias("status"), (F.col("status") == "FETCHED").alias("exists")
    )
    outcome = ids.probe_status(F.col("code"), F.col("n_attempts"), F.col("padded_code"))
    incoming = (
        t.registry.select("o_orderkey", "document_id")
        .join(t.probes, "o_orderkey")
        .select("document_id", outcome.alias("p"))
        .select("document_id", "p.status", "p.exists")
    )
    return stored, incoming


@query("fetch_upsert", ctes(REGISTRY, PROBES, _FETCH.format("s.status = 'RATE_LIMITED'")) + "SELECT * FROM merged")
def fetch_upsert(spark, path):
    return upsert.upsert_fetch_results(*_fetch_rows(Tables(spark, path)))


@query("fetch_upsert_forced", ctes(REGISTRY, PROBES, _FETCH.format("true")) + "SELECT * FROM merged")
def fetch_upsert_forced(spark, path):
    return upsert.upsert_fetch_results(*_fetch_rows(Tables(spark, path)), force=True)


@query(
    "fetch_counters",
    ctes(REGISTRY, PROBES, _FETCH.format("s.status = 'RATE_LIMITED'"))
    + "SELECT count(*) FILTER (change = 'new') AS n_new, count(*) FILTER (change = 'updated') AS n_updated, count(*) FILTER (change = 'skipped') AS n_skipped FROM merged",
)
def fetch_counters(spark, path):
    return upsert.change_counts(upsert.upsert_fetch_results(*_fetch_rows(Tables(spark, path))))


@query(
    "registry_upsert",
    ctes(REGISTRY, PROBES)
    + """SELECT type, year, number, url, CASE WHEN p.code = 429 THEN 'FETCHED' ELSE status END AS status FROM registry LEFT JOIN probes p ON l_orderkey = o_orderkey""",
)
def registry_upsert(spark, path):
    t = Tables(spark, path)
    limited = F.when(F.col("code") == 429, "RATE_LIMITED").otherwise(F.col("status"))
    stored = t.registry.join(t.probes, "o_orderkey", "left").select(
        "type", "year", "number", "url", limited.alias("status")
    )
    found = t.registry.select(
        "type", "year", "number", F.lit(None).cast("string").alias("url"), F.lit("FETCHED").alias("status")
    )
    return upsert.upsert_registry(stored, found).drop("change")


@query(
    "insert_ignore",
    ctes(REGISTRY)
    + """, stored AS (SELECT type, year, number, '2024-01-01' AS detected FROM registry WHERE status = 'FETCHED'),
inc AS (SELECT type, year, number, min(strftime(l_shipdate, '%Y-%m-%d')) AS detected FROM lineitem JOIN registry ON o_orderkey = l_orderkey WHERE l_returnflag = 'R' GROUP BY 1, 2, 3)
SELECT * FROM stored UNION ALL SELECT * FROM inc WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.type = inc.type AND s.year = inc.year AND s.number = inc.number)""",
)
def insert_ignore(spark, path):
    t = Tables(spark, path)
    key = ["type", "year", "number"]
    stored = t.registry.where("status = 'FETCHED'").select(*key, F.lit("2024-01-01").alias("detected"))
    incoming = (
        t.lineitem.where("l_returnflag = 'R'")
        .groupBy("l_orderkey")  # repeats of an order combine before the join
        .agg(F.min("l_shipdate").alias("shipped"))
        .join(t.registry, F.col("o_orderkey") == F.col("l_orderkey"))
        .select(*key, F.date_format("shipped", "yyyy-MM-dd").alias("detected"))
    )
    return upsert.insert_ignore(stored, incoming, key)


@query(
    "bulk_status",
    ctes(REGISTRY) + "SELECT document_id, CASE status WHEN 'DOWNLOADED' THEN 'FETCHED' ELSE status END AS status FROM registry",
)
def bulk_status(spark, path):
    return upsert.move_status(Tables(spark, path).registry, "DOWNLOADED", "FETCHED").select("document_id", "status")


@query(
    "record_errors",
    ctes(REGISTRY, PROBES)
    + "SELECT document_id, CASE WHEN p.code = 404 THEN 'FAILED' ELSE status END AS status FROM registry LEFT JOIN probes p ON l_orderkey = o_orderkey",
)
def record_errors(spark, path):
    t = Tables(spark, path)
    failed = t.registry.join(t.probes.where("code = 404"), "o_orderkey", "left_semi")
    return upsert.record_errors(t.registry, failed).select("document_id", "status")


# Extraction candidates: the best line of each order competes with a stored confidence.
_BETTER = """stored AS (SELECT document_id, o_orderkey, (o_custkey % 100) / 100.0 AS confidence, 'stored' AS source FROM registry JOIN orders USING (o_orderkey) WHERE status <> 'FETCHED'),
cand AS (SELECT document_id, max(round(1.0 - l_discount * 4 - l_tax, 6)) AS confidence, 'line' AS source FROM lineitem JOIN registry ON o_orderkey = l_orderkey GROUP BY 1)"""


def _better_rows(t: Tables):
    confidence = ((F.col("o_custkey") % 100) / 100.0).alias("confidence")
    stored = (
        t.registry.where("status <> 'FETCHED'")
        .join(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey")
        .select("document_id", confidence, F.lit("stored").alias("source"))
    )
    score = F.round(F.lit(1.0) - F.col("l_discount") * 4 - F.col("l_tax"), 6)
    candidate = (
        t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.max(score).alias("confidence"))
        .join(t.registry.select("o_orderkey", "document_id"), "o_orderkey")
        .select("document_id", "confidence", F.lit("line").alias("source"))
    )
    return stored, candidate


@query(
    "keep_better",
    ctes(REGISTRY, _BETTER)
    + """SELECT coalesce(s.document_id, c.document_id) AS document_id,
  CAST(CASE WHEN s.document_id IS NULL OR c.confidence > s.confidence THEN c.confidence ELSE s.confidence END AS DOUBLE) AS confidence,
  CASE WHEN s.document_id IS NULL OR c.confidence > s.confidence THEN c.source ELSE s.source END AS source FROM stored s FULL JOIN cand c USING (document_id)""",
)
def keep_better(spark, path):
    return upsert.keep_better(*_better_rows(Tables(spark, path))).drop("change")


@query(
    "reprocess_policy",
    ctes(REGISTRY, _BETTER)
    + """SELECT c.document_id, coalesce(c.confidence > s.confidence + 0.1, true) AS by_confidence, s.document_id IS NULL AS by_never, true AS by_always
FROM cand c LEFT JOIN stored s USING (document_id)""",
)
def reprocess_policy(spark, path):
    stored, candidate = _better_rows(Tables(spark, path))
    old = stored.select("document_id", F.struct("confidence", "source").alias("old"))
    new = candidate.select("document_id", F.struct("confidence", "source").alias("new"))
    policies = {
        "by_confidence": upsert.better_by_confidence(0.1),
        "by_never": upsert.never,
        "by_always": upsert.always,
    }
    return new.join(old, "document_id", "left").select(
        "document_id",
        *[upsert.reprocess_flag(p, F.col("old"), F.col("new")).alias(n) for n, p in policies.items()],
    )


@query(
    "download_upsert",
    ctes(REGISTRY)
    + """, stored AS (SELECT document_id, url, 'old' AS sha256 FROM registry WHERE status = 'DOWNLOADED'),
present AS (SELECT document_id FROM registry WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')),
inc AS (SELECT document_id, url, sha256(document_id) AS sha256 FROM registry WHERE status IN ('FETCHED', 'DOWNLOADED'))
SELECT coalesce(s.document_id, i.document_id) AS document_id, coalesce(s.url, i.url) AS url,
  CASE WHEN s.document_id IS NULL OR (i.document_id IS NOT NULL AND s.document_id NOT IN (SELECT document_id FROM present)) THEN i.sha256 ELSE s.sha256 END AS sha256
FROM stored s FULL JOIN inc i USING (document_id)""",
)
def download_upsert(spark, path):
    t = Tables(spark, path)
    stored = t.registry.where("status = 'DOWNLOADED'").select("document_id", "url", F.lit("old").alias("sha256"))
    incoming = t.registry.where(F.col("status").isin("FETCHED", "DOWNLOADED")).select(
        "document_id", "url", F.sha2("document_id", 256).alias("sha256")
    )
    present = t.registry_inventory.where("kind = 'pdf'").select("document_id").distinct()
    return upsert.upsert_downloads(stored, incoming, present).drop("change")


@query(
    "cascade_delete",
    ctes(REGISTRY)
    + "SELECT document_id, l_linenumber, l_partkey, l_suppkey FROM lineitem JOIN registry ON o_orderkey = l_orderkey WHERE status <> 'FETCHED'",
)
def cascade_delete(spark, path):
    t = Tables(spark, path)
    articles = t.lineitem.join(t.registry, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "document_id", "l_linenumber", "l_partkey", "l_suppkey"
    )
    return upsert.delete_documents(articles, t.registry.where("status = 'FETCHED'"))


# Consolidation: labelled texts were consolidated before, with the confidence their label implies.
_STORED = """stored AS (SELECT t.document_id, CASE WHEN quality = 1 THEN 0.5 ELSE 0.04 END AS old_confidence FROM labels JOIN legal_text t USING (doc_id)),
gated AS (SELECT p.*, s.old_confidence FROM parts p LEFT JOIN stored s USING (document_id) WHERE s.document_id IS NULL OR p.confidence > s.old_confidence)"""
_CONSOLIDATE = (LEGAL_TEXT, ARTICLES, json_parts_sql(), _STORED)


def stored_rows(t: Tables):
    """(metadata, articles, signatories) of earlier runs."""
    as_of = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    old = t.labels.join(t.legal_text.select("doc_id", "document_id", "type", "year", "number"), "doc_id")
    confidence = F.when(F.col("quality") == 1, 0.5).otherwise(0.04)
    nothing = F.lit(None).cast("string")
    metadata = old.select(
        "document_id", F.col("type").alias("document_type"), F.col("year").alias("document_year"),
        F.col("number").cast("int").alias("document_number"), F.lit("old title").alias("title"),
        nothing.alias("promulgation_date"), F.lit("Abomey").alias("promulgation_city"), F.lit(2).alias("total_articles"),
        nothing.alias("source_url"), confidence.alias("extraction_confidence"), F.lit("OLD").alias("extraction_method"),
        nothing.alias("extraction_timestamp"), as_of.alias("consolidated_at"),
    )
    articles = old.select(
        "document_id", F.explode(F.array(F.lit(1), F.lit(99))).alias("article_index"), F.lit("old").alias("content"),
        F.col("type").alias("document_type"), F.col("year").alias("document_year"),
        F.col("number").cast("int").alias("document_number"), confidence.alias("extraction_confidence"),
        F.lit("OLD").alias("extraction_method"), as_of.alias("consolidated_at"),
    )
    signatories = old.select(
        "document_id", F.lit(1).alias("signatory_order"), F.lit("Ancien").alias("role"), F.lit("X").alias("name"),
        F.to_date(F.lit("2001-02-03")).alias("mandate_start"), F.to_date(F.lit("2002-02-03")).alias("mandate_end"),
        F.col("type").alias("document_type"), F.col("year").alias("document_year"), as_of.alias("consolidated_at"),
    )
    return metadata, articles, signatories


def consolidation(t: Tables, prune_stale: bool = False):
    as_of = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    registry = t.legal_text.select(
        "document_id", "type", "year", F.col("number").cast("int").alias("number"),
        F.concat(F.lit("u/"), "document_id").alias("url"), F.lit("EXTRACTED").alias("status"),
    )
    metadata, articles, signatories = stored_rows(t)
    parsed = materialize(cons.parse(built_json(t), registry), "parsed")  # all three tables read it
    return parsed, metadata, articles, signatories, as_of


@query("consolidate_gate", ctes(*_CONSOLIDATE, recursive=True) + "SELECT document_id, CAST(confidence AS DOUBLE) AS confidence FROM gated")
def consolidate_gate(spark, path):
    parsed, metadata, *_ = consolidation(Tables(spark, path))
    return cons.gate(parsed, metadata).select("document_id", F.col("doc._metadata.confidence").alias("confidence"))


@query(
    "consolidate_metadata",
    ctes(*_CONSOLIDATE, recursive=True)
    + """SELECT coalesce(s.document_id, g.document_id) AS document_id, coalesce(g.title, CASE WHEN s.document_id IS NOT NULL THEN 'old title' END) AS title,
  g.promulgation_date, coalesce(g.promulgation_city, CASE WHEN s.document_id IS NOT NULL THEN 'Abomey' END) AS promulgation_city,
  CAST(coalesce(g.n_articles, 2) AS INTEGER) AS total_articles, CASE WHEN g.document_id IS NOT NULL THEN 'u/' || g.document_id END AS source_url,
  CAST(coalesce(g.confidence, s.old_confidence) AS DOUBLE) AS extraction_confidence, CASE WHEN g.document_id IS NULL THEN 'OLD' ELSE 'OCR' END AS extraction_method
FROM stored s FULL JOIN gated g USING (document_id)""",
)
def consolidate_metadata(spark, path):
    out = cons.consolidate(*consolidation(Tables(spark, path)))["consolidated_metadata"]
    return out.select(
        "document_id", "title", "promulgation_date", "promulgation_city", "total_articles", "source_url",
        "extraction_confidence", "extraction_method",
    )


_ARTICLE_MERGE = """, old AS (SELECT document_id, unnest([1, 99]) AS article_index, 'old' AS content, 'OLD' AS extraction_method FROM stored {0}),
fresh AS (SELECT document_id, article_index, content, 'OCR' AS extraction_method FROM gated JOIN article_rows USING (document_id))
SELECT document_id, CAST(article_index AS INTEGER) AS article_index, coalesce(f.content, o.content) AS content, coalesce(f.extraction_method, o.extraction_method) AS extraction_method
FROM old o FULL JOIN fresh f USING (document_id, article_index)"""


@query("consolidate_articles", ctes(*_CONSOLIDATE, recursive=True) + _ARTICLE_MERGE.format(""))
def consolidate_articles(spark, path):
    out = cons.consolidate(*consolidation(Tables(spark, path)))["consolidated_articles"]
    return out.select("document_id", "article_index", "content", "extraction_method")


@query(
    "consolidate_articles_pruned",
    ctes(*_CONSOLIDATE, recursive=True) + _ARTICLE_MERGE.format("WHERE document_id NOT IN (SELECT document_id FROM gated)"),
)
def consolidate_articles_pruned(spark, path):
    out = cons.consolidate(*consolidation(Tables(spark, path)), prune_stale=True)["consolidated_articles"]
    return out.select("document_id", "article_index", "content", "extraction_method")


def _signatory_merge_sql() -> str:
    from lexmill.catalog.views import SIGNATORIES

    arms = "\nUNION ALL ".join(
        f"SELECT document_id, {i} AS pos, '{s['role']}' AS role, '{s['name']}' AS name, "
        f"{'CAST(NULL AS VARCHAR)' if s['start_date'] is None else repr(s['start_date'])} AS mandate_start, "
        f"{'CAST(NULL AS VARCHAR)' if s['end_date'] is None else repr(s['end_date'])} AS mandate_end "
        f"FROM legal_text WHERE regexp_matches(text, '{s['pattern']}')"
        for i, s in enumerate(SIGNATORIES)
    )
    return (
        ctes(*_CONSOLIDATE, recursive=True)
        + f""", found AS (SELECT *, CAST(row_number() OVER (PARTITION BY document_id ORDER BY pos) AS INTEGER) AS signatory_order FROM ({arms})),
fresh AS (SELECT f.* FROM found f JOIN gated g USING (document_id)),
old AS (SELECT document_id, CAST(1 AS INTEGER) AS signatory_order, 'Ancien' AS role, 'X' AS name FROM stored)
SELECT document_id, signatory_order, coalesce(f.role, o.role) AS role, coalesce(f.name, o.name) AS name,
  coalesce(f.mandate_start, CASE WHEN o.document_id IS NOT NULL THEN '2001-02-03' END) AS mandate_start,
  coalesce(f.mandate_end, CASE WHEN o.document_id IS NOT NULL THEN '2002-02-03' END) AS mandate_end
FROM old o FULL JOIN fresh f USING (document_id, signatory_order)"""
    )


@query("consolidate_signatories", _signatory_merge_sql())
def consolidate_signatories(spark, path):
    out = cons.consolidate(*consolidation(Tables(spark, path)))["consolidated_signatories"]
    return out.select(
        "document_id", "signatory_order", "role", "name",
        F.col("mandate_start").cast("string").alias("mandate_start"), F.col("mandate_end").cast("string").alias("mandate_end"),
    )


@query(
    "consolidate_status",
    ctes(REGISTRY, PROBES)
    + """SELECT document_id, CASE WHEN status = 'EXTRACTED' AND code = 200 THEN 'CONSOLIDATED' ELSE 'FAILED' END AS status
FROM registry JOIN probes ON l_orderkey = o_orderkey""",
)
def consolidate_status(spark, path):
    t = Tables(spark, path)
    joined = t.registry.join(t.probes, "o_orderkey")
    return joined.select(
        "document_id", cons.next_status(F.col("status"), F.col("code") == 200).alias("status")
    )


@query(
    "consolidate_counters",
    ctes(REGISTRY, PROBES)
    + """SELECT count(*) FILTER (status = 'EXTRACTED' AND code = 200) AS n_consolidated, count(*) FILTER (NOT (status = 'EXTRACTED' AND code = 200)) AS n_failed
FROM registry JOIN probes ON l_orderkey = o_orderkey""",
)
def consolidate_counters(spark, path):
    return cons.status_counts(consolidate_status(spark, path))

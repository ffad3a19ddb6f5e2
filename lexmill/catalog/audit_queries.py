"""Queries that detect issues and plan repairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill.catalog import query
from lexmill.catalog.text_queries import ARTICLE_ORDER, _line_order
from lexmill.catalog.views import INVENTORY, PRESENCE, RECORDED, REGISTRY, Tables, ctes
from lexmill.operators import audit
from lexmill.operators.sequence import sequence_counts

# Figures of an extraction, taken from the order's lines.
_FIGURES = f"""steps AS (SELECT l_orderkey, l_linenumber - lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY {ARTICLE_ORDER}) AS d FROM lineitem),
seq AS (SELECT l_orderkey, CAST(coalesce(sum(CASE WHEN d > 1 THEN d - 1 END), 0) + count(*) FILTER (d = 0) + count(*) FILTER (d < 0) AS BIGINT) AS sequence_issues FROM steps GROUP BY 1),
figures AS (SELECT l_orderkey, 1.0 - max(l_discount) * 8 AS confidence, max(l_tax) * 8 AS unknown_rate, count(*) FILTER (l_quantity > 25) AS n_articles FROM lineitem GROUP BY 1),
docs AS (SELECT p.*, f.confidence, f.unknown_rate, f.n_articles, s.sequence_issues FROM presence p LEFT JOIN figures f ON f.l_orderkey = p.o_orderkey LEFT JOIN seq s ON s.l_orderkey = p.o_orderkey)"""

_STATUS = """SELECT document_id, status, 'STUCK_IN_PENDING' AS issue_type, 'MEDIUM' AS severity, 0 AS detector FROM docs WHERE status = 'PENDING'
UNION ALL SELECT document_id, status, 'STATUS_INCONSISTENT', 'MEDIUM', 1 FROM docs WHERE status = 'FETCHED' AND is_recorded AND has_pdf
UNION ALL SELECT document_id, status, 'STUCK_IN_FETCHED', 'HIGH', 2 FROM docs WHERE status = 'FETCHED' AND NOT (is_recorded AND has_pdf)
UNION ALL SELECT document_id, status, 'STUCK_IN_DOWNLOADED', 'HIGH', 3 FROM docs WHERE status = 'DOWNLOADED'
UNION ALL SELECT document_id, status, 'STUCK_IN_EXTRACTED', 'MEDIUM', 4 FROM docs WHERE status = 'EXTRACTED'"""
_FILES = """SELECT document_id, status, 'MISSING_PDF' AS issue_type, 'CRITICAL' AS severity, 5 AS detector FROM docs WHERE status IN ('DOWNLOADED', 'EXTRACTED', 'CONSOLIDATED') AND NOT has_pdf
UNION ALL SELECT document_id, status, 'MISSING_OCR', 'HIGH', 6 FROM docs WHERE status IN ('EXTRACTED', 'CONSOLIDATED') AND NOT has_ocr
UNION ALL SELECT document_id, status, 'MISSING_JSON', 'CRITICAL', 7 FROM docs WHERE status IN ('EXTRACTED', 'CONSOLIDATED') AND NOT has_json"""
_CHECKED = "status IN ('EXTRACTED', 'CONSOLIDATED') AND has_json"
_QUALITY = f"""SELECT document_id, status, 'LOW_CONFIDENCE' AS issue_type, 'HIGH' AS severity, 8 AS detector FROM docs WHERE {_CHECKED} AND confidence < 0.3
UNION ALL SELECT document_id, status, 'SEQUENCE_ISSUES', 'MEDIUM', 9 FROM docs WHERE {_CHECKED} AND sequence_issues > 0
UNION ALL SELECT document_id, status, 'HIGH_UNRECOGNIZED_WORDS', 'MEDIUM', 10 FROM docs WHERE {_CHECKED} AND unknown_rate > 0.5
UNION ALL SELECT document_id, status, 'MISSING_ARTICLES', 'CRITICAL', 11 FROM docs WHERE {_CHECKED} AND coalesce(n_articles, 0) = 0"""

_BASE = (REGISTRY, INVENTORY, RECORDED, PRESENCE, _FIGURES)


def extraction_figures(t: Tables):
    """(o_orderkey, confidence, unknown_rate, n_articles, sequence_issues) of orders that have lines."""
    figures = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        (F.lit(1.0) - F.max("l_discount") * 8).alias("confidence"),
        (F.max("l_tax") * 8).alias("unknown_rate"),
        F.count_if(F.col("l_quantity") > 25).alias("n_articles"),
    )
    counts = sequence_counts(
        t.lineitem, "l_orderkey", "l_linenumber", _line_order(), sized_by=t.lineitem.select("l_orderkey")
    )
    issues = counts.select(
        F.col("l_orderkey").alias("o_orderkey"),
        (F.col("gaps") + F.col("duplicates") + F.col("inversions")).alias("sequence_issues"),
    )
    return figures.join(issues, "o_orderkey", "left")


def documents(t: Tables):
    """Registry rows with presence flags and extraction figures."""
    return t.presence.join(extraction_figures(t), "o_orderkey", "left")


def all_detectors():
    return audit.status_issues() + audit.file_issues() + audit.quality_issues()


@query("issues_status", ctes(*_BASE) + f"SELECT document_id, issue_type, severity FROM ({_STATUS})")
def issues_status(spark, path):
    rows = audit.issue_rows(audit.detect(Tables(spark, path).presence, audit.status_issues()))
    return rows.select("document_id", "issue_type", "severity")


@query("issues_files", ctes(*_BASE) + f"SELECT document_id, issue_type, severity FROM ({_FILES})")
def issues_files(spark, path):
    rows = audit.issue_rows(audit.detect(Tables(spark, path).presence, audit.file_issues()))
    return rows.select("document_id", "issue_type", "severity")


@query("issues_quality", ctes(*_BASE) + f"SELECT document_id, issue_type, severity FROM ({_QUALITY})")
def issues_quality(spark, path):
    rows = audit.issue_rows(audit.detect(documents(Tables(spark, path)), audit.quality_issues()))
    return rows.select("document_id", "issue_type", "severity")


_ALL = f"""found AS ({_STATUS} UNION ALL {_FILES} UNION ALL {_QUALITY}),
placed AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY detector) - 1 AS position,
  CASE severity WHEN 'CRITICAL' THEN 0 WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 ELSE 3 END AS ordinal FROM found)"""


@query(
    "issues_all",
    ctes(*_BASE, _ALL) + "SELECT document_id, issue_type, severity, CAST(position AS INTEGER) AS position FROM placed",
)
def issues_all(spark, path):
    rows = audit.issue_rows(audit.detect(documents(Tables(spark, path)), all_detectors()))
    return rows.select("document_id", "issue_type", "severity", "position")


def _fold_sql(order: str, inconsistent: str) -> str:
    """Repairs in order; `inconsistent` is the status a STATUS_INCONSISTENT issue leads to, or NULL."""
    back = (
        "CASE {0} WHEN 'FETCHED' THEN 'PENDING' WHEN 'DOWNLOADED' THEN 'FETCHED' "
        "WHEN 'EXTRACTED' THEN 'DOWNLOADED' WHEN 'CONSOLIDATED' THEN 'EXTRACTED' END"
    )
    after = (
        "CASE WHEN {t} LIKE 'STUCK%' THEN coalesce(" + back + ", {0}) WHEN {t} = 'MISSING_PDF' THEN 'FETCHED' "
        "WHEN {t} = 'STATUS_INCONSISTENT' THEN coalesce(" + inconsistent + ", {0}) ELSE 'DOWNLOADED' END"
    )
    outcome = (
        "CASE WHEN {t} = 'STATUS_INCONSISTENT' AND " + inconsistent + " IS NULL THEN 'SKIPPED' "
        "WHEN {t} LIKE 'STUCK%' AND {0} <> 'PENDING' AND (" + back + ") IS NULL THEN 'FAILED' ELSE 'SUCCESS' END"
    )
    return f"""queue AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY ordinal {order}, position) AS k FROM placed),
fold AS (
  SELECT document_id, k, issue_type, severity, status AS status_before, {outcome.format('status', t='issue_type')} AS fix_status,
    {after.format('status', t='issue_type')} AS status_after FROM queue WHERE k = 1
  UNION ALL
  SELECT q.document_id, q.k, q.issue_type, q.severity, f.status_after, {outcome.format('f.status_after', t='q.issue_type')},
    {after.format('f.status_after', t='q.issue_type')}
  FROM fold f JOIN queue q ON q.document_id = f.document_id AND q.k = f.k + 1)
"""


_FIX_COLUMNS = "document_id, CAST(k - 1 AS INTEGER) AS position, issue_type, severity, status_before, fix_status, status_after"


def planned(t: Tables, **options):
    return audit.plan_repairs(audit.detect(documents(t), all_detectors()), **options)


@query("fix_plan", ctes(*_BASE, _ALL, _fold_sql("DESC", "CAST(NULL AS VARCHAR)"), recursive=True) + f"SELECT {_FIX_COLUMNS} FROM fold")
def fix_plan(spark, path):
    return audit.fix_rows(planned(Tables(spark, path)))


@query(
    "fix_plan_critical_first",
    ctes(*_BASE, _ALL, _fold_sql("ASC", "'DOWNLOADED'"), recursive=True) + f"SELECT {_FIX_COLUMNS} FROM fold",
)
def fix_plan_critical_first(spark, path):
    return audit.fix_rows(planned(Tables(spark, path), critical_first=True, route_inconsistent=True))


@query(
    "fix_final_status",
    ctes(*_BASE, _ALL, _fold_sql("DESC", "CAST(NULL AS VARCHAR)"), recursive=True)
    + "SELECT d.document_id, coalesce(max_by(f.status_after, f.k), any_value(d.status)) AS final_status FROM docs d LEFT JOIN fold f USING (document_id) GROUP BY 1",
)
def fix_final_status(spark, path):
    return planned(Tables(spark, path)).select("document_id", "final_status")


@query(
    "fix_summary",
    ctes(*_BASE, _ALL, _fold_sql("DESC", "CAST(NULL AS VARCHAR)"), recursive=True)
    + """SELECT d.document_id, count(*) FILTER (fix_status = 'SUCCESS') AS n_success, count(*) FILTER (fix_status = 'FAILED') AS n_failed,
  count(*) FILTER (fix_status = 'SKIPPED') AS n_skipped FROM docs d LEFT JOIN fold f USING (document_id) GROUP BY 1""",
)
def fix_summary(spark, path):
    return audit.fix_summary(planned(Tables(spark, path)))


@query(
    "status_rollback",
    ctes(REGISTRY)
    + "SELECT document_id, CASE status WHEN 'FETCHED' THEN 'PENDING' WHEN 'DOWNLOADED' THEN 'FETCHED' WHEN 'EXTRACTED' THEN 'DOWNLOADED' END AS status FROM registry",
)
def status_rollback(spark, path):
    return Tables(spark, path).registry.select("document_id", audit.rollback_status(F.col("status")).alias("status"))


@query(
    "issues_catalogued",
    ctes(*_BASE)
    + """SELECT document_id, 'CORRUPTED_PDF' AS issue_type, 'CRITICAL' AS severity FROM docs WHERE status IN ('DOWNLOADED', 'EXTRACTED') AND has_pdf AND unknown_rate > 0.3
UNION ALL SELECT document_id, 'INCONSISTENT_DATA', 'HIGH' FROM docs WHERE status = 'EXTRACTED' AND has_json AND n_articles <> sequence_issues""",
)
def issues_catalogued(spark, path):
    docs = documents(Tables(spark, path)).withColumns(
        {
            "status": F.when((F.col("status") == "EXTRACTED") & F.col("has_json"), "CONSOLIDATED").otherwise(F.col("status")),
            "payload_kind": F.when(F.col("unknown_rate") > 0.3, "png").otherwise("pdf"),
            "json_articles": F.col("n_articles"),
            "stored_articles": F.col("sequence_issues"),
        }
    )
    return audit.issue_rows(audit.detect(docs, audit.extra_issues())).select("document_id", "issue_type", "severity")

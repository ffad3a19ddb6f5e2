"""Queries over the registry, the probe log and the read API."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lexmill.catalog import query
from lexmill.catalog.views import (
    ARTICLES, BASE_URL, INVENTORY, LEGAL_TEXT, PRESENCE, PROBES, RECORDED, REGISTRY, Tables, ctes,
)
from lexmill.catalog.text_queries import _DATE_ISO, _re2
from lexmill.functions import ids, scoring, text
from lexmill.operators import enumerate as cursors_
from lexmill.operators import ranges, registry as read, reports, select, throttle
from lexmill.session import materialize


@query(
    "ids_urls_paths",
    ctes(REGISTRY)
    + """SELECT document_id, url, url || '/download' AS download_url, '/data/pdfs/' || type || '/' || document_id || '.pdf' AS pdf_path,
  '/data/ocr/' || type || '/' || document_id || '.txt' AS ocr_path, '/data/articles/' || type || '/' || document_id || '.json' AS json_path FROM registry""",
)
def ids_urls_paths(spark, path):
    paths = [
        ids.artifact_path("/data", k, F.col("type"), F.col("document_id")).alias(f"{k}_path") for k in ids.ARTIFACTS
    ]
    return Tables(spark, path).registry.select(
        "document_id", "url", ids.download_url(F.col("url")).alias("download_url"), *paths
    )


_RAW_ID = """CASE o_orderkey % 5 WHEN 0 THEN document_id WHEN 1 THEN replace(document_id, '-', '_') WHEN 2 THEN document_id || '-2'
  WHEN 3 THEN type || '-x-' || number ELSE ' ' || document_id END"""


@query(
    "parse_ids",
    ctes(REGISTRY)
    + f""", p AS (SELECT o_orderkey, string_split(trim({_RAW_ID}), '-') AS x FROM registry)
SELECT o_orderkey, CASE WHEN len(x) = 3 THEN x[1] END AS type, CASE WHEN len(x) = 3 THEN try_cast(x[2] AS INTEGER) END AS year,
  CASE WHEN len(x) = 3 THEN try_cast(x[3] AS INTEGER) END AS number FROM p""",
)
def parse_ids(spark, path):
    parsed = ids.parse_document_id(F.expr(_RAW_ID))
    rows = Tables(spark, path).registry.select("o_orderkey", parsed.alias("p"))
    return rows.select("o_orderkey", "p.type", "p.year", "p.number")


_BAD = """CASE o_orderkey % 6 WHEN 0 THEN '../' || document_id WHEN 1 THEN '' WHEN 2 THEN document_id || '/x' ELSE document_id END"""
_BAD_TYPE = "CASE WHEN o_orderkey % 7 = 0 THEN 'arrete' ELSE type END"


@query(
    "validate_ids",
    ctes(REGISTRY)
    + f"""SELECT o_orderkey, v_type IN ('loi', 'decret') AND length(trim(v)) > 0 AND NOT contains(v, '..') AND NOT contains(v, '/') AND NOT contains(v, chr(92)) AS valid
FROM (SELECT o_orderkey, {_BAD} AS v, {_BAD_TYPE} AS v_type FROM registry)""",
)
def validate_ids(spark, path):
    return Tables(spark, path).registry.select(
        "o_orderkey", ids.valid_document(F.expr(_BAD_TYPE), F.expr(_BAD)).alias("valid")
    )


@query(
    "padded_url",
    f"""SELECT l_orderkey, l_linenumber, count(*) AS n,
  CASE WHEN l_linenumber < 10 THEN '{BASE_URL}/loi-1995-' || lpad(CAST(l_linenumber AS VARCHAR), 2, '0') END AS padded_url
FROM lineitem GROUP BY 1, 2""",
)
def padded_url(spark, path):
    lines = Tables(spark, path).lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))
    return lines.withColumn(
        "padded_url", ids.padded_url(BASE_URL, F.lit("loi"), F.lit(1995), F.col("l_linenumber"))
    )


@query(
    "probe_status",
    ctes(PROBES)
    + """, f AS (SELECT *, code = 404 AND n_attempts < 10 AS use_padded FROM probes),
g AS (SELECT *, CASE WHEN use_padded THEN padded_code ELSE code END AS final FROM f)
SELECT l_orderkey AS o_orderkey, CASE final WHEN 200 THEN 'FETCHED' WHEN 429 THEN 'RATE_LIMITED' ELSE 'FAILED' END AS status,
  final = 200 AS exists, use_padded AND padded_code = 200 AS padded FROM g""",
)
def probe_status(spark, path):
    status = ids.probe_status(F.col("code"), F.col("n_attempts"), F.col("padded_code"))
    return Tables(spark, path).probes.select("o_orderkey", status.alias("s")).select("o_orderkey", "s.*")


@query(
    "single_fetch_status",
    ctes(PROBES)
    + """SELECT l_orderkey AS o_orderkey, CASE code WHEN 200 THEN 'DOWNLOADED' WHEN 404 THEN 'NOT_FOUND' ELSE 'FAILED' END AS status,
  CASE code WHEN 200 THEN NULL WHEN 404 THEN 'Document not found (404)' ELSE 'HTTP ' || code END AS error_message FROM probes""",
)
def single_fetch_status(spark, path):
    rows = Tables(spark, path).probes.select("o_orderkey", ids.single_fetch_status(F.col("code")).alias("s"))
    return rows.select("o_orderkey", "s.*")


@query(
    "status_domain",
    """SELECT event_id, CASE WHEN s IN ('PENDING', 'FETCHED', 'DOWNLOADED', 'EXTRACTED', 'CONSOLIDATED', 'FAILED', 'RATE_LIMITED') THEN s ELSE 'PENDING' END AS status,
  coalesce(s, 'UNKNOWN') AS result_status
FROM (SELECT event_id, CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'view' THEN 'FETCHED' WHEN 'click' THEN 'CORRUPTED' WHEN 'purchase' THEN 'EXTRACTED' END AS s FROM events)""",
)
def status_domain(spark, path):
    s = F.expr(
        "CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'view' THEN 'FETCHED' "
        "WHEN 'click' THEN 'CORRUPTED' WHEN 'purchase' THEN 'EXTRACTED' END"
    )
    return Tables(spark, path).events.select(
        "event_id", ids.status_or_pending(s).alias("status"), ids.result_status(s).alias("result_status")
    )


@query("type_filter", ctes(REGISTRY) + "SELECT document_id, status FROM registry WHERE type = 'loi'")
def type_filter(spark, path):
    return (
        Tables(spark, path).registry.where(ids.type_filter(F.col("type"), "  LOI ")).select("document_id", "status")
    )


@query(
    "target_documents",
    ctes(REGISTRY)
    + "SELECT document_id, status FROM registry WHERE status = 'DOWNLOADED' AND number IN (SELECT doc_id FROM labels)",
)
def target_documents(spark, path):
    t = Tables(spark, path)
    wanted = t.registry.join(t.labels, F.col("number") == F.col("doc_id"), "left_semi")
    return select.target_documents(t.registry, wanted, ["DOWNLOADED"]).select("document_id", "status")


@query(
    "retry_outcome",
    """SELECT user_id, CAST(coalesce(min_by(code, struct_pack(a := attempt, b := event_id)) FILTER (code <> 429 AND attempt <= 3), 429) AS INTEGER) AS code,
  CAST(least(count(*) FILTER (attempt <= 3), 3) AS BIGINT) AS n_considered
FROM (SELECT user_id, event_id, CAST(json_extract(props, '$.k') AS INTEGER) % 5 + 1 AS attempt,
        CASE event_type WHEN 'error' THEN 429 WHEN 'purchase' THEN 404 WHEN 'signup' THEN 500 ELSE 200 END AS code FROM events)
GROUP BY 1""",
)
def retry_outcome(spark, path):
    attempts = Tables(spark, path).events.select(
        "user_id",
        "event_id",
        (F.get_json_object("props", "$.k").cast("int") % 5 + 1).alias("attempt"),
        F.expr(
            "CASE event_type WHEN 'error' THEN 429 WHEN 'purchase' THEN 404 WHEN 'signup' THEN 500 ELSE 200 END"
        ).alias("code"),
    )
    return throttle.retry_outcome(attempts, "user_id", "attempt", "code", [F.col("event_id")])


@query(
    "backoff_delay",
    """SELECT event_id, CAST(least(2000 * pow(2, k % 6), 30000) AS INTEGER) AS delay_ms
FROM (SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)""",
)
def backoff_delay(spark, path):
    attempt = F.get_json_object("props", "$.k").cast("int") % 6 + 1
    return Tables(spark, path).events.select("event_id", scoring.backoff_delay(attempt).alias("delay_ms"))


_THROTTLE = """w AS (SELECT strftime(time_bucket(INTERVAL '{0}', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n_requests,
  count(*) FILTER (event_type = 'error') AS n_throttled FROM events GROUP BY 1)"""


def _text_window(df):
    return df.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@query(
    "throttle_by_5min",
    ctes(_THROTTLE.format("5 minutes"))
    + "SELECT window_start, n_requests, n_throttled, round(n_throttled / n_requests, 6) AS rate FROM w",
)
def throttle_by_5min(spark, path):
    windows = throttle.throttle_windows(Tables(spark, path).events, "ts", F.col("event_type") == "error")
    return _text_window(windows.withColumn("rate", F.round("rate", 6)))


@query(
    "delay_tier",
    ctes(_THROTTLE.format("1 hour"))
    + """SELECT window_start, CAST(CASE WHEN r >= 0.5 THEN 5000 WHEN r >= 0.3 THEN 2000 WHEN r > 0.1 THEN 1000 ELSE 0 END AS INTEGER) AS delay_ms
FROM (SELECT window_start, n_throttled / n_requests AS r FROM w)""",
)
def delay_tier(spark, path):
    windows = throttle.throttle_windows(Tables(spark, path).events, "ts", F.col("event_type") == "error", "1 hour")
    return _text_window(throttle.with_delay_tier(windows)).select("window_start", "delay_ms")


_ADAPTIVE = """e AS (SELECT user_id, event_id, ts, event_type = 'error' AND value > 20 AS hit FROM events),
c AS (SELECT *, count(*) OVER w AS n, count(*) FILTER (hit) OVER w AS h FROM e
  WINDOW w AS (PARTITION BY user_id, floor(epoch_us(ts) / 864000000000) ORDER BY ts, event_id)),
r AS (SELECT *, h / n AS rate, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM c WHERE hit),
walk AS (
  SELECT user_id, event_id, k, rate, CASE WHEN rate >= 0.5 THEN 5000 WHEN rate >= 0.3 THEN 2000 WHEN rate > 0.1 THEN 1000 ELSE 0 END AS delay_ms
  FROM r WHERE k = 1
  UNION ALL
  SELECT r.user_id, r.event_id, r.k, r.rate, CASE WHEN r.rate >= 0.5 THEN 5000 WHEN r.rate >= 0.3 THEN 2000 WHEN r.rate > 0.1 THEN 1000
    ELSE greatest(0, walk.delay_ms - 500) END
  FROM walk JOIN r ON r.user_id = walk.user_id AND r.k = walk.k + 1)"""


@query(
    "adaptive_delay",
    ctes(_ADAPTIVE, recursive=True)
    + "SELECT user_id, event_id, round(rate, 6) AS rate, CAST(delay_ms AS INTEGER) AS delay_ms FROM walk",
)
def adaptive_delay(spark, path):
    paced = throttle.adaptive_delay(
        Tables(spark, path).events.select("user_id", "event_id", "ts", "event_type", "value"),
        ["user_id"],
        "ts",
        [F.col("event_id")],
        (F.col("event_type") == "error") & (F.col("value") > 20),
        interval_seconds=864_000,
    )
    return paced.select("user_id", "event_id", F.round("rate", 6).alias("rate"), "delay_ms")


# Cursors of the latest year, starting at the highest number of each type; documents that failed
# their probe are known to be missing.
_CURSORS = """top AS (SELECT max(year) AS year FROM registry),
cursors AS (SELECT CASE type WHEN 'loi' THEN 0 ELSE 1 END AS cursor_pos, type, (SELECT year FROM top) AS year, max(number) AS number FROM registry GROUP BY type),
missing AS (SELECT r.type, r.year, r.number FROM registry r JOIN probes p ON p.l_orderkey = r.o_orderkey WHERE p.code = 404),
cand AS (SELECT c.cursor_pos, c.type, c.year, n.number FROM cursors c, LATERAL (SELECT unnest(generate_series(1, c.number)) AS number) n
  WHERE NOT EXISTS (SELECT 1 FROM missing m WHERE m.type = c.type AND m.year = c.year AND m.number = n.number))"""


def _cursors(t: Tables):
    tops = t.registry.groupBy(F.col("type").alias("document_type")).agg(
        F.max("number").alias("number"), F.max("year").alias("own_year")
    )
    year = F.max("own_year").over(Window.partitionBy(F.lit(0)))  # two rows
    pos = F.when(F.col("document_type") == "loi", 0).otherwise(1)
    return tops.select(pos.alias("cursor_pos"), "document_type", year.alias("year"), "number")


def _missing(t: Tables):
    gone = t.probes.where("code = 404").select("o_orderkey")
    return t.registry.join(gone, "o_orderkey", "left_semi").select(
        F.col("type").alias("document_type"), "year", "number"
    )


@query(
    "candidates",
    ctes(REGISTRY, PROBES, _CURSORS) + "SELECT type AS document_type, year, CAST(number AS INTEGER) AS number FROM cand",
)
def candidates(spark, path):
    t = Tables(spark, path)
    return cursors_.candidates(_cursors(t), _missing(t)).select("document_type", "year", "number")


_QUOTA = """, ranked AS (SELECT *, row_number() OVER (PARTITION BY cursor_pos ORDER BY number DESC) AS rn FROM cand),
own AS (SELECT * FROM ranked WHERE rn <= 5000),
taken AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY cursor_pos, rn) AS total FROM own) WHERE total <= 8000)
"""


@query(
    "candidates_quota",
    ctes(REGISTRY, PROBES, _CURSORS) + _QUOTA + "SELECT type AS document_type, year, CAST(number AS INTEGER) AS number FROM taken",
)
def candidates_quota(spark, path):
    t = Tables(spark, path)
    return cursors_.candidates(_cursors(t), _missing(t), 5000, 8000).select("document_type", "year", "number")


@query(
    "cursor_advance",
    ctes(REGISTRY, PROBES, _CURSORS)
    + _QUOTA
    + """, used AS (SELECT cursor_pos, min(number) AS last, count(*) AS n FROM taken GROUP BY 1),
s AS (SELECT c.*, u.last, coalesce(u.n, 0) AS n, least(5000, 8000 - coalesce(sum(coalesce(u.n, 0)) OVER (ORDER BY c.cursor_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS quota
  FROM cursors c LEFT JOIN used u USING (cursor_pos)),
x AS (SELECT *, CASE WHEN n >= quota THEN last - 1 ELSE 0 END AS nxt FROM s)
SELECT type AS document_type, CAST(CASE WHEN quota <= 0 THEN year WHEN nxt <= 0 THEN greatest(year - 1, 1960) ELSE year END AS INTEGER) AS current_year,
  CAST(CASE WHEN quota <= 0 THEN number WHEN nxt <= 0 AND year - 1 < 1960 THEN 0 WHEN nxt <= 0 THEN 2000 ELSE nxt END AS INTEGER) AS current_number FROM x""",
)
def cursor_advance(spark, path):
    t = Tables(spark, path)
    cur = _cursors(t)
    taken = cursors_.candidates(cur, _missing(t), 5000, 8000)
    moved = cursors_.advance_cursors(cur, taken, 2000, 1960, 5000, 8000)
    return moved.select("document_type", "current_year", "current_number")


@query(
    "not_seen_before",
    ctes(REGISTRY, PROBES)
    + "SELECT document_id FROM registry r WHERE NOT EXISTS (SELECT 1 FROM probes p WHERE p.l_orderkey = r.o_orderkey AND p.code <> 429)",
)
def not_seen_before(spark, path):
    t = Tables(spark, path)
    status = ids.probe_status(F.col("code"), F.col("n_attempts"), F.lit(None).cast("int"))["status"]
    results = t.probes.select("o_orderkey", status.alias("status"))
    return cursors_.not_yet_seen(t.registry, results, ["o_orderkey"]).select("document_id")


# Number ranges: the extracted documents of each type and year are the missing numbers.
_RANGES = """pts AS (SELECT type AS document_type, year, number FROM registry WHERE status = 'EXTRACTED'),
isl AS (SELECT document_type, year, number, number - row_number() OVER (PARTITION BY document_type, year ORDER BY number) AS g FROM (SELECT DISTINCT * FROM pts)),
merged AS (SELECT document_type, year, min(number) AS number_min, max(number) AS number_max, count(*) AS document_count FROM isl GROUP BY document_type, year, g)"""


def _points(t: Tables, status: str):
    return t.registry.where(F.col("status") == status).select(F.col("type").alias("document_type"), "year", "number")


@query("range_merge", ctes(REGISTRY, _RANGES) + "SELECT * FROM merged")
def range_merge(spark, path):
    return ranges.numbers_to_ranges(_points(Tables(spark, path), "EXTRACTED"))


_SPANS = """spans AS (SELECT r.type AS document_type, r.year, r.number + l.l_linenumber AS number_min, r.number + l.l_linenumber * l.l_linenumber AS number_max
  FROM lineitem l JOIN registry r ON r.o_orderkey = l.l_orderkey)"""


def _spans(t: Tables):
    joined = t.lineitem.join(t.registry, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        F.col("type").alias("document_type"),
        "year",
        (F.col("number") + F.col("l_linenumber")).alias("number_min"),
        (F.col("number") + F.col("l_linenumber") * F.col("l_linenumber")).alias("number_max"),
        F.lit(1).cast("long").alias("document_count"),
    )


@query(
    "range_merge_overlapping",
    ctes(REGISTRY, _SPANS)
    + """, o AS (SELECT *, max(number_max) OVER (PARTITION BY document_type, year ORDER BY number_min, number_max ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM spans),
n AS (SELECT *, sum(CASE WHEN reach IS NULL OR number_min > reach + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY document_type, year ORDER BY number_min, number_max ROWS UNBOUNDED PRECEDING) AS island FROM o)
SELECT document_type, year, min(number_min) AS number_min, max(number_max) AS number_max, count(*) AS document_count FROM n GROUP BY document_type, year, island""",
)
def range_merge_overlapping(spark, path):
    return ranges.merge_ranges(_spans(Tables(spark, path)))


@query(
    "range_contains",
    ctes(REGISTRY, _RANGES)
    + """SELECT r.type AS document_type, r.year, r.number, EXISTS (SELECT 1 FROM merged m WHERE m.document_type = r.type AND m.year = r.year
  AND m.number_min <= r.number AND m.number_max >= r.number) AS contained FROM registry r""",
)
def range_contains(spark, path):
    t = Tables(spark, path)
    merged = materialize(ranges.numbers_to_ranges(_points(t, "EXTRACTED")), "not-found-ranges")
    points = t.registry.select(F.col("type").alias("document_type"), "year", "number")
    return ranges.contained(points, merged)


@query(
    "range_overlap",
    ctes(REGISTRY, _RANGES)
    + """SELECT r.type AS document_type, r.year, r.number, count(m.number_min) AS n_ranges FROM registry r LEFT JOIN merged m
  ON m.document_type = r.type AND m.year = r.year AND m.number_min <= r.number + 1 AND m.number_max >= r.number - 1 GROUP BY ALL""",
)
def range_overlap(spark, path):
    t = Tables(spark, path)
    merged = materialize(ranges.numbers_to_ranges(_points(t, "EXTRACTED")), "not-found-ranges")
    points = t.registry.select(F.col("type").alias("document_type"), "year", "number")
    return ranges.touching_counts(points, merged)


@query(
    "range_label",
    ctes(REGISTRY, _RANGES)
    + """SELECT document_type || ';' || year || ';' || number_min || CASE WHEN number_min = number_max THEN '' ELSE '-' || number_max END AS label,
  document_count FROM merged""",
)
def range_label(spark, path):
    merged = ranges.numbers_to_ranges(_points(Tables(spark, path), "EXTRACTED"))
    label = text.range_label(F.col("document_type"), F.col("year"), F.col("number_min"), F.col("number_max"))
    return ranges.listing(merged).select(label.alias("label"), "document_count")


# Download selection.


@query(
    "download_selection",
    ctes(REGISTRY, INVENTORY, RECORDED, PRESENCE)
    + """SELECT document_id, year, number, status FROM presence
WHERE (status = 'FETCHED' OR (status = 'DOWNLOADED' AND NOT has_pdf)) AND NOT (is_recorded AND has_pdf)""",
)
def download_selection(spark, path):
    flagged = Tables(spark, path).presence.where(F.col("status").isin("FETCHED", "DOWNLOADED"))
    wanted = (F.col("status") == "FETCHED") | ~F.col("has_pdf")
    chosen = flagged.where(wanted & select.should_download())
    return select.newest_first(chosen).select("document_id", "year", "number", "status")


@query(
    "vanished_files",
    ctes(REGISTRY, INVENTORY)
    + "SELECT document_id FROM registry WHERE status = 'DOWNLOADED' AND o_orderkey NOT IN (SELECT l_orderkey FROM inventory WHERE kind = 'pdf')",
)
def vanished_files(spark, path):
    t = Tables(spark, path)
    return select.vanished(t.registry, t.registry_inventory).select("document_id")


@query(
    "extracted_with_json",
    ctes(REGISTRY, INVENTORY)
    + "SELECT document_id FROM registry WHERE status = 'EXTRACTED' AND o_orderkey IN (SELECT l_orderkey FROM inventory WHERE kind = 'json')",
)
def extracted_with_json(spark, path):
    t = Tables(spark, path)
    return select.with_json(t.registry, t.registry_inventory).select("document_id")


@query(
    "extracted_without_json",
    ctes(REGISTRY, INVENTORY)
    + "SELECT count(*) AS n_missing FROM registry WHERE status = 'EXTRACTED' AND o_orderkey NOT IN (SELECT l_orderkey FROM inventory WHERE kind = 'json')",
)
def extracted_without_json(spark, path):
    t = Tables(spark, path)
    return select.without_json_count(t.registry, t.registry_inventory)


@query("payload_hash", "SELECT page_id, sha256(html) AS sha256, CAST(octet_length(encode(html)) AS BIGINT) AS file_size FROM pages")
def payload_hash(spark, path):
    body = F.encode("html", "UTF-8")
    return Tables(spark, path).pages.select(
        "page_id", text.payload_hash(body).alias("sha256"), F.length(body).cast("long").alias("file_size")
    )


_PAYLOADS = "payloads AS (SELECT doc_id, regexp_replace(lower(text), '[^a-z]', '', 'g') AS body FROM documents)"


@query(
    "duplicate_payloads",
    ctes(_PAYLOADS)
    + "SELECT sha256(body) AS sha256, count(*) AS n_copies, min(doc_id) AS first_id FROM payloads GROUP BY 1 HAVING count(*) > 1",
)
def duplicate_payloads(spark, path):
    payloads = Tables(spark, path).documents.select(
        "doc_id", F.regexp_replace(F.lower("text"), "[^a-z]", "").cast("binary").alias("content")
    )
    return select.duplicate_payloads(payloads, "doc_id")


@query(
    "payload_filter",
    "SELECT page_id, length(t) AS n_chars FROM (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS t FROM pages) WHERE length(t) > 0",
)
def payload_filter(spark, path):
    titles = Tables(spark, path).pages.select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("content"))
    return select.usable_payloads(titles).select("page_id", F.length("content").cast("long").alias("n_chars"))


@query(
    "payload_kind",
    """SELECT page_id, CASE WHEN h = '25504446' THEN 'pdf' WHEN h = '89504E47' THEN 'png' WHEN h[1:6] = 'FFD8FF' THEN 'jpg' ELSE 'unknown' END AS kind
FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN '25504446' WHEN 1 THEN '89504E47' WHEN 2 THEN 'FFD8FFE0' ELSE upper(hex(encode(html[1:4]))) END AS h FROM pages)""",
)
def payload_kind(spark, path):
    head = F.expr("CASE page_id % 4 WHEN 0 THEN unhex('25504446') WHEN 1 THEN unhex('89504E47') WHEN 2 THEN unhex('FFD8FFE0') ELSE unhex('') END")
    content = F.concat(head, F.encode("html", "UTF-8"))
    return Tables(spark, path).pages.select("page_id", text.looks_like(content).alias("kind"))


# Counts, listings and the read API.


@query("status_counts", ctes(REGISTRY) + "SELECT status, count(*) AS n FROM registry GROUP BY 1")
def status_counts(spark, path):
    return reports.counts_by(Tables(spark, path).registry, "status")


@query("type_year_counts", ctes(REGISTRY) + "SELECT type, year, count(*) AS n FROM registry GROUP BY 1, 2")
def type_year_counts(spark, path):
    return reports.counts_by(Tables(spark, path).registry, "type", "year")


_WITH_FAILED = """, marked AS (SELECT CASE WHEN code = 404 THEN 'FAILED' ELSE status END AS status FROM registry LEFT JOIN probes ON l_orderkey = o_orderkey)
"""


@query(
    "status_distribution",
    ctes(REGISTRY, PROBES) + _WITH_FAILED
    + "SELECT status, count(*) AS n, (SELECT count(*) FROM marked WHERE status = 'FAILED') AS n_excluded FROM marked WHERE status <> 'FAILED' GROUP BY 1",
)
def status_distribution(spark, path):
    t = Tables(spark, path)
    marked = t.registry.join(t.probes, "o_orderkey", "left").withColumn(
        "status", F.when(F.col("code") == 404, "FAILED").otherwise(F.col("status"))
    )
    return reports.status_distribution(marked)


@query(
    "newest_first",
    ctes(REGISTRY) + "SELECT document_id, year, number FROM registry WHERE status = 'DOWNLOADED' ORDER BY year DESC, number DESC LIMIT 10",
)
def newest_first(spark, path):
    waiting = Tables(spark, path).registry.where("status = 'DOWNLOADED'")
    return select.newest_first(waiting, 10).select("document_id", "year", "number")


@query(
    "registry_queries",
    ctes(REGISTRY) + "SELECT document_id, year, number, status FROM registry WHERE type = 'loi' AND year = 1997 AND status = 'EXTRACTED'",
)
def registry_queries(spark, path):
    rows = read.where_equal(Tables(spark, path).registry, type="loi", year=1997, status="EXTRACTED")
    return read.listing(rows).select("document_id", "year", "number", "status")


@query(
    "registry_by_id",
    ctes(REGISTRY) + "SELECT document_id, status FROM registry WHERE document_id = (SELECT min(document_id) FROM registry)",
)
def registry_by_id(spark, path):
    registry = Tables(spark, path).registry
    first = registry.agg(F.min("document_id")).first()[0]
    return read.registry_by_id(registry, first).select("document_id", "status")


@query(
    "found_results",
    ctes(REGISTRY, PROBES) + "SELECT document_id, url FROM registry JOIN probes ON l_orderkey = o_orderkey WHERE code = 200",
)
def found_results(spark, path):
    t = Tables(spark, path)
    results = t.registry.join(t.probes, "o_orderkey").withColumn("exists", F.col("code") == 200)
    return read.found(results).select("document_id", "url")


_ARTICLE_TABLE = """arts AS (SELECT r.document_id, r.type AS document_type, r.year AS document_year, r.number AS document_number, l.l_linenumber AS article_index,
  round(1.0 - l.l_discount * 4 - l.l_tax, 6) AS extraction_confidence, l.l_partkey FROM lineitem l JOIN registry r ON r.o_orderkey = l.l_orderkey)"""


def _articles(t: Tables):
    confidence = F.round(F.lit(1.0) - F.col("l_discount") * 4 - F.col("l_tax"), 6)
    return t.lineitem.join(t.registry, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "document_id", F.col("type").alias("document_type"), F.col("year").alias("document_year"),
        F.col("number").alias("document_number"), F.col("l_linenumber").alias("article_index"),
        confidence.alias("extraction_confidence"), "l_partkey",
    )


@query(
    "high_confidence_articles",
    ctes(REGISTRY, _ARTICLE_TABLE)
    + "SELECT document_id, article_index, l_partkey, extraction_confidence FROM arts WHERE extraction_confidence >= 0.9",
)
def high_confidence_articles(spark, path):
    return read.confident_articles(_articles(Tables(spark, path)), 0.9).select(
        "document_id", "article_index", "l_partkey", "extraction_confidence"
    )


@query(
    "text_search",
    "SELECT doc_id, CAST((length(lower(text)) - length(replace(lower(text), 'heon', ''))) // 4 AS BIGINT) AS n_hits FROM documents WHERE contains(lower(text), 'heon')",
)
def text_search(spark, path):
    return read.search(Tables(spark, path).documents, "HeOn", F.col("text")).select("doc_id", "n_hits")


@query(
    "distinct_signatories",
    "SELECT DISTINCT s_name AS name, n_name AS role FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN lineitem ON l_suppkey = s_suppkey",
)
def distinct_signatories(spark, path):
    t = Tables(spark, path)
    used = t.lineitem.select(F.col("l_suppkey").alias("s_suppkey")).distinct()
    signed = t.supplier.join(used, "s_suppkey", "left_semi").join(t.nation, F.col("n_nationkey") == F.col("s_nationkey"))
    return reports.distinct_signatories(signed.select(F.col("s_name").alias("name"), F.col("n_name").alias("role")))


# Reports over the extracted texts; the confidence of a text is its share of numbered lines.
_COUNTED = """counted AS (SELECT t.document_id, t.year, t.text, coalesce(a.n, 0) AS n_articles,
  round(coalesce(a.n, 0) / len(string_split(rtrim(t.text, chr(10)), chr(10))), 6) AS confidence
  FROM legal_text t LEFT JOIN (SELECT document_id, count(*) AS n FROM article_rows GROUP BY 1) a USING (document_id))"""


def _counted(t: Tables):
    docs = text.with_articles(t.legal_text)
    n = F.size("articles")
    return docs.select(
        "document_id", "year", "text", "articles", n.alias("n_articles"),
        F.round(n / F.size(text.lines(F.col("text"))), 6).alias("confidence"),
    )


@query(
    "period_stats",
    ctes(LEGAL_TEXT, ARTICLES, _COUNTED, recursive=True)
    + """SELECT (year // 10 * 10) || '-' || (year // 10 * 10 + 9) AS period, count(*) AS n_documents,
  round(avg(CASE WHEN n_articles > 0 THEN 1 ELSE 0 END), 6) AS success_rate, round(avg(confidence) FILTER (n_articles > 0), 6) AS mean_confidence,
  CAST(min(n_articles) FILTER (n_articles > 0) AS INTEGER) AS min_articles, CAST(max(n_articles) AS INTEGER) AS max_articles, CAST(sum(n_articles) AS BIGINT) AS total_articles,
  round(avg(CASE WHEN confidence >= 0.3 THEN 1 ELSE 0 END), 6) AS share_above_bar
FROM counted GROUP BY ROLLUP ((year // 10 * 10) || '-' || (year // 10 * 10 + 9))""",
)
def period_stats(spark, path):
    stats = reports.period_statistics(_counted(Tables(spark, path)).drop("text", "articles"), bar=0.3)
    rounded = {c: F.round(c, 6) for c in ("success_rate", "mean_confidence", "share_above_bar")}
    return stats.withColumns(rounded)


def _report(t: Tables):
    found = _counted(t).select(
        "document_id", "confidence", "n_articles",
        text.law_title(F.col("text")).alias("title"),
        text.french_date(F.col("text")).alias("date"),
        text.promulgation_city(F.col("text")).alias("city"),
        F.size(text.signatories(F.col("text"), _patterns())).alias("n_signatories"),
    )
    return reports.extraction_report(t.legal_text, found)


def _patterns():
    from lexmill.catalog.views import SIGNATORIES

    return SIGNATORIES


def _report_sql() -> str:
    signed = " OR ".join(f"regexp_matches(text, '{s['pattern']}')" for s in _patterns())
    flags = ", ".join(f"CASE WHEN contains(text, '{p}') THEN '{n}' END" for n, p in text.DEFECTS.items())
    return ctes(LEGAL_TEXT, ARTICLES, _COUNTED, recursive=True) + f""", report AS (
  SELECT document_id, confidence, CAST(n_articles AS INTEGER) AS n_articles, nullif(trim(regexp_extract(text, '{_re2(text.TITLE)}', 1)), '') IS NOT NULL AS has_title,
    ({_DATE_ISO}) IS NOT NULL AS has_date, regexp_extract(text, '{text.CITY}', 1) <> '' AS has_city, {signed} AS has_signatories,
    CAST(len(string_split(rtrim(text, chr(10)), chr(10))) AS INTEGER) AS n_lines,
    list_filter([{flags}, CASE WHEN regexp_matches(text, '{text.DATE}') AND ({_DATE_ISO}) IS NULL THEN 'date_not_extracted' END,
      CASE WHEN regexp_matches(text, '{text.PIPE_IN_WORD}') THEN 'pipe_in_word' END, CASE WHEN regexp_matches(text, '{text.SUSPECT_WORD}') THEN 'suspect_word' END], lambda x: x IS NOT NULL) AS issues
  FROM counted)
"""


@query(
    "extraction_report",
    _report_sql()
    + "SELECT document_id, confidence, n_articles, has_title, has_date, has_city, has_signatories, n_lines, array_to_string(issues, ',') AS issues FROM report",
)
def extraction_report(spark, path):
    return (
        _report(Tables(spark, path)).drop("text_missing").withColumn("issues", F.array_join("issues", ","))
    )


@query(
    "report_totals",
    _report_sql()
    + "SELECT count(*) AS n_documents, CAST(sum(len(issues)) AS BIGINT) AS n_issues, CAST(sum(n_articles) AS BIGINT) AS n_articles FROM report",
)
def report_totals(spark, path):
    return reports.report_totals(_report(Tables(spark, path)))


# Single lookups of the read API; the wanted key is the smallest one, found in SQL as well.


@query(
    "document_exists",
    ctes(REGISTRY) + "SELECT count(*) > 0 AS exists FROM registry WHERE type = 'decret' AND year = 1998 AND status = 'DOWNLOADED'",
)
def document_exists(spark, path):
    return read.exists(Tables(spark, path).registry, type="decret", year=1998, status="DOWNLOADED")


@query(
    "articles_by_document",
    ctes(REGISTRY, _ARTICLE_TABLE)
    + "SELECT document_id, article_index, l_partkey FROM arts WHERE document_id = (SELECT min(document_id) FROM arts)",
)
def articles_by_document(spark, path):
    articles = _articles(Tables(spark, path))
    first = articles.agg(F.min("document_id")).first()[0]
    return read.by_id(articles, first).orderBy("article_index").select("document_id", "article_index", "l_partkey")


@query(
    "metadata_by_type_year",
    ctes(REGISTRY, _ARTICLE_TABLE)
    + """SELECT document_id, document_number, count(*) AS total_articles, max(extraction_confidence) AS extraction_confidence FROM arts
WHERE document_type = 'decret' AND document_year = 1999 GROUP BY 1, 2 HAVING max(extraction_confidence) >= 0.8""",
)
def metadata_by_type_year(spark, path):
    metadata = (
        read.where_equal(_articles(Tables(spark, path)), document_type="decret", document_year=1999)
        .groupBy("document_id", "document_year", "document_number")
        .agg(F.count(F.lit(1)).alias("total_articles"), F.max("extraction_confidence").alias("extraction_confidence"))
    )
    confident = read.min_confidence(metadata, 0.8)
    return read.listing(confident, "document_year", "document_number").drop("document_year")


@query(
    "signatories_by_role",
    "SELECT s_name AS name, s_suppkey FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE n_name = 'NATION_7'",
)
def signatories_by_role(spark, path):
    t = Tables(spark, path)
    signed = t.supplier.join(t.nation, F.col("n_nationkey") == F.col("s_nationkey"))
    return read.where_equal(signed, n_name="NATION_7").select(F.col("s_name").alias("name"), "s_suppkey")


@query(
    "download_by_hash",
    "SELECT page_id, sha256(html) AS sha256 FROM pages WHERE sha256(html) = (SELECT min(sha256(html)) FROM pages)",
)
def download_by_hash(spark, path):
    hashed = Tables(spark, path).pages.select("page_id", text.payload_hash(F.encode("html", "UTF-8")).alias("sha256"))
    return read.where_equal(hashed, sha256=hashed.agg(F.min("sha256")).first()[0])


@query(
    "ranges_containing_number",
    ctes(REGISTRY, _RANGES)
    + "SELECT * FROM merged WHERE document_type = 'loi' AND year = 1996 AND number_min <= (SELECT max(number) FROM pts WHERE document_type = 'loi' AND year = 1996) AND number_max >= (SELECT max(number) FROM pts WHERE document_type = 'loi' AND year = 1996)",
)
def ranges_containing_number(spark, path):
    points = _points(Tables(spark, path), "EXTRACTED")
    last = read.where_equal(points, document_type="loi", year=1996).agg(F.max("number")).first()[0]
    return read.ranges_containing(ranges.numbers_to_ranges(points), "loi", 1996, last)


@query(
    "ranges_touching_number",
    ctes(REGISTRY, _RANGES)
    + "SELECT m.* FROM merged m, (SELECT max(number) + 1 AS n FROM pts WHERE document_type = 'loi' AND year = 1996) x WHERE document_type = 'loi' AND year = 1996 AND number_min <= n + 1 AND number_max >= n - 1",
)
def ranges_touching_number(spark, path):
    points = _points(Tables(spark, path), "EXTRACTED")
    last = read.where_equal(points, document_type="loi", year=1996).agg(F.max("number")).first()[0]
    return read.ranges_touching(ranges.numbers_to_ranges(points), "loi", 1996, last + 1)

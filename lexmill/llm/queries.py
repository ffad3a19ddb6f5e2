"""One query for each operator of this package, with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import chat, content_sort, credentials, divergence, knn, langid, lexical, licenses, lm, mixing, packing, simhash, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn

    return add


def _table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}.parquet")


@query("op1_lattice_scores")
def lattice_scores(spark, path):
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2
    return lm.lattice_scores(_table(spark, path, "documents"), held, class_col="lang")


@query(
    "op2_exact_dedup",
    r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents),
r AS (
  SELECT doc_id, norm, row_number() OVER w AS pos, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size
  FROM n WINDOW w AS (PARTITION BY norm ORDER BY chars DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, pos = 1 AS kept, sha256(norm) AS text_sha256 FROM r""",
)
def exact_dedup(spark, path):
    return content_sort.exact_groups(_table(spark, path, "documents"))


@query("op3_language_id")
def language_id(spark, path):
    docs = _table(spark, path, "documents")
    held = langid.held_out(F.col("doc_id"))
    model = langid.fit(docs, learn=~held)
    found = model.predict(docs.select("doc_id", "text"))
    # The text has served its purpose; id and predictions are all that is left of a row.
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query(
    "op4_chat_snapshots",
    """
WITH t AS (
  SELECT conv_id, role, text, row_number() OVER w AS n, count(*) OVER (PARTITION BY conv_id) AS total FROM conversations
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS LAST, text NULLS LAST)),
p AS (
  SELECT *, string_agg(coalesce('r' || role, 'n') || chr(1) || coalesce('t' || text, 'n'), chr(2)) OVER (PARTITION BY conv_id ORDER BY n) AS prefix FROM t),
e AS (SELECT prefix, min(conv_id) AS conv_id FROM p WHERE n = total GROUP BY prefix),
k AS (SELECT conv_id FROM e WHERE prefix NOT IN (SELECT prefix FROM p WHERE n < total))
SELECT conv_id, CAST((n - 1) // 256 AS INTEGER) AS part, count(*) AS n_turns,
  string_agg('<|im_start|>' || coalesce(role, 'user') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' ORDER BY n) AS text
FROM t JOIN k USING (conv_id) GROUP BY 1, 2""",
)
def chat_snapshots(spark, path):
    return chat.format_chats(_table(spark, path, "conversations"))


@query("op5_pack_best_fit")
def pack_best_fit(spark, path):
    return packing.pack(_table(spark, path, "documents"))


@query("op6_license_scan")
def license_scan(spark, path):
    return licenses.scan(_table(spark, path, "documents"))


@query("op7_simhash_groups")
def simhash_groups(spark, path):
    return simhash.near_duplicates(_table(spark, path, "documents"))


@query(
    "op8_warc_round_trip",
    """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
h AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS head FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < head THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < head THEN head END AS refers_to FROM h""",
)
def warc_round_trip(spark, path):
    records = warc.round_trip(spark, _table(spark, path, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query(
    "op9_knn_inner_product",
    """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id != c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5""",
)
def knn_inner_product(spark, path):
    return knn.top_k(_table(spark, path, "embeddings"), F.col("vec_id") % 50 == 0)


@query(
    "op10_mix_sources",
    r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, CAST([5, 2, 1][1 + CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER)] AS BIGINT) AS w,
    3 * source_size AS cap FROM s),
l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS t FROM w
  WINDOW b AS (ORDER BY cap / w, source NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), w * (SELECT max(t) FROM l WHERE t <= cap / w)) AS target FROM l),
q AS (
  SELECT *, CAST(CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS BIGINT) AS whole FROM g),
f AS (SELECT *, target - whole * source_size AS rest FROM q),
u AS (
  SELECT doc_id, d.source, size, source_size, target, whole, rest,
    CASE WHEN source_size > 0 THEN rest / source_size ELSE 0.0 END AS fraction,
    (CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR) || ':17'), 1, 13)) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source),
k AS (
  SELECT *, CASE WHEN fraction <= 0 THEN CAST('inf' AS DOUBLE) ELSE (u / (1.0::DOUBLE - u)) / (fraction / (1.0::DOUBLE - fraction)) END AS rnk FROM u),
c AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rnk, CAST(doc_id AS VARCHAR)) AS upto FROM k),
m AS (SELECT *, rest - coalesce(max(upto) FILTER (upto <= rest) OVER (PARTITION BY source), 0) AS gap FROM c),
x AS (
  SELECT source, arg_min(doc_id, {'a': abs(gap - size), 'b': rnk, 'c': CAST(doc_id AS VARCHAR)}) AS filler FROM m
  WHERE upto > rest AND abs(gap - size) < gap AND fraction > 0 GROUP BY source)
SELECT doc_id, m.source, size, source_size, target,
  whole + CASE WHEN fraction > 0 AND (upto <= rest OR coalesce(doc_id = filler, false)) THEN 1 ELSE 0 END AS copies,
  size * (whole + CASE WHEN fraction > 0 AND (upto <= rest OR coalesce(doc_id = filler, false)) THEN 1 ELSE 0 END) AS taken
FROM m LEFT JOIN x ON m.source IS NOT DISTINCT FROM x.source""",
)
def mix_sources(spark, path):
    planned = mixing.plan(_table(spark, path, "documents"))
    rows = planned.copies(planned.sizes, "id")
    return rows.select(
        F.col("id").alias("doc_id"), "source", "size", "source_size", "target", F.col("__copies").alias("copies"),
        (F.col("size") * F.col("__copies")).alias("taken"),
    )


@query("op11_secret_scan")
def secret_scan(spark, path):
    return credentials.digest(credentials.scan(_table(spark, path, "documents")))


@query(
    "op12_lexical_search",
    r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents WHERE text IS NOT NULL),
e AS (SELECT r, doc_id, ts, CAST(len(ts) AS BIGINT) AS n FROM d WHERE len(ts) > 0),
s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM e),
m AS (SELECT r, 100 - 90 + ((90 * n * docs) // total) AS m FROM e, s),
c AS (SELECT r, doc_id, t, count(*) AS tf FROM (SELECT r, doc_id, unnest(ts) AS t FROM e) GROUP BY ALL),
w AS (
  SELECT t, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
  FROM (SELECT t, count(*) AS df FROM c GROUP BY t), s),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
  FROM benchmark),
x AS (
  SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM q JOIN c USING (t) JOIN w USING (t) JOIN m USING (r) GROUP BY 1, 2, 3)
SELECT item_id, CAST(row_number() OVER p AS INTEGER) AS rank, doc_id, score FROM x WHERE score > 0
WINDOW p AS (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) QUALIFY row_number() OVER p <= 10""",
)
def lexical_search(spark, path):
    return lexical.search(_table(spark, path, "documents"), _table(spark, path, "benchmark"))


@query(
    "op13_source_divergence",
    r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents),
w AS (SELECT r, lang, source, unnest(ts) AS t FROM d),
k AS (SELECT lang, t FROM w GROUP BY 1, 2 HAVING count(DISTINCT r) >= 10),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY 1),
c AS (SELECT lang, source, t, count(*) AS n FROM w JOIN k USING (lang, t) GROUP BY 1, 2, 3),
g AS (
  SELECT lang, source, coalesce(v, 0) AS v, coalesce(n, 0) + 2 * coalesce(v, 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN v USING (lang)
  LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY 1, 2) USING (lang, source)),
f AS (
  SELECT lang, source, t, coalesce(n, 0) AS n, CAST(1 + (1000000000::HUGEINT * (coalesce(n, 0) + 2)) // total AS HUGEINT) AS p
  FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, t)),
l AS (
  SELECT lang, t, CAST(1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * v) AS HUGEINT) AS q
  FROM (SELECT lang, t, CAST(sum(n) AS HUGEINT) AS n FROM c GROUP BY 1, 2) JOIN v USING (lang)),
b AS (
  SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value
  FROM f x JOIN f y ON x.lang = y.lang AND x.t = y.t AND x.source <> y.source GROUP BY 1, 2, 3),
a AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN b ON b.lang = x.lang AND b.source = x.source AND b.item = y.source
  UNION ALL
  SELECT lang, source, 'term', t, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) FROM f JOIN l USING (lang, t) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(row_number() OVER o AS INTEGER) AS rank FROM a
WINDOW o AS (PARTITION BY lang, source, part ORDER BY value DESC, item)
QUALIFY part = 'pair' OR row_number() OVER o <= 10""",
)
def source_divergence(spark, path):
    return divergence.audit(_table(spark, path, "documents"))

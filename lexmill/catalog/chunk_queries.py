"""Queries that split texts and documents and join results again."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill.catalog import query
from lexmill.catalog.views import ARTICLES, LEGAL_TEXT, Tables, ctes
from lexmill.functions import jsondoc, text
from lexmill.operators import chunkers, chunking, transform

SIZE, OVERLAP = 1000, 100


def _pack_sql(pieces: str, sep: str, extra: int, large: str, n: int) -> str:
    """A fold over a list of texts: state and items are (chunks, current)."""
    a, x = f"a{n}", f"x{n}"
    closed = f"CASE WHEN {a}.current = '' THEN {a}.chunks ELSE list_append({a}.chunks, {a}.current) END"
    return f"""list_reduce(list_transform({pieces}, lambda p{n}: {{'chunks': CAST([] AS VARCHAR[]), 'current': p{n}}}),
  lambda {a}, {x}: CASE
    WHEN length({x}.current) > {SIZE} THEN {{'chunks': list_concat({closed}, {large.replace('PIECE', f'{x}.current')}), 'current': ''}}
    WHEN {a}.current <> '' AND length({a}.current) + length({x}.current) + {extra} > {SIZE} THEN {{'chunks': {closed},
      'current': CASE WHEN length({a}.current) > {OVERLAP} THEN right({a}.current, {OVERLAP}) || {sep} || {sep} ELSE '' END || {x}.current}}
    ELSE {{'chunks': {a}.chunks, 'current': CASE WHEN {a}.current = '' THEN {x}.current ELSE {a}.current || {sep} || {x}.current END}} END,
  {{'chunks': CAST([] AS VARCHAR[]), 'current': ''}})"""


_FIXED = f"list_transform(generate_series(0, length(PIECE) - 1, {SIZE - OVERLAP}), lambda i: substr(PIECE, CAST(i AS INTEGER) + 1, {SIZE}))"
_TEXT_PIECES = "list_slice(string_split({0}, {1}), 1, greatest(1, len(string_split(regexp_replace({0}, '({2})+$', ''), {1}))))"
_LINES = _TEXT_PIECES.format("PIECE", "chr(10)", "\\n")
_BY_LINES = f"""(CASE WHEN len({_LINES}) > 1 THEN list_transform([{_pack_sql(_LINES, 'chr(10)', 1, _FIXED, 2)}],
  lambda f: CASE WHEN f.current = '' THEN f.chunks ELSE list_append(f.chunks, f.current) END)[1] ELSE {_FIXED} END)"""


@query(
    "paragraph_chunks",
    f"""WITH p AS (SELECT doc_id, text, {_TEXT_PIECES.format("text", "chr(10) || chr(10)", "\\n\\n")} AS pieces FROM documents WHERE text IS NOT NULL),
f AS (SELECT doc_id, text, {_pack_sql("pieces", "chr(10) || chr(10)", 2, _BY_LINES, 1)} AS f FROM p),
c AS (SELECT doc_id, CASE WHEN length(text) <= {SIZE} THEN [text] WHEN f.current = '' THEN f.chunks ELSE list_append(f.chunks, f.current) END AS chunks FROM f)
SELECT doc_id, CAST(k - 1 AS INTEGER) AS chunk_index, CAST(len(chunks) AS INTEGER) AS total_chunks, chunks[k] AS chunk
FROM (SELECT doc_id, chunks, unnest(generate_series(1, len(chunks))) AS k FROM c)""",
)
def paragraph_chunks(spark, path):
    return chunking.paragraph_chunks(Tables(spark, path).documents, "doc_id", SIZE, OVERLAP)


@query(
    "window_chunks",
    f"""WITH d AS (SELECT doc_id, text, length(text) AS n, CAST(greatest(1, ceil((length(text) - {OVERLAP}) / {SIZE - OVERLAP}.0)) AS INTEGER) AS total_chunks FROM documents),
c AS (SELECT d.*, unnest(generate_series(1, total_chunks)) AS chunk_index FROM d)
SELECT doc_id, CAST(chunk_index AS INTEGER) AS chunk_index, total_chunks, CAST((chunk_index - 1) * {SIZE - OVERLAP} AS INTEGER) AS start,
  CAST(least((chunk_index - 1) * {SIZE - OVERLAP} + {SIZE}, n) AS INTEGER) AS "end", substr(text, (chunk_index - 1) * {SIZE - OVERLAP} + 1, {SIZE}) AS chunk FROM c""",
)
def window_chunks(spark, path):
    return chunking.window_chunks(Tables(spark, path).documents, "doc_id", SIZE, OVERLAP)


@query(
    "recombine",
    f"""WITH d AS (SELECT doc_id, text, CAST(greatest(1, ceil((length(text) - {OVERLAP}) / {SIZE - OVERLAP}.0)) AS INTEGER) AS total_chunks FROM documents),
c AS (SELECT d.*, unnest(generate_series(1, total_chunks)) AS k FROM d)
SELECT doc_id, CAST(k // 1024 AS INTEGER) AS row_no, string_agg(substr(text, (k - 1) * {SIZE - OVERLAP} + 1, {SIZE}), chr(10) || chr(10) ORDER BY k) AS text FROM c GROUP BY 1, 2""",
)
def recombine(spark, path):
    chunks = chunking.window_chunks(Tables(spark, path).documents, "doc_id", SIZE, OVERLAP)
    return chunking.join_parts(chunks, ["doc_id"], "chunk_index", "chunk")


@query("unsplit_texts", "SELECT doc_id, CAST(0 AS INTEGER) AS chunk_index, CAST(1 AS INTEGER) AS total_chunks, text AS chunk FROM documents")
def unsplit_texts(spark, path):
    return chunking.whole_text(Tables(spark, path).documents, "doc_id")


@query(
    "article_chunks",
    ctes(LEGAL_TEXT, ARTICLES, recursive=True)
    + """, s AS (SELECT document_id, article_index, 100 + length(content) AS size, row_number() OVER (PARTITION BY document_id ORDER BY article_index) AS k FROM article_rows),
tot AS (SELECT document_id, sum(size) AS total FROM s GROUP BY 1),
fold AS (
  SELECT s.document_id, s.article_index, s.k, CAST(0 AS BIGINT) AS chunk_index, CAST(s.size AS BIGINT) AS used FROM s WHERE k = 1
  UNION ALL
  SELECT s.document_id, s.article_index, s.k, f.chunk_index + CASE WHEN 50 + f.used + s.size > 2000 THEN 1 ELSE 0 END,
    CASE WHEN 50 + f.used + s.size > 2000 THEN s.size ELSE f.used + s.size END
  FROM fold f JOIN s ON s.document_id = f.document_id AND s.k = f.k + 1)
SELECT document_id, CAST(CASE WHEN 50 + total <= 2000 THEN 0 ELSE chunk_index END AS INTEGER) AS chunk_index,
  CAST(count(*) AS INTEGER) AS n_articles, CAST(min(article_index) AS INTEGER) AS first_index, CAST(max(article_index) AS INTEGER) AS last_index
FROM fold JOIN tot USING (document_id) GROUP BY 1, 2""",
)
def article_chunks(spark, path):
    docs = text.with_articles(Tables(spark, path).legal_text)
    sizes = F.transform("articles", lambda a: (F.length(a["content"]) + 100).cast("long"))
    chunks = chunking.article_chunks(docs, "document_id", "articles", F.lit(50), 2000, sizes)
    return chunks.select(
        "document_id",
        "chunk_index",
        F.size("articles").alias("n_articles"),
        F.array_min(F.transform("articles", lambda a: a["index"])).alias("first_index"),
        F.array_max(F.transform("articles", lambda a: a["index"])).alias("last_index"),
    )


@query(
    "merge_chunks",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_suppkey, l_partkey) AS rn FROM lineitem) WHERE rn = 1""",
)
def merge_chunks(spark, path):
    lines = Tables(spark, path).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    order = [F.col("l_suppkey"), F.col("l_partkey")]
    return chunking.merge_chunk_articles(lines, "l_orderkey", "l_linenumber", order)


@query(
    "concat_chunks",
    ctes(LEGAL_TEXT, ARTICLES, recursive=True)
    + """, s AS (SELECT document_id, article_index, content, row_number() OVER (PARTITION BY document_id ORDER BY article_index) - 1 AS k FROM article_rows)
SELECT document_id, CAST(k // 3 AS INTEGER) AS chunk, CAST(k % 3 AS INTEGER) AS position, article_index, content FROM s""",
)
def concat_chunks(spark, path):
    docs = text.with_articles(Tables(spark, path).legal_text).where(F.size("articles") > 0)
    chunk = F.explode(F.sequence(F.lit(0), F.floor((F.size("articles") - 1) / 3).cast("int"))).alias("chunk")
    chunks = docs.select("document_id", "articles", chunk).withColumn(
        "articles", F.slice("articles", F.col("chunk") * 3 + 1, F.lit(3))
    )
    rows = chunking.concat_chunk_articles(chunks, "document_id", "chunk", "articles")
    return rows.select("document_id", "chunk", "position", F.col("index").alias("article_index"), "content")


@query(
    "page_batches",
    """WITH b AS (SELECT conv_id, CAST(turn // 3 AS INTEGER) AS batch_index, min(turn) AS first_page, max(turn) AS last_page, count(*) AS n_pages FROM conversations GROUP BY 1, 2)
SELECT *, count(*) OVER (PARTITION BY conv_id) AS total_batches FROM b""",
)
def page_batches(spark, path):
    return chunking.page_batches(Tables(spark, path).conversations, "conv_id", "turn", 3)


_STOP = "HABLE"
_PAGES = f"""WITH s AS (SELECT conv_id, min(turn) FILTER (contains(upper(text), '{_STOP}')) AS stop, max(turn) AS last, min(turn) AS first FROM conversations GROUP BY 1),
kept AS (SELECT c.conv_id, c.turn, CASE WHEN last - first + 1 > 1 THEN chr(10) || chr(10) || '=== Page ' || (turn - first + 1) || '/' || (last - first + 1) || ' ===' || chr(10) || chr(10) || text ELSE text END AS page_text
  FROM conversations c JOIN s USING (conv_id) WHERE (stop IS NULL OR turn <= stop) AND length(trim(text, ' ' || chr(9) || chr(10) || chr(13))) > 0)
"""


@query("stop_word_pages", _PAGES + "SELECT * FROM kept")
def stop_word_pages(spark, path):
    pages = Tables(spark, path).conversations
    return chunking.kept_pages(pages, "conv_id", "turn", "text", _STOP).select("conv_id", "turn", "page_text")


@query(
    "stop_word_concat",
    _PAGES + "SELECT conv_id, CAST(turn // 1024 AS INTEGER) AS row_no, string_agg(page_text, '' ORDER BY turn) AS text FROM kept GROUP BY 1, 2",
)
def stop_word_concat(spark, path):
    pages = chunking.kept_pages(Tables(spark, path).conversations, "conv_id", "turn", "text", _STOP)
    return chunking.join_parts(pages, ["conv_id"], "turn", "page_text", separator="")


# JSON documents built from the legal texts.


def built_json(t: Tables):
    docs = text.with_articles(t.legal_text)
    body = F.col("text")
    signed = text.signatories(body, _patterns())
    return docs.where(F.size("articles") > 0).select(
        "document_id", "type", "year", "number",
        jsondoc.build_document(
            F.col("document_id"), F.col("type"), F.col("year"), F.col("number").cast("int"),
            F.round(F.size("articles") / F.lit(50.0), 6), F.lit("OCR"), F.lit("2025-01-01T00:00:00"),
            F.col("articles"), signed, text.law_title(body), text.french_date(body), text.promulgation_city(body),
        ).alias("json"),
    )


def _patterns():
    from lexmill.catalog.views import SIGNATORIES

    return SIGNATORIES


def json_parts_sql() -> str:
    from lexmill.catalog.text_queries import _DATE_ISO, _re2

    signed = " + ".join(f"CAST(regexp_matches(text, '{s['pattern']}') AS INTEGER)" for s in _patterns())
    return f"""parts AS (SELECT t.document_id, t.type, t.year, t.number, count(*) AS n_articles,
    nullif(trim(regexp_extract(any_value(text), '{_re2(text.TITLE)}', 1), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '') AS title,
    any_value({_DATE_ISO}) AS promulgation_date, any_value(nullif(trim(regexp_extract(text, '{text.CITY}', 1)), '')) AS promulgation_city,
    any_value({signed}) AS n_signatories, round(count(*) / 50.0, 6) AS confidence, bool_and(coalesce(step = 1, true)) AS strict
  FROM legal_text t JOIN (SELECT *, article_index - lag(article_index) OVER (PARTITION BY document_id ORDER BY article_index) AS step FROM article_rows) a USING (document_id)
  GROUP BY ALL)"""


@query(
    "build_json",
    ctes(LEGAL_TEXT, ARTICLES, json_parts_sql(), recursive=True)
    + """SELECT document_id, type, CAST(year AS INTEGER) AS year, CAST(number AS INTEGER) AS number, title, promulgation_date, promulgation_city,
  CAST(n_articles AS INTEGER) AS n_articles, CAST(n_signatories AS INTEGER) AS n_signatories, CAST(confidence AS DOUBLE) AS confidence,
  title IS NOT NULL AS writes_title, n_signatories > 0 AS writes_signatories FROM parts""",
)
def build_json(spark, path):
    return jsondoc.with_document(built_json(Tables(spark, path)).drop("type", "year", "number"), out="d").select(
        F.col("d.documentId").alias("document_id"),
        "d.type",
        "d.year",
        "d.number",
        "d.title",
        F.col("d.promulgationDate").alias("promulgation_date"),
        F.col("d.promulgationCity").alias("promulgation_city"),
        F.size("d.articles").alias("n_articles"),
        F.greatest(F.coalesce(F.size("d.signatories"), F.lit(0)), F.lit(0)).alias("n_signatories"),
        F.col("d._metadata.confidence").alias("confidence"),
        F.col("json").contains('"title":').alias("writes_title"),
        F.col("json").contains('"signatories":').alias("writes_signatories"),
    )


_BROKEN = "CASE event_id % 5 WHEN 0 THEN props WHEN 1 THEN '{\"_metadata\": {\"confidence\": 0.5, \"source\": null}, \"articles\": [{\"index\": 1}, {\"index\": 2}]}' WHEN 2 THEN '{\"_metadata\": {}, \"articles\": []}' WHEN 3 THEN '{\"articles\": [{\"index\": 2}, {\"index\": 1}], \"signatories\": [{}]}' ELSE '{broken ' || props END"
_BROKEN_SPARK = _BROKEN.replace("'{broken ' || props", "concat('{broken ', props)")


@query(
    "json_structure",
    f"""SELECT event_id, CASE WHEN json_valid(j) THEN coalesce(json_exists(j, '$._metadata') AND json_array_length(j, '$.articles') > 0, false) ELSE false END AS valid
FROM (SELECT event_id, {_BROKEN} AS j FROM events)""",
)
def json_structure(spark, path):
    rows = Tables(spark, path).events.select("event_id", F.expr(_BROKEN_SPARK).alias("json"))
    return jsondoc.with_root(rows).select("event_id", jsondoc.has_structure(F.col("root")).alias("valid"))


_PRESENT = " + ".join(
    f"CAST(coalesce(json_extract_string(j, '$._metadata.{f}') IS NOT NULL, false) AS INTEGER)" for f in jsondoc.METADATA_FIELDS
)


@query(
    "json_metadata_score",
    f"""SELECT event_id, round(CAST(CASE WHEN json_valid(j) THEN ({_PRESENT}) / 10.0 ELSE 0.0 END AS DOUBLE), 6) AS score
FROM (SELECT event_id, CASE WHEN json_valid(j) THEN j ELSE '{{}}' END AS j FROM (SELECT event_id, {_BROKEN} AS j FROM events))""",
)
def json_metadata_score(spark, path):
    rows = Tables(spark, path).events.select("event_id", F.expr(_BROKEN_SPARK).alias("json"))
    return jsondoc.with_root(rows).select("event_id", F.round(jsondoc.metadata_score(F.col("root")), 6).alias("score"))


@query(
    "json_quality",
    ctes(LEGAL_TEXT, ARTICLES, json_parts_sql(), recursive=True)
    + """SELECT document_id, round(CAST(0.30 + 0.3 * 0.30 + CASE WHEN strict THEN 0.30 ELSE 0.15 END + CASE WHEN n_signatories > 0 THEN 0.10 ELSE 0.0 END AS DOUBLE), 6) AS quality FROM parts""",
)
def json_quality(spark, path):
    docs = jsondoc.with_root(built_json(Tables(spark, path)))
    return docs.select("document_id", F.round(jsondoc.quality_score(F.col("root")), 6).alias("quality"))


@query(
    "json_quality_mixed",
    """SELECT event_id, CAST(CASE event_id % 5 WHEN 1 THEN 0.3 + 0.03 + 0.3 WHEN 2 THEN 0.15 WHEN 3 THEN 0.15 + 0.1 ELSE 0.0 END AS DOUBLE) AS quality FROM events""",
)
def json_quality_mixed(spark, path):
    rows = Tables(spark, path).events.select("event_id", F.expr(_BROKEN_SPARK).alias("json"))
    return jsondoc.with_root(rows).select("event_id", F.round(jsondoc.quality_score(F.col("root")), 6).alias("quality"))


@query(
    "model_reply_confidence",
    """SELECT conv_id, turn, round(CAST(least(1.0, n / 10.0) * 0.40 + (CASE WHEN role = 'user' THEN 3 ELSE 4 END) / 4.0 * 0.30
  + CASE WHEN n > 0 THEN 0.20 ELSE 0 END + CASE WHEN turn % 2 = 1 THEN 0.10 ELSE 0 END AS DOUBLE), 6) AS confidence
FROM (SELECT conv_id, turn, role, len(string_split(text, chr(10))) - 1 AS n FROM conversations)""",
)
def model_reply_confidence(spark, path):
    lines = F.split("text", "\n")
    articles = F.transform(F.slice(lines, 2, F.size(lines)), lambda s, i: F.struct((i + 1).alias("index"), s.alias("content")))
    reply = F.to_json(
        F.struct(
            F.when(F.col("role") != "user", F.get(lines, 0)).alias("titre"),
            F.col("conv_id").alias("numero"),
            F.lit(2020).alias("annee"),
            F.lit("loi").alias("type"),
            articles.alias("articles"),
            F.when(F.col("turn") % 2 == 1, F.array(F.struct(F.col("role").alias("nom")))).alias("signataires"),
        )
    )
    fenced = text.strip_fences(F.concat(F.lit("```json\n"), reply, F.lit("\n```")))
    replies = jsondoc.with_root(Tables(spark, path).conversations.select("conv_id", "turn", fenced.alias("json")))
    return replies.select(
        "conv_id", "turn", F.round(jsondoc.model_reply_confidence(F.col("root")), 6).alias("confidence")
    )


def _titles(batch):
    """First line of each text; blank first lines give no row."""
    first = batch["text"].str.split("\n", n=1).str[0]
    return batch[["doc_id"]].assign(title=first.where(first.str.strip() != "", None))


transform.register(
    transform.Transformation(
        "first-line", _titles, "doc_id long, title string", accepts=lambda: F.col("lang") == "fr", required="title"
    )
)


@query(
    "user_transformation",
    "SELECT doc_id, split_part(text, chr(10), 1) AS title FROM documents WHERE lang = 'fr' AND trim(split_part(text, chr(10), 1), ' ' || chr(9)) <> ''",
)
def user_transformation(spark, path):
    docs = Tables(spark, path).documents.select("doc_id", "lang", "text")
    return transform.named("first-line").apply(docs)


def _second_line(batch):
    """Fails on texts without a second line, as user code does on what it did not expect."""
    return batch.assign(line=[t.split("\n")[1] for t in batch["text"]])[["doc_id", "line"]]


transform.register(transform.Transformation("second-line", _second_line, "doc_id long, line string"))


@query(
    "quarantined_rows",
    """SELECT doc_id, CASE WHEN contains(text, chr(10)) THEN split_part(text, chr(10), 2) END AS line,
  CASE WHEN text IS NULL THEN 'AttributeError' WHEN NOT contains(text, chr(10)) THEN 'IndexError' END AS error FROM documents""",
)
def quarantined_rows(spark, path):
    """Rows that a user's function cannot take are set aside with the error, the others go on."""
    docs = Tables(spark, path).documents.select("doc_id", "text")
    good, bad = transform.named("second-line").apply_or_quarantine(docs, ["doc_id"])
    good = good.withColumn("error", F.lit(None).cast("string"))
    kind = F.substring_index("error", ":", 1).alias("error")
    return good.unionByName(bad.select("doc_id", F.lit(None).cast("string").alias("line"), kind))


def _sentences(text):
    parts = text.split(". ")
    return [p + ". " for p in parts[:-1]] + parts[-1:]


chunkers.register(chunkers.Chunker("sentences", _sentences))


@query(
    "user_chunker",
    """SELECT doc_id, CAST(CASE WHEN text IS NULL THEN 1 ELSE len(string_split(text, '. ')) END AS INTEGER) AS n_chunks,
  sha256(text) AS sha256 FROM documents""",
)
def user_chunker(spark, path):
    """A chunker of the user's own, and its inverse."""
    chunks = chunkers.split(Tables(spark, path).documents, "doc_id", "sentences")
    whole = chunkers.join(chunks, "doc_id", "sentences")
    return whole.select("doc_id", "n_chunks", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"))

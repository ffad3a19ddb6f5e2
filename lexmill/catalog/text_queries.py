"""Queries over texts: extraction, metadata, scoring, cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill.catalog import query
from lexmill.catalog.views import ARTICLES, DICTIONARY, LEGAL_TEXT, SIGNATORIES, WORD_SEPARATOR, Tables, ctes
from lexmill.functions import scoring, text
from lexmill.operators import patterns
from lexmill.operators.sequence import sequence_counts, sequence_scores
from lexmill.operators.words import score_texts


@query(
    "extract_articles",
    ctes(LEGAL_TEXT, ARTICLES, recursive=True)
    + "SELECT document_id, article_index, printed_number, content FROM article_rows",
)
def extract_articles(spark, path):
    docs = text.with_articles(Tables(spark, path).legal_text)
    return docs.select("document_id", F.inline("articles")).select(
        "document_id", F.col("index").alias("article_index"), "printed_number", "content"
    )


SEQUENCE_FROM_ARTICLES = """article_steps AS (
  SELECT document_id, article_index, article_index - lag(article_index) OVER (PARTITION BY document_id ORDER BY article_index) AS d
  FROM article_rows),
article_counts AS (
  SELECT document_id, count(*) AS n_articles, min(article_index) AS low, max(article_index) AS high,
    coalesce(sum(CASE WHEN d > 1 THEN d - 1 END), 0) AS gaps
  FROM article_steps GROUP BY 1),
sequence AS (
  SELECT document_id, n_articles, CASE WHEN n_articles = 1 THEN CASE WHEN low = 1 THEN 1.0 ELSE 0.8 END
    ELSE greatest(0.0, 1.0 - gaps * 0.15) END AS sequence_score
  FROM article_counts)"""


def _confidence_sql(words: str, terms: list[str], extra: str) -> str:
    hits = " + ".join(f"CAST(contains(lower(text), '{t}') AS INTEGER)" for t in terms)
    return (
        ctes(LEGAL_TEXT, ARTICLES, DICTIONARY, SEQUENCE_FROM_ARTICLES, recursive=True)
        + f""",
words AS (
  SELECT w.document_id, w.word, d.word IS NULL AS unknown
  FROM ({words}) w LEFT JOIN dictionary d ON d.word = w.word WHERE length(w.word) >= 3),
word_stats AS (
  SELECT document_id, count(*) AS n_tokens, count(*) FILTER (unknown) / count(*) AS unknown_rate,
    count(DISTINCT CASE WHEN unknown THEN word END) AS n_unknown_words
  FROM words GROUP BY 1),
features AS (
  SELECT t.document_id, coalesce(s.n_articles, 0) AS n_articles, coalesce(s.sequence_score, 0.0) AS sequence_score,
    length(t.text) AS n_chars, {hits} AS n_terms, coalesce(w.unknown_rate, 0.0) AS r, coalesce(w.n_unknown_words, 0) AS n
  FROM legal_text t LEFT JOIN sequence s USING (document_id) LEFT JOIN word_stats w USING (document_id)),
penalties AS (
  SELECT *, least(1.0, CASE WHEN r <= 0.10 THEN r * 2.0 WHEN r <= 0.30 THEN 0.2 + (r - 0.10) * 1.5
    WHEN r <= 0.50 THEN 0.5 + (r - 0.30) * 1.5 ELSE least(1.0, 0.8 + (r - 0.50) * 0.4) END + {extra}) AS penalty
  FROM features)
SELECT document_id, CAST(n_articles AS INTEGER) AS n_articles, round(CAST(sequence_score AS DOUBLE), 6) AS sequence_score,
  round(CAST(r AS DOUBLE), 6) AS unknown_rate, CAST(n AS INTEGER) AS n_unknown_words,
  round(CAST(CASE WHEN n_chars > 0 AND n_articles > 0 THEN
    least(n_articles / 10.0, 1.0) * 0.20 + sequence_score * 0.20 + least(n_chars / 5000.0, 1.0) * 0.15
    + (1.0 - penalty) * 0.25 + least(n_terms / 8.0, 1.0) * 0.20 ELSE 0.0 END AS DOUBLE), 6) AS confidence
FROM penalties""".replace("\n,", ",", 1)
    )


def _confidence(spark, path, variant: str):
    t = Tables(spark, path)
    scored = score_texts(t.legal_text.select("document_id", "text"), t.dictionary, variant=variant)
    return scored.select(
        "document_id",
        "n_articles",
        F.round("sequence_score", 6).alias("sequence_score"),
        F.round("unknown_rate", 6).alias("unknown_rate"),
        "n_unknown_words",
        F.round("confidence", 6).alias("confidence"),
    )


@query(
    "confidence_score",
    _confidence_sql(
        f"SELECT document_id, unnest(regexp_split_to_array(lower(text), '{WORD_SEPARATOR}')) AS word FROM legal_text",
        text.LEGAL_TERMS["extractor"],
        "least(0.2, n / 100.0 * 0.2)",
    ),
)
def confidence_score(spark, path):
    return _confidence(spark, path, "extractor")


@query(
    "confidence_score_qa",
    _confidence_sql(
        r"SELECT document_id, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS word FROM legal_text",
        text.LEGAL_TERMS["qa"],
        "CASE WHEN n > 100 THEN 0.05 ELSE 0 END + CASE WHEN n > 200 THEN 0.05 ELSE 0 END",
    ),
)
def confidence_score_qa(spark, path):
    return _confidence(spark, path, "qa")


ARTICLE_ORDER = "l_shipdate, l_partkey, l_suppkey, l_linenumber"


def _line_order():
    from lexmill.operators.skew import micros

    return [micros(F.col("l_shipdate")), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")]


_STEPS = f"""WITH steps AS (
  SELECT l_orderkey, l_linenumber, l_linenumber - lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY {ARTICLE_ORDER}) AS d
  FROM lineitem)
"""


@query(
    "sequence_score_pairwise",
    _STEPS
    + """, c AS (SELECT l_orderkey, count(*) AS n_articles, coalesce(sum(CASE WHEN d > 1 THEN d - 1 END), 0) AS gaps,
    count(*) FILTER (d = 0) AS duplicates, count(*) FILTER (d < 0) AS inversions, min(l_linenumber) AS low
  FROM steps GROUP BY 1)
SELECT l_orderkey, n_articles, CAST(gaps AS BIGINT) AS gaps, duplicates, inversions,
  round(CAST(CASE WHEN n_articles = 1 THEN CASE WHEN low = 1 THEN 1.0 ELSE 0.8 END
    ELSE greatest(0.0, 1.0 - (gaps * 0.15 + duplicates * 0.25 + inversions * 0.30)) END AS DOUBLE), 6) AS sequence_score
FROM c""",
)
def sequence_score_pairwise(spark, path):
    scored = sequence_scores(Tables(spark, path).lineitem, "l_orderkey", "l_linenumber", _line_order())
    return scored.select(
        "l_orderkey", "n_articles", F.col("gaps").cast("long").alias("gaps"), "duplicates", "inversions",
        F.round("sequence_score", 6).alias("sequence_score"),
    )


@query(
    "sequence_score_set",
    _STEPS
    + """, c AS (SELECT l_orderkey, count(*) AS n_articles, max(l_linenumber) - min(l_linenumber) + 1 - count(DISTINCT l_linenumber) AS gaps,
    count(*) - count(DISTINCT l_linenumber) AS duplicates, count(*) FILTER (d < 0) AS inversions, min(l_linenumber) AS low
  FROM steps GROUP BY 1)
SELECT l_orderkey, n_articles, CAST(gaps AS BIGINT) AS gaps, duplicates, inversions,
  round(CAST(CASE WHEN n_articles = 1 THEN CASE WHEN low = 1 THEN 1.0 ELSE 0.8 END
    ELSE greatest(0.0, 1.0 - (gaps * 0.15 + duplicates * 0.25 + inversions * 0.30)) END AS DOUBLE), 6) AS sequence_score
FROM c""",
)
def sequence_score_set(spark, path):
    scored = sequence_scores(Tables(spark, path).lineitem, "l_orderkey", "l_linenumber", _line_order(), "qa")
    return scored.select(
        "l_orderkey", "n_articles", F.col("gaps").cast("long").alias("gaps"), "duplicates", "inversions",
        F.round("sequence_score", 6).alias("sequence_score"),
    )


@query(
    "strict_sequence",
    _STEPS + "SELECT l_orderkey, bool_and(coalesce(d = 1, true)) AS strict FROM steps GROUP BY 1",
)
def strict_sequence(spark, path):
    counts = sequence_counts(Tables(spark, path).lineitem, "l_orderkey", "l_linenumber", _line_order())
    return counts.select("l_orderkey", "strict")


_TERMS = text.LEGAL_TERMS["extractor"]


@query(
    "legal_term_count",
    ctes(LEGAL_TEXT)
    + "SELECT document_id, "
    + " + ".join(f"CAST(contains(lower(text), '{t}') AS INTEGER)" for t in _TERMS)
    + " AS n_terms FROM legal_text",
)
def legal_term_count(spark, path):
    return Tables(spark, path).legal_text.select(
        "document_id", text.legal_term_count(F.col("text")).alias("n_terms")
    )


# Correction rules for the driver texts; later rules act on the output of earlier ones.
RULES = [
    ("tion", "ssion"), ("ssion ", "xion "), ("eaux", "aux"), ("aux", "ots"), ("ç", "c"),
    ("thth", "th"), ("sch", "ch"), ("REPUBLIQUE", "RÉPUBLIQUE"), ("  ", " "), ("***", ""),
]
_CORRECTED = "text"
for _w, _c in RULES:
    _CORRECTED = f"replace({_CORRECTED}, '{_w}', '{_c}')"


@query("apply_corrections", f"SELECT doc_id, {_CORRECTED} AS text FROM documents")
def apply_corrections(spark, path):
    docs = Tables(spark, path).documents
    return docs.select("doc_id", text.apply_corrections(F.col("text"), RULES).alias("text"))


@query(
    "apply_corrections_many",
    r"""WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[a-zA-Z]{4,}')) AS w FROM benchmark),
r AS (SELECT list({'w': w, 'c': reverse(w)} ORDER BY md5(w)) AS rules FROM w)
SELECT doc_id, list_reduce(rules, lambda a, x: {'w': replace(a.w, x.w, x.c), 'c': ''}, {'w': text, 'c': ''}).w AS text
FROM documents, r WHERE text IS NOT NULL UNION ALL SELECT doc_id, text FROM documents WHERE text IS NULL""",
)
def apply_corrections_many(spark, path):
    """Hundreds of rules that feed each other, one after another: every word of a reference text is turned round."""
    t = Tables(spark, path)
    found = t.benchmark.select(F.explode(F.regexp_extract_all("text", F.lit("[a-zA-Z]{4,}"), F.lit(0))).alias("w")).distinct()
    rules = [(r["w"], r["w"][::-1]) for r in found.orderBy(F.md5(F.col("w").cast("binary"))).collect()]
    return patterns.correct(t.documents.select("doc_id", "text"), rules)


@query("apply_corrections_fold", f"SELECT doc_id, {_CORRECTED} AS text FROM documents")
def apply_corrections_fold(spark, path):
    docs = Tables(spark, path).documents
    return docs.select("doc_id", text.apply_corrections(F.col("text"), RULES, unrolled=0).alias("text"))


_CLEAN = "text"
for _p, _r in text.CLEANING:
    _pattern, _to = _p.replace("'", "''"), _r.replace("\n", "' || chr(10) || '")
    _CLEAN = f"regexp_replace({_CLEAN}, '{_pattern}', '{_to}', 'g')"


@query("clean_text", f"SELECT doc_id, {_CLEAN} AS text FROM documents")
def clean_text(spark, path):
    return Tables(spark, path).documents.select("doc_id", text.clean_text(F.col("text")).alias("text"))


_DEFECTS = ", ".join(
    f"CASE WHEN contains(text, '{probe}') THEN '{name}' END" for name, probe in text.DEFECTS.items()
)
_DATE_ISO = f"""CASE WHEN regexp_extract(text, '{text.DATE}', 1) <> '' THEN strftime(try_strptime(
    regexp_extract(text, '{text.DATE}', 4) || '-' || lpad(CAST(list_position([{", ".join(f"'{m}'" for m in ("janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre"))}],
      regexp_extract(text, '{text.DATE}', 3)) AS VARCHAR), 2, '0') || '-' || lpad(regexp_extract(text, '{text.DATE}', 1), 2, '0'), '%Y-%m-%d'), '%Y-%m-%d') END"""


@query(
    "defect_flags",
    ctes(LEGAL_TEXT)
    + f"""SELECT document_id, concat_ws(',', {_DEFECTS},
  CASE WHEN regexp_matches(text, '{text.DATE}') AND ({_DATE_ISO}) IS NULL THEN 'date_not_extracted' END,
  CASE WHEN regexp_matches(text, '{text.PIPE_IN_WORD}') THEN 'pipe_in_word' END,
  CASE WHEN regexp_matches(text, '{text.SUSPECT_WORD}') THEN 'suspect_word' END) AS defects FROM legal_text""",
)
def defect_flags(spark, path):
    flags = text.defect_flags(F.col("text"), text.french_date(F.col("text")))
    return Tables(spark, path).legal_text.select("document_id", F.array_join(flags, ",").alias("defects"))


_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_QUALITY = r"""CASE WHEN length(trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) > 0 THEN
  length(regexp_replace(text, '[^\p{L}\p{Nd}]', '', 'g')) / length(text) * 0.7
  + least(length(regexp_replace(text, '[^ \t\n\r\f\x0B]', '', 'g')) / length(text), 0.2) * 1.5 ELSE 0.0 END"""


@query("text_quality", f"SELECT doc_id, round(CAST({_QUALITY} AS DOUBLE), 6) AS quality FROM documents")
def text_quality(spark, path):
    return Tables(spark, path).documents.select(
        "doc_id", F.round(text.text_quality(F.col("text")), 6).alias("quality")
    )


@query(
    "needs_ocr",
    f"""SELECT doc_id, NOT (({_QUALITY}) >= 0.70 AND length(trim(split_part(text, chr(10), 1), {_BLANKS})) > 50) AS needs_ocr
FROM documents""",
)
def needs_ocr(spark, path):
    quality = text.text_quality(F.col("text"))
    first = F.split_part(F.col("text"), F.lit("\n"), F.lit(1))
    return Tables(spark, path).documents.select("doc_id", text.needs_ocr(quality, first).alias("needs_ocr"))


def _re2(pattern: str) -> str:
    return pattern.replace("(?iu)", "(?i)").replace("(?imsu)", "(?ims)").replace("'", "''")


_S = {k: f"regexp_matches(text, '{_re2(p)}')" for k, p in text.SECTION_PATTERNS.items()}


@query(
    "structure_score",
    ctes(LEGAL_TEXT)
    + f""", flags AS (SELECT document_id, {_S['republic']} AND {_S['motto']} AND {_S['presidency']} AS header, {_S['title']} AS title,
  {_S['approval']} AS approval, {_S['closing']} AS closing, {_S['footer']} AND {_S['stop']} AS footer FROM legal_text)
SELECT *, round(CAST((header::INT + title::INT + approval::INT + closing::INT + footer::INT) / 5.0 AS DOUBLE), 6) AS structure_score FROM flags""",
)
def structure_score(spark, path):
    flags = Tables(spark, path).legal_text.select("document_id", text.section_flags(F.col("text")).alias("s"))
    return flags.select("document_id", "s.*", F.round(text.structure_score(F.col("s")), 6).alias("structure_score"))


@query(
    "metadata_date_city",
    ctes(LEGAL_TEXT)
    + f"""SELECT document_id, {_DATE_ISO} AS promulgation_date,
  nullif(trim(regexp_extract(text, '{text.CITY}', 1)), '') AS promulgation_city FROM legal_text""",
)
def metadata_date_city(spark, path):
    return Tables(spark, path).legal_text.select(
        "document_id",
        text.french_date(F.col("text")).alias("promulgation_date"),
        text.promulgation_city(F.col("text")).alias("promulgation_city"),
    )


@query(
    "law_title",
    ctes(LEGAL_TEXT)
    + f"SELECT document_id, nullif(trim(regexp_extract(text, '{_re2(text.TITLE)}', 1), {_BLANKS}), '') AS title FROM legal_text",
)
def law_title(spark, path):
    return Tables(spark, path).legal_text.select("document_id", text.law_title(F.col("text")).alias("title"))


_ISO_TEXT = "year(o_orderdate) || '-' || lpad(CAST(o_orderkey % 14 AS VARCHAR), 2, '0') || '-' || lpad(CAST(o_custkey % 33 AS VARCHAR), 2, '0')"


@query(
    "iso_dates",
    f"""SELECT o_orderkey, strftime(CASE WHEN regexp_matches(v, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$') THEN try_strptime(v, '%Y-%m-%d') END, '%Y-%m-%d') AS iso
FROM (SELECT o_orderkey, trim(CASE WHEN o_orderkey % 5 = 0 THEN ' ' ELSE '' END || {_ISO_TEXT}) AS v FROM orders)""",
)
def iso_dates(spark, path):
    built = F.concat(
        F.when(F.col("o_orderkey") % 5 == 0, " ").otherwise(""),
        F.concat_ws(
            "-",
            F.year("o_orderdate").cast("string"),
            F.lpad((F.col("o_orderkey") % 14).cast("string"), 2, "0"),
            F.lpad((F.col("o_custkey") % 33).cast("string"), 2, "0"),
        ),
    )
    return Tables(spark, path).orders.select("o_orderkey", F.date_format(text.iso_date(built), "yyyy-MM-dd").alias("iso"))


def _signatory_sql(extra: str = "") -> str:
    arms = []
    for i, s in enumerate(SIGNATORIES):
        q = lambda v: "NULL" if v is None else f"DATE '{v}'"
        low, high = q(s["start_date"]), q(s["end_date"])
        cond = f"regexp_matches(text, '{s['pattern']}')"
        if extra:
            cond += f" AND ({extra}) >= coalesce({low}, ({extra})) AND ({extra}) <= coalesce({high}, ({extra}))"
        role = s["role"].replace("'", "''")
        arms.append(
            f"SELECT document_id, {i} AS pos, '{role}' AS role, '{s['name']}' AS name FROM dated WHERE {cond}"
        )
    return (
        ctes(LEGAL_TEXT, f"dated AS (SELECT document_id, text, CAST(({_DATE_ISO}) AS DATE) AS d FROM legal_text)")
        + "SELECT document_id, CAST(row_number() OVER (PARTITION BY document_id ORDER BY pos) AS INTEGER) AS signatory_order, role, name FROM (\n"
        + "\nUNION ALL ".join(arms)
        + ")"
    )


def _signatories(spark, path, promulgated=None):
    found = text.signatories(F.col("text"), SIGNATORIES, promulgated)
    rows = Tables(spark, path).legal_text.select("document_id", F.inline(found))
    return rows.select("document_id", F.col("order").alias("signatory_order"), "role", "name")


@query("signatory_match", _signatory_sql())
def signatory_match(spark, path):
    return _signatories(spark, path)


@query("signatory_match_in_office", _signatory_sql("d"))
def signatory_match_in_office(spark, path):
    return _signatories(spark, path, text.french_date(F.col("text")).cast("date"))


@query(
    "strip_fences",
    f"""SELECT conv_id, turn, trim(regexp_replace(regexp_replace(trim(v, {_BLANKS}), '^(?:```json)?(?:```)?', ''), '```$', ''), {_BLANKS}) AS reply
FROM (SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN '```json' || chr(10) || text || chr(10) || '```' WHEN 1 THEN '```' || text || '``` ' ELSE text END AS v FROM conversations)""",
)
def strip_fences(spark, path):
    wrapped = (
        F.when(F.col("turn") % 3 == 0, F.concat(F.lit("```json\n"), "text", F.lit("\n```")))
        .when(F.col("turn") % 3 == 1, F.concat(F.lit("```"), "text", F.lit("``` ")))
        .otherwise(F.col("text"))
    )
    return Tables(spark, path).conversations.select("conv_id", "turn", text.strip_fences(wrapped).alias("reply"))


@query(
    "request_texts",
    "SELECT doc_id, 'Extract the articles of this text (' || lang || '):' || chr(10) || text AS request FROM documents",
)
def request_texts(spark, path):
    return Tables(spark, path).documents.select(
        "doc_id",
        text.render("Extract the articles of this text (%s):\n%s", F.col("lang"), F.col("text")).alias("request"),
    )


@query(
    "token_estimates",
    """SELECT doc_id, CAST(length(text) // 4 AS INTEGER) AS n_tokens,
  CAST(CASE WHEN length(text) <= 1000 THEN 1 ELSE ceil((length(text) - 100) / 900.0) END AS INTEGER) AS n_chunks,
  CAST(CASE WHEN length(text) <= 1000 THEN 1 ELSE ceil(length(text) / 900.0) END AS INTEGER) AS n_chunks_upper
FROM documents""",
)
def token_estimates(spark, path):
    n = F.length("text")
    return Tables(spark, path).documents.select(
        "doc_id",
        scoring.token_estimate(F.col("text")).alias("n_tokens"),
        scoring.window_chunk_estimate(n, 1000, 100).alias("n_chunks"),
        scoring.window_chunk_estimate(n, 1000, 100, subtract=False).alias("n_chunks_upper"),
    )


_PROBES = {
    "n_years": text.YEAR, "n_space_runs": text.SPACES, "n_blank_runs": text.BLANK_LINES,
    "n_pipe_words": text.PIPE_IN_WORD, "n_artefacts": text.ARTEFACT,
}


@query(
    "text_probes",
    "SELECT doc_id, "
    + ", ".join(f"CAST(len(regexp_extract_all(text, '{p}')) AS INTEGER) AS {n}" for n, p in _PROBES.items())
    + f", coalesce(regexp_matches(split_part(text, ' ', 1) || '@example.org', '{text.EMAIL}'), false) AS email_like FROM documents",
)
def text_probes(spark, path):
    first = F.split_part(F.col("text"), F.lit(" "), F.lit(1))
    return Tables(spark, path).documents.select(
        "doc_id",
        text.probe_counts(F.col("text")).alias("p"),
        text.is_email(F.concat(first, F.lit("@example.org"))).alias("email_like"),
    ).select("doc_id", "p.*", "email_like")

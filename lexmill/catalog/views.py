"""Tables of the domain, derived from the driver tables, in Spark and in SQL.

orders = registry, lineitem = articles, probes and inventory, documents = texts, benchmark =
dictionary source, pages = payloads, events = probe log, conversations = scanned pages.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.session import spread

# Tables whose rows carry long texts, with the column to spread them by.
_TEXT_KEYS = {"documents": "doc_id", "pages": "page_id"}

BASE_URL = "https://laws.example.org/doc"

# Signatory patterns used with the derived legal texts.
SIGNATORIES = [
    {"pattern": "Jean.*KOFFI", "role": "Président de la République", "name": "Jean KOFFI",
     "start_date": "2006-04-06", "end_date": None},
    {"pattern": "Ministre.*Finances|Awa.*DOSSOU", "role": "Ministre des Finances", "name": "Awa DOSSOU",
     "start_date": "2000-01-01", "end_date": "2010-12-31"},
    {"pattern": "Garde des Sceaux", "role": "Ministre de la Justice", "name": "Paul AGBO",
     "start_date": None, "end_date": None},
    {"pattern": "Marie.*SOSSA", "role": "Ministre du Plan", "name": "Marie SOSSA",
     "start_date": "2012-06-01", "end_date": None},
]

_MONTHS = [
    "janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre",
    "octobre", "novembre", "décembre",
]
_MONTH_LIST = ", ".join(f"'{m}'" for m in _MONTHS)

_NUMBER = "CASE WHEN (doc_id + {i}) % 17 = 8 THEN {half} ELSE {half} + 1 END"

# One legal text per document: head, the lines of the whole document with article markers on every
# second line (repeats and citations included), and a closing block. Built per row.
LEGAL_TEXT_SPARK = f"""
concat_ws('\\n',
  CASE WHEN doc_id % 5 <> 0 THEN 'REPUBLIQUE DU BENIN\\nFraternité-Justice-Travail\\nPRESIDENCE DE LA REPUBLIQUE' END,
  CASE WHEN doc_id % 4 <> 0 THEN concat('LOI N° ', 1990 + doc_id % 30, '-', doc_id % 90 + 10) END,
  CASE WHEN doc_id % 3 <> 0 THEN 'L''Assemblée nationale a délibéré et adopté' END,
  transform(split(text, '\\n'), (s, i) -> CASE
    WHEN i = 0 THEN concat('Article 1er : ', s)
    WHEN i % 2 = 1 AND (doc_id + i) % 4 = 3 THEN concat('Article 123 cité : ', s)
    WHEN i % 2 = 1 THEN s
    WHEN (doc_id + i) % 3 = 0 THEN concat('ARTICLE ', {_NUMBER.format(i='i', half='(i div 2)')}, ' : ', s)
    WHEN (doc_id + i) % 3 = 1 THEN concat('Art. ', {_NUMBER.format(i='i', half='(i div 2)')}, ' ', s)
    ELSE concat('Article ', {_NUMBER.format(i='i', half='(i div 2)')}, ' nouveau : ', s) END),
  CASE WHEN doc_id % 6 <> 0 THEN 'La présente loi sera exécutée comme loi de l''Etat' END,
  CASE WHEN doc_id % 7 <> 0 THEN concat('Fait à ', CASE WHEN doc_id % 3 = 0 THEN 'Porto-Novo' ELSE 'Cotonou' END,
    ', le ', doc_id % 31 + 1, ' ', element_at(array({_MONTH_LIST}), cast(doc_id % 12 + 1 AS int)), ' ', 1990 + doc_id % 30) END,
  CASE WHEN doc_id % 2 = 0 THEN 'Le Président de la République, Jean B. KOFFI' END,
  CASE WHEN doc_id % 3 = 1 THEN 'Le Ministre de l''Economie et des Finances' END,
  CASE WHEN doc_id % 5 = 2 THEN 'Le Garde des Sceaux, Ministre de la Justice' END,
  CASE WHEN doc_id % 7 = 3 THEN 'Marie SOSSA' END,
  CASE WHEN doc_id % 5 <> 2 THEN 'AMPLIATIONS : PR 6 AN 4' END)
"""

LEGAL_TEXT = f"""legal_text AS (
  SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'loi' ELSE 'decret' END AS type,
    CAST(1990 + doc_id % 30 AS INTEGER) AS year, doc_id AS number,
    CASE WHEN doc_id % 2 = 0 THEN 'loi' ELSE 'decret' END || '-' || (1990 + doc_id % 30) || '-' || doc_id AS document_id,
    concat_ws(chr(10),
      CASE WHEN doc_id % 5 <> 0 THEN 'REPUBLIQUE DU BENIN' || chr(10) || 'Fraternité-Justice-Travail' || chr(10) || 'PRESIDENCE DE LA REPUBLIQUE' END,
      CASE WHEN doc_id % 4 <> 0 THEN 'LOI N° ' || (1990 + doc_id % 30) || '-' || (doc_id % 90 + 10) END,
      CASE WHEN doc_id % 3 <> 0 THEN 'L''Assemblée nationale a délibéré et adopté' END,
      array_to_string(list_transform(string_split(text, chr(10)), lambda s, k: CASE
        WHEN k = 1 THEN 'Article 1er : ' || s
        WHEN (k - 1) % 2 = 1 AND (doc_id + k - 1) % 4 = 3 THEN 'Article 123 cité : ' || s
        WHEN (k - 1) % 2 = 1 THEN s
        WHEN (doc_id + k - 1) % 3 = 0 THEN 'ARTICLE ' || ({_NUMBER.format(i='k - 1', half='((k - 1) // 2)')}) || ' : ' || s
        WHEN (doc_id + k - 1) % 3 = 1 THEN 'Art. ' || ({_NUMBER.format(i='k - 1', half='((k - 1) // 2)')}) || ' ' || s
        ELSE 'Article ' || ({_NUMBER.format(i='k - 1', half='((k - 1) // 2)')}) || ' nouveau : ' || s END), chr(10)),
      CASE WHEN doc_id % 6 <> 0 THEN 'La présente loi sera exécutée comme loi de l''Etat' END,
      CASE WHEN doc_id % 7 <> 0 THEN 'Fait à ' || CASE WHEN doc_id % 3 = 0 THEN 'Porto-Novo' ELSE 'Cotonou' END || ', le '
        || (doc_id % 31 + 1) || ' ' || ([{_MONTH_LIST}])[doc_id % 12 + 1] || ' ' || (1990 + doc_id % 30) END,
      CASE WHEN doc_id % 2 = 0 THEN 'Le Président de la République, Jean B. KOFFI' END,
      CASE WHEN doc_id % 3 = 1 THEN 'Le Ministre de l''Economie et des Finances' END,
      CASE WHEN doc_id % 5 = 2 THEN 'Le Garde des Sceaux, Ministre de la Justice' END,
      CASE WHEN doc_id % 7 = 3 THEN 'Marie SOSSA' END,
      CASE WHEN doc_id % 5 <> 2 THEN 'AMPLIATIONS : PR 6 AN 4' END) AS text
  FROM documents)"""

# Lines, numbered markers, the greedy chain of accepted markers, and the articles between them.
ARTICLES = r"""text_lines AS (
  SELECT document_id, string_split(rtrim(text, chr(10)), chr(10)) AS l FROM legal_text),
line_rows AS (SELECT document_id, unnest(l) AS s, generate_subscripts(l, 1) AS p FROM text_lines),
markers AS (
  SELECT document_id, p, CASE WHEN lower(x) IN ('1er', 'premier') THEN 1 ELSE CAST(x AS INTEGER) END AS n
  FROM (SELECT document_id, p, regexp_extract(s, '(?i)(?:Article|Art\.)\s+(1er|premier|\d+)', 1) AS x
        FROM line_rows WHERE regexp_matches(s, '^\s*(Article|ARTICLE|Art\.)\s+'))
  WHERE x <> ''),
accepted AS (
  SELECT document_id, min(p) AS p, CAST(1 AS BIGINT) AS k FROM markers GROUP BY document_id
  UNION ALL
  SELECT a.document_id, min(m.p), a.k + 1
  FROM accepted a JOIN markers m ON m.document_id = a.document_id AND m.p > a.p AND m.n = a.k + 1
  GROUP BY a.document_id, a.k),
article_rows AS (
  SELECT * FROM (
    SELECT a.document_id, CAST(a.k AS INTEGER) AS article_index, m.n AS printed_number,
      trim(array_to_string(t.l[a.p : coalesce(lead(a.p) OVER (PARTITION BY a.document_id ORDER BY a.k) - 1, len(t.l))], chr(10)),
           ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS content
    FROM accepted a JOIN markers m ON m.document_id = a.document_id AND m.p = a.p
    JOIN text_lines t ON t.document_id = a.document_id)
  WHERE length(content) > 10)"""

WORD_SEPARATOR = "[^a-zàâäéèêëïîôùûüÿçœæ]+"
DICTIONARY = f"""dictionary AS (
  SELECT DISTINCT word FROM (SELECT unnest(regexp_split_to_array(lower(text), '{WORD_SEPARATOR}')) AS word FROM benchmark)
  WHERE length(word) >= 3)"""

REGISTRY = f"""registry AS (
  SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'loi' ELSE 'decret' END AS type,
    CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey AS number,
    CASE WHEN o_orderkey % 2 = 0 THEN 'loi' ELSE 'decret' END || '-' || year(o_orderdate) || '-' || o_orderkey AS document_id,
    CASE o_orderstatus WHEN 'F' THEN 'FETCHED' WHEN 'O' THEN 'EXTRACTED' WHEN 'P' THEN 'DOWNLOADED' END AS status,
    '{BASE_URL}/' || CASE WHEN o_orderkey % 2 = 0 THEN 'loi' ELSE 'decret' END || '-' || year(o_orderdate) || '-' || o_orderkey AS url,
    o_orderkey, o_totalprice, o_orderdate
  FROM orders)"""

# Files of a document: pdf, ocr or json by the return flag of its lines; recorded downloads by line status.
INVENTORY = """inventory AS (
  SELECT l_orderkey, CASE l_returnflag WHEN 'R' THEN 'pdf' WHEN 'A' THEN 'ocr' ELSE 'json' END AS kind,
    CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS length
  FROM lineitem GROUP BY ALL)"""
RECORDED = "recorded AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_linestatus = 'F')"
PRESENCE = """presence AS (
  SELECT r.*, coalesce(f.has_pdf, false) AS has_pdf, coalesce(f.has_ocr, false) AS has_ocr,
    coalesce(f.has_json, false) AS has_json, d.l_orderkey IS NOT NULL AS is_recorded
  FROM registry r
  LEFT JOIN (SELECT l_orderkey, bool_or(kind = 'pdf') AS has_pdf, bool_or(kind = 'ocr') AS has_ocr,
               bool_or(kind = 'json') AS has_json FROM inventory GROUP BY 1) f ON f.l_orderkey = r.o_orderkey
  LEFT JOIN recorded d ON d.l_orderkey = r.o_orderkey)"""

# Probe outcome of a document: the return flag of its last line decides the code.
PROBES = """probes AS (
  SELECT l_orderkey, max_by(CASE l_returnflag WHEN 'R' THEN 404 WHEN 'A' THEN 429 ELSE 200 END,
      struct_pack(a := l_shipdate, b := l_linenumber, c := l_partkey, d := l_suppkey)) AS code,
    min_by(CASE l_linestatus WHEN 'F' THEN 200 ELSE 404 END,
      struct_pack(a := l_shipdate, b := l_linenumber, c := l_partkey, d := l_suppkey)) AS padded_code,
    CAST(count(*) AS BIGINT) AS n_attempts
  FROM lineitem GROUP BY 1)"""


def ctes(*parts: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n"


class Tables:
    """Lazy access to the driver tables and the domain tables derived from them."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        table = self.spark.read.parquet(f"{self.path}/{name}.parquet")
        return spread(table, _TEXT_KEYS[name]) if name in _TEXT_KEYS else table

    @cached_property
    def legal_text(self) -> DataFrame:
        return (
            self.documents.select(
                "doc_id",
                F.expr("if(doc_id % 2 = 0, 'loi', 'decret')").alias("type"),
                (F.lit(1990) + F.col("doc_id") % 30).cast("int").alias("year"),
                F.col("doc_id").alias("number"),
                F.expr(LEGAL_TEXT_SPARK).alias("text"),
            )
            .withColumn("document_id", F.format_string("%s-%d-%d", "type", "year", "number"))
        )

    @cached_property
    def dictionary(self) -> DataFrame:
        from lexmill.operators.words import dictionary_of

        return dictionary_of(self.benchmark)

    @cached_property
    def registry(self) -> DataFrame:
        from lexmill.functions import ids

        status = F.create_map(
            *[F.lit(x) for x in ("F", "FETCHED", "O", "EXTRACTED", "P", "DOWNLOADED")]
        )[F.col("o_orderstatus")]
        base = self.orders.select(
            F.expr("if(o_orderkey % 2 = 0, 'loi', 'decret')").alias("type"),
            F.year("o_orderdate").alias("year"),
            F.col("o_orderkey").alias("number"),
            status.alias("status"),
            "o_orderkey",
            "o_totalprice",
            "o_orderdate",
        )
        key = (F.col("type"), F.col("year"), F.col("number"))
        return base.withColumns(
            {"document_id": ids.document_id(*key), "url": ids.document_url(BASE_URL, *key)}
        )

    @cached_property
    def inventory(self) -> DataFrame:
        """(o_orderkey, kind, length)."""
        kind = F.when(F.col("l_returnflag") == "R", "pdf").when(F.col("l_returnflag") == "A", "ocr").otherwise("json")
        return self.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey"), kind.alias("kind")).agg(
            F.sum(F.col("l_quantity").cast("long")).alias("length")
        )

    @cached_property
    def registry_inventory(self) -> DataFrame:
        """(document_id, kind, length)."""
        return self.inventory.join(self.registry.select("o_orderkey", "document_id"), "o_orderkey").select(
            "document_id", "kind", "length"
        )

    @cached_property
    def recorded(self) -> DataFrame:
        return (
            self.lineitem.where("l_linestatus = 'F'")
            .select(F.col("l_orderkey").alias("o_orderkey"))
            .distinct()
        )

    @cached_property
    def presence(self) -> DataFrame:
        """Registry with presence flags; one pass over the lines, joined on the order key."""
        kinds = {"has_pdf": "R", "has_ocr": "A", "has_json": "N"}
        flags = self.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
            *[F.bool_or(F.col("l_returnflag") == flag).alias(name) for name, flag in kinds.items()],
            F.bool_or(F.col("l_linestatus") == "F").alias("is_recorded"),
        )
        names = [*kinds, "is_recorded"]
        joined = self.registry.join(flags, "o_orderkey", "left")
        return joined.withColumns({n: F.coalesce(F.col(n), F.lit(False)) for n in names})

    @cached_property
    def probes(self) -> DataFrame:
        """(o_orderkey, code, padded_code, n_attempts); aggregates combine before the shuffle."""
        order = F.struct("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey")
        code = F.when(F.col("l_returnflag") == "R", 404).when(F.col("l_returnflag") == "A", 429).otherwise(200)
        padded = F.when(F.col("l_linestatus") == "F", 200).otherwise(404)
        return self.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
            F.max_by(code, order).alias("code"),
            F.min_by(padded, order).alias("padded_code"),
            F.count(F.lit(1)).alias("n_attempts"),
        )

"""Round trips: the driver tables through the sinks and back through the sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill.catalog import query
from lexmill.catalog.views import Tables, ctes
from lexmill.catalog.word_queries import _CHAT, _COUNTS, _WORDS
from lexmill.functions import ids
from lexmill.operators import upsert, words
from lexmill.plans import batches
from lexmill.session import scratch_path
from lexmill.sources import files, lookups
from lexmill.sources.tables import StateTables

_TYPE = "CASE WHEN doc_id % 2 = 0 THEN 'loi' ELSE 'decret' END"


@query(
    "exported_documents",
    f"""SELECT {_TYPE} AS type, '{{"number":' || doc_id || ',"lang":"' || lang || '"}}' AS value FROM documents
WHERE doc_id % 3 <> 0 AND lang IS NOT NULL""",
)
def exported_documents(spark, path):
    """JSON lines by type; only extracted documents that are not blank are exported."""
    extractions = Tables(spark, path).documents.select(
        F.expr(_TYPE).alias("type"),
        F.when(F.col("doc_id") % 3 != 0, "EXTRACTED").otherwise("FAILED").alias("status"),
        F.when(F.col("lang").isNull(), " ").otherwise(F.to_json(F.struct(F.col("doc_id").alias("number"), "lang"))).alias("json"),
    )
    out = scratch_path(spark, "export")
    files.write_documents(extractions, out)
    return spark.read.schema("value string, type string").text(out).select("type", "value")


@query(
    "stored_artifacts",
    "SELECT page_id, sha256(html) AS sha256, octet_length(encode(html)) AS length FROM pages",
)
def stored_artifacts(spark, path):
    out = scratch_path(spark, "artifacts")
    content = Tables(spark, path).pages.select("page_id", F.encode("html", "UTF-8").alias("content"))
    files.write_artifacts(content, out)
    return spark.read.parquet(out).select("page_id", F.sha2("content", 256).alias("sha256"), F.octet_length("content").cast("long").alias("length"))


@query("appended_words", ctes(_WORDS, _CHAT) + "SELECT word FROM known UNION SELECT word FROM words")
def appended_words(spark, path):
    """Two runs append to one list; the second adds only what the first did not have."""
    t, out = Tables(spark, path), scratch_path(spark, "words")
    nothing = lookups.words(spark, None)
    files.append_words(words.dictionary_of(t.conversations), nothing, out)
    files.append_words(words.word_rows(t.documents, "doc_id"), spark.read.parquet(out), out)
    return spark.read.parquet(out)


@query(
    "exported_word_counts",
    ctes(_WORDS, _CHAT) + _COUNTS + "SELECT word, CAST(n AS VARCHAR) AS count FROM counts",
)
def exported_word_counts(spark, path):
    t, out = Tables(spark, path), scratch_path(spark, "word-counts")
    files.write_word_counts(words.corpus_word_counts(t.documents, words.dictionary_of(t.conversations)), out)
    return spark.read.option("escape", '"').csv(out, header=True, schema="word string, count string")


@query(
    "word_list_lookup",
    r"""SELECT DISTINCT lower(trim(l)) AS word FROM (SELECT unnest(string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10))) AS l FROM conversations) WHERE trim(l) <> ''""",
)
def word_list_lookup(spark, path):
    """Lines of a text file, trimmed, lower-cased and distinct."""
    out = scratch_path(spark, "word-list")
    Tables(spark, path).conversations.select("text").where("text is not null").write.text(out)
    return lookups.words(spark, out)


@query(
    "stored_tables",
    f"""SELECT {_TYPE} || '-' || (1990 + doc_id % 30) || '-' || doc_id AS document_id,
  CAST(CASE WHEN doc_id % 30 = 5 THEN 0.9 ELSE 0.1 END AS DOUBLE) AS confidence FROM documents WHERE doc_id % 30 <> 7 OR doc_id % 2 = 0""",
)
def stored_tables(spark, path):
    """A stored table after a batch that replaces some partitions and a deletion that empties one."""
    store = StateTables(spark, scratch_path(spark, "store"))
    named = F.concat_ws("-", F.expr(_TYPE), (F.lit(1990) + F.col("doc_id") % 30).cast("string"), F.col("doc_id").cast("string"))
    docs = Tables(spark, path).documents.select(
        "doc_id", named.alias("document_id"), F.lit("{}").alias("json"), F.lit(0.1).cast("double").alias("confidence"), F.lit("OCR").alias("source")
    )
    store.write("extractions", docs.drop("doc_id"))
    better = docs.where("doc_id % 30 = 5").drop("doc_id").withColumn("confidence", F.lit(0.9).cast("double"))
    store.apply({"extractions": batches.merge(store, "extractions", better, ["document_id"], upsert.better_by_confidence())})
    store.apply(batches.delete(store, docs.where("doc_id % 30 = 7 AND doc_id % 2 = 1"), ("extractions",)))
    return store.read("extractions").select("document_id", "confidence")


# Each supplier is a document of its nation's region: a text, a payload (empty for every seventh) and a
# JSON document (without confidence for every fifth, without both confidence and source for every tenth).
_SUPPLIERS = """supplied AS (SELECT CASE s_suppkey % 2 WHEN 0 THEN 'loi' ELSE 'decret' END AS type,
    concat(CASE s_suppkey % 2 WHEN 0 THEN 'loi' ELSE 'decret' END, '-', 2000 + s_nationkey, '-', s_suppkey) AS document_id,
    concat(s_name, chr(10), 'Région ', r_name, chr(10)) AS text,
    CASE WHEN s_suppkey % 7 = 0 THEN '' ELSE concat('%PDF-', s_name) END AS payload,
    CASE WHEN s_suppkey % 10 = 0 THEN '{"_metadata": {}, "articles": []}'
         WHEN s_suppkey % 5 = 0 THEN '{"_metadata": {"source": "OCR"}, "articles": []}'
         ELSE concat('{"_metadata": {"confidence": 0.', s_suppkey % 9 + 1, ', "source": "IA"}, "articles": []}') END AS json
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def _artifact_root(spark, path):
    """Every supplier's artifacts as files of the layout."""
    t, root = Tables(spark, path), scratch_path(spark, "layout")
    key = F.col("s_suppkey")
    type_ = F.when(key % 2 == 0, "loi").otherwise("decret")
    graded = F.concat(F.lit('{"_metadata": {"confidence": 0.'), (key % 9 + 1).cast("string"), F.lit(', "source": "IA"}, "articles": []}'))
    found = t.supplier.join(F.broadcast(t.nation), F.col("s_nationkey") == F.col("n_nationkey"))  # one row a nation
    found = found.join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey")).select(
        ids.document_id(type_, F.col("s_nationkey") + 2000, key).alias("document_id"),
        type_.alias("type"),
        F.concat("s_name", F.lit("\nRégion "), "r_name", F.lit("\n")).alias("ocr"),
        F.when(key % 7 != 0, F.concat(F.lit("%PDF-"), "s_name")).alias("pdf"),
        F.when(key % 10 == 0, '{"_metadata": {}, "articles": []}')
        .when(key % 5 == 0, '{"_metadata": {"source": "OCR"}, "articles": []}').otherwise(graded).alias("json"),
    )
    for kind in ("ocr", "pdf", "json"):
        files.write_files(found.withColumn("content", F.col(kind)), root, kind)
    return root


@query("artifact_texts", ctes(_SUPPLIERS) + "SELECT document_id, type, text FROM supplied")
def artifact_texts(spark, path):
    return files.read_texts(spark, _artifact_root(spark, path))


@query(
    "artifact_json",
    ctes(_SUPPLIERS) + """SELECT document_id, type, true AS usable, json,
  CAST(json->'_metadata'->>'confidence' AS DOUBLE) AS confidence, json->'_metadata'->>'source' AS source
FROM supplied WHERE json NOT LIKE '{"_metadata": {}%'
UNION ALL SELECT document_id, type, false, json, NULL, NULL FROM supplied WHERE json LIKE '{"_metadata": {}%'""",
)
def artifact_json(spark, path):
    """Usable documents, and those in the quarantine."""
    root = _artifact_root(spark, path)
    good, bad = files.read_json(spark, root), files.unreadable_json(spark, root)
    meta = F.col("doc._metadata")
    good = good.select("document_id", "type", F.lit(True).alias("usable"), "json", meta["confidence"].cast("double").alias("confidence"), meta["source"].alias("source"))
    return good.unionByName(bad.withColumn("usable", F.lit(False)), allowMissingColumns=True)


@query(
    "artifact_inventory",
    ctes(_SUPPLIERS) + """SELECT document_id, kind, CAST(octet_length(encode(content)) AS BIGINT) AS length FROM (
  SELECT document_id, 'ocr' AS kind, text AS content FROM supplied
  UNION ALL SELECT document_id, 'pdf', payload FROM supplied UNION ALL SELECT document_id, 'json', json FROM supplied)""",
)
def artifact_inventory(spark, path):
    """Files of zero bytes are among them."""
    return files.read_inventory(spark, _artifact_root(spark, path))


@query(
    "artifact_payloads",
    ctes(_SUPPLIERS) + "SELECT document_id, type, sha256(payload) AS sha256, CAST(octet_length(encode(payload)) AS BIGINT) AS length FROM supplied WHERE payload <> ''",
)
def artifact_payloads(spark, path):
    """Raw bytes of the payloads that have any."""
    found = files.read_payloads(spark, _artifact_root(spark, path))
    return found.select("document_id", "type", F.sha2("content", 256).alias("sha256"), F.octet_length("content").cast("long").alias("length"))

"""Queries over word occurrences."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill.catalog import query
from lexmill.catalog.views import DICTIONARY, WORD_SEPARATOR, Tables, ctes
from lexmill.operators import search, words
from lexmill.session import scratch_path

_WORDS = f"""words AS (SELECT * FROM (
  SELECT doc_id, unnest(regexp_split_to_array(lower(text), '{WORD_SEPARATOR}')) AS word FROM documents) WHERE length(word) >= 3)"""
_CHAT = f"""known AS (SELECT DISTINCT word FROM (
  SELECT unnest(regexp_split_to_array(lower(text), '{WORD_SEPARATOR}')) AS word FROM conversations) WHERE length(word) >= 3)"""


@query(
    "unknown_rate",
    ctes(_WORDS, DICTIONARY)
    + """, s AS (SELECT doc_id, count(*) AS n_tokens, count(*) FILTER (d.word IS NULL) AS n_unknown,
  count(DISTINCT CASE WHEN d.word IS NULL THEN w.word END) AS n_unknown_words FROM words w LEFT JOIN dictionary d USING (word) GROUP BY 1)
SELECT doc_id, coalesce(n_tokens, 0) AS n_tokens, coalesce(n_unknown, 0) AS n_unknown, CAST(coalesce(n_unknown_words, 0) AS INTEGER) AS n_unknown_words,
  round(CAST(CASE WHEN n_tokens > 0 THEN n_unknown / n_tokens ELSE 0.0 END AS DOUBLE), 6) AS unknown_rate
FROM documents LEFT JOIN s USING (doc_id)""",
)
def unknown_rate(spark, path):
    t = Tables(spark, path)
    stats = words.word_quality(t.documents, t.dictionary, "doc_id", with_words=False)
    return stats.select(
        "doc_id", "n_tokens", "n_unknown", "n_unknown_words",
        F.round("unknown_rate", 6).alias("unknown_rate"),
    )


@query(
    "unknown_words",
    ctes(_WORDS, DICTIONARY) + "SELECT DISTINCT doc_id, word FROM words WHERE word NOT IN (SELECT word FROM dictionary)",
)
def unknown_words(spark, path):
    t = Tables(spark, path)
    return words.unknown_words(t.documents, t.dictionary, "doc_id")


@query(
    "new_words",
    ctes(_WORDS, DICTIONARY, _CHAT)
    + """SELECT DISTINCT word FROM words WHERE word NOT IN (SELECT word FROM dictionary) AND word NOT IN (SELECT word FROM known)""",
)
def new_words(spark, path):
    t = Tables(spark, path)
    found = words.unknown_words(t.documents, t.dictionary, "doc_id")
    return words.new_words(found, words.dictionary_of(t.conversations))


@query(
    "known_words_after_run",
    ctes(_WORDS, DICTIONARY, _CHAT)
    + """SELECT word FROM known UNION SELECT word FROM words WHERE word NOT IN (SELECT word FROM dictionary)""",
)
def known_words_after_run(spark, path):
    t = Tables(spark, path)
    found = words.unknown_words(t.documents, t.dictionary, "doc_id")
    return words.grow_known(found, words.dictionary_of(t.conversations))


_COUNTS = """, counts AS (SELECT k.word, count(w.word) AS n FROM known k LEFT JOIN words w USING (word) GROUP BY 1)
"""


@query("word_counts", ctes(_WORDS, _CHAT) + _COUNTS + "SELECT word, n FROM counts")
def word_counts(spark, path):
    t = Tables(spark, path)
    return words.corpus_word_counts(t.documents, words.dictionary_of(t.conversations))


@query(
    "word_stats_top20",
    ctes(_WORDS, _CHAT) + _COUNTS + "SELECT word, n FROM counts ORDER BY n DESC, word LIMIT 20",
)
def word_stats_top20(spark, path):
    t = Tables(spark, path)
    return words.top_words(words.corpus_word_counts(t.documents, words.dictionary_of(t.conversations)), 20)


@query(
    "doc_top_words",
    ctes(_WORDS)
    + """SELECT doc_id, word, n, CAST(rank AS INTEGER) AS rank FROM (
  SELECT doc_id, word, count(*) AS n, row_number() OVER (PARTITION BY doc_id ORDER BY count(*) DESC, word) AS rank
  FROM words GROUP BY 1, 2) WHERE rank <= 10""",
)
def doc_top_words(spark, path):
    return words.document_top_words(Tables(spark, path).documents, "doc_id", 10)


@query(
    "document_dictionary_score",
    ctes(_WORDS, DICTIONARY)
    + r""", b AS (SELECT * FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS word FROM documents) WHERE length(word) >= 3),
s AS (SELECT doc_id, count(*) FILTER (d.word IS NULL) / count(*) AS r FROM b LEFT JOIN dictionary d USING (word) GROUP BY 1)
SELECT doc_id, round(CAST(greatest(0.0, 1.0 - coalesce(r, 0.0)) AS DOUBLE), 6) AS dictionary_score FROM documents LEFT JOIN s USING (doc_id)""",
)
def document_dictionary_score(spark, path):
    t = Tables(spark, path)
    stats = words.word_quality(t.documents, t.dictionary, "doc_id", variant="qa", with_words=False)
    return stats.select(
        "doc_id", F.round(F.greatest(F.lit(0.0), 1 - F.col("unknown_rate")), 6).alias("dictionary_score")
    )


@query(
    "indexed_search",
    ctes(_WORDS)
    + """, c AS (SELECT doc_id, word, count(*) AS n FROM words GROUP BY 1, 2),
w AS (SELECT word, CAST(floor(1000 * ln(1 + (SELECT count(*) FROM documents)::DOUBLE / count(*)::DOUBLE)) AS BIGINT) AS weight FROM c GROUP BY 1)
SELECT doc_id, CAST(sum(weight * ((1000 * n) // (n + 1))) AS BIGINT) AS score FROM c JOIN w USING (word)
WHERE word IN ('the', 'nation', 'shall', 'heon', 'erhe', 'und') GROUP BY 1 ORDER BY score DESC, doc_id LIMIT 25""",
)
def indexed_search(spark, path):
    """The best documents for a question, from an index of all documents."""
    root = scratch_path(spark, "index")
    search.build_index(Tables(spark, path).documents, "doc_id", root)
    found = search.search(spark, root, "The nation shall heon und ERHE of it", k=25)
    return found.select(F.col("id").alias("doc_id"), "score")

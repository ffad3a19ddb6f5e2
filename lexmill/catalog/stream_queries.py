"""Streaming queries, drained over the driver tables; their batch SQL must give the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill.catalog import query
from lexmill.catalog.chunk_queries import json_parts_sql
from lexmill.catalog.registry_queries import _ADAPTIVE, _THROTTLE, _text_window
from lexmill.catalog.views import ARTICLES, LEGAL_TEXT, LEGAL_TEXT_SPARK, Tables, ctes
from lexmill.catalog.word_queries import _CHAT, _WORDS
from lexmill.operators.words import dictionary_of
from lexmill.session import scratch_path
from lexmill.streaming import cycle, novelty, throttle
from lexmill.streaming.logs import BatchLog


def stream_of(t: Tables, name: str):
    """The driver table as a file stream; the pattern fits a single file as well as a folder."""
    static = getattr(t, name)
    return t.spark.readStream.schema(static.schema).parquet(f"{t.path}/{name}.parque[t]")


@query(
    "stream_throttle",
    ctes(_THROTTLE.format("5 minutes"))
    + "SELECT window_start, n_requests, n_throttled, round(n_throttled / n_requests, 6) AS rate FROM w",
)
def stream_throttle(spark, path):
    t = Tables(spark, path)
    log = BatchLog(spark, scratch_path(spark, "throttle"), throttle.WINDOW_SCHEMA)
    current = throttle.run_windows(
        stream_of(t, "events"), "ts", F.col("event_type") == "error", log, scratch_path(spark, "throttle-checkpoint")
    )
    return _text_window(current.withColumn("rate", F.round("rate", 6)))


@query(
    "stream_pacing",
    ctes(_ADAPTIVE, recursive=True)
    + "SELECT user_id, event_id, round(rate, 6) AS rate, CAST(delay_ms AS INTEGER) AS delay_ms FROM walk",
)
def stream_pacing(spark, path):
    t = Tables(spark, path)
    events = stream_of(t, "events").select("user_id", "event_id", "ts", "event_type", "value")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in events.schema.fields)
    out = BatchLog(
        spark, scratch_path(spark, "pauses"), f"{schema}, n_requests long, n_throttled long, rate double, delay_ms int"
    )
    states = BatchLog(
        spark, scratch_path(spark, "paces"), "user_id long, span long, requests long, throttled long, delay_ms int"
    )
    hit = (F.col("event_type") == "error") & (F.col("value") > 20)
    paced = throttle.run_pacing(
        events, ["user_id"], "ts", [F.col("event_id")], hit, states, out, scratch_path(spark, "pace-checkpoint"), 864_000
    )
    return paced.select("user_id", "event_id", F.round("rate", 6).alias("rate"), "delay_ms")


@query(
    "stream_novelty",
    ctes(_WORDS, _CHAT) + "SELECT DISTINCT word FROM words WHERE word NOT IN (SELECT word FROM known)",
)
def stream_novelty(spark, path):
    t = Tables(spark, path)
    log = BatchLog(spark, scratch_path(spark, "new-words"), novelty.WORD_SCHEMA)
    checkpoint = scratch_path(spark, "new-words-checkpoint")
    known = dictionary_of(t.conversations)
    novelty.new_words(stream_of(t, "documents"), known, log, checkpoint).awaitTermination()
    return log.read().select("word")


@query(
    "stream_micro_cycle",
    ctes(LEGAL_TEXT, ARTICLES, json_parts_sql(), recursive=True)
    + """SELECT t.document_id, CAST(coalesce(p.n_articles, 0) AS INTEGER) AS n_articles, json_exists(to_json(p), '$.title') AND p.title IS NOT NULL AS has_title
FROM legal_text t LEFT JOIN parts p USING (document_id)""",
)
def stream_micro_cycle(spark, path):
    t = Tables(spark, path)
    texts = stream_of(t, "documents").select(
        F.expr("if(doc_id % 2 = 0, 'loi', 'decret')").alias("type"),
        (F.lit(1990) + F.col("doc_id") % 30).cast("int").alias("year"),
        F.col("doc_id").alias("number"),
        F.expr(LEGAL_TEXT_SPARK).alias("text"),
    ).withColumn("document_id", F.format_string("%s-%d-%d", "type", "year", "number"))
    log = BatchLog(spark, scratch_path(spark, "extractions"), cycle.EXTRACTION_SCHEMA)
    started = cycle.extract_stream(
        texts, t.dictionary, log, scratch_path(spark, "extractions-checkpoint"), "2025-01-01T00:00:00"
    )
    started.awaitTermination()
    return cycle.best_extractions(log).select(
        "document_id", "n_articles", F.col("json").contains('"title":').alias("has_title")
    )

"""Emitting words the first time they appear."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions import text
from lexmill.streaming.logs import BatchLog

WORD_SCHEMA = "word string"


def _distinct(rows: DataFrame) -> DataFrame:
    return rows.groupBy("word").agg(F.min("batch").alias("batch"))


def new_words(texts: DataFrame, known: DataFrame, log: BatchLog, checkpoint: str, variant: str = "extractor", **trigger):
    """Write, batch by batch, the words that are neither in `known` nor in an earlier batch.

    The words of a batch are made distinct by an aggregate that combines before its shuffle, so the
    commonest words cost one row per task; a streaming duplicate filter would ship every
    occurrence of such a word to one task. The memory is the log itself,
    merged into few files every some batches.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        found = batch.select(F.explode(text.tokens(F.col("text"), variant)).alias("word")).distinct()
        fresh = found.join(known.select("word"), "word", "left_anti").join(
            log.before(batch_id, _distinct).select("word"), "word", "left_anti"
        )
        log.write(fresh, batch_id)

    return (
        texts.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )

"""From raw documents to packed sequences: five stages, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import content_sort, langid, mixing, packing, similar
from lexmill.session import materialize


# Rows that go to Python at once. Texts are long, and what a batch takes is held twice: outside the
# heap of the executor and in the worker.
ROWS_TO_PYTHON = 1000


def _small_batches(spark: SparkSession) -> None:
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ROWS_TO_PYTHON:
        spark.conf.set(key, str(ROWS_TO_PYTHON))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the model can name; those without a letter go."""
    _small_batches(spark)
    model = langid.fit(docs, learn=~langid.held_out(F.col("doc_id")))
    found = model.predict(docs, prefix="__")
    return found.where(F.col("__lang_pred") != langid.UNDETERMINED).select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space, the longest stays."""
    return content_sort.deduplicate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with 0.8 or more of their five-word runs in common, the one with the smallest id stays.

    SimHash links are checked on the whole sets; a join of the sets adds those the fingerprints miss.
    """
    _small_batches(spark)
    return similar.deduplicate(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks for."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences."""
    _small_batches(spark)
    return packing.pack(docs)


STAGES = [
    ("language id", identify_language),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("mix sources", mix),
    ("pack", pack),
]

# Language identification and tokens have no SQL counterpart; the tests hold the stages against
# plain Python versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over the whole `documents` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, name.replace(" ", "-"))
    return docs

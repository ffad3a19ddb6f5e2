"""Full-text search over an inverted index.

The index has one row per word and block of documents, with the documents of the block that have the
word. A block is some thousand documents that one task reads, so a common word is many rows of bounded
size. Rows are stored by a hash of their word; a search opens only the folders of the words it asks
for, and reads postings only of the blocks that can still hold one of the best documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import text
from lexmill.operators.words import counted_words
from lexmill.session import materialize

DOCS_PER_BLOCK = 4096
WORDS_PER_BLOCK = 1 << 20  # a block of long texts has fewer of them
BUCKETS = 256
FIRST_BLOCKS = 8


def block_postings(counted: DataFrame, docs_per_block: int = DOCS_PER_BLOCK) -> DataFrame:
    """(word, block, postings) of rows (id, counts): each task folds the texts it reads, block by block.

    No row moves for it. A block is named by its task and its number there.
    """
    id_type = counted.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, docs, words = TaskContext.get().partitionId() << 32, [], 0, 0
        for batch in batches:
            ends = np.cumsum(batch.column(1).value_lengths().fill_null(0).to_numpy())
            at = 0
            while at < batch.num_rows:
                before = int(ends[at - 1]) if at else 0
                fit = int(np.searchsorted(ends, before + WORDS_PER_BLOCK - words, side="right")) - at
                take = min(max(fit, 0 if held else 1), docs_per_block - docs, batch.num_rows - at)
                if take:
                    held.append(batch.slice(at, take))
                    at, docs, words = at + take, docs + take, words + int(ends[at + take - 1]) - before
                if not take or docs >= docs_per_block or words >= WORDS_PER_BLOCK:
                    yield _folded(held, block)
                    block, held, docs, words = block + 1, [], 0, 0
        if held:
            yield _folded(held, block)

    return counted.select("id", "counts").mapInArrow(run, f"word string, block long, postings array<struct<n: bigint, id: {id_type}>>")


def _folded(held: list[pa.RecordBatch], block: int) -> pa.RecordBatch:
    """The texts of a block turned around: each word with its texts, most occurrences first."""
    texts = pa.Table.from_batches(held).combine_chunks()
    ids, counts = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in texts.columns)
    entries = counts.flatten()
    coded = entries.field("word").dictionary_encode()
    codes, n = coded.indices.to_numpy(), entries.field("n").to_numpy()
    order = np.lexsort((-n, codes))
    starts = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=len(coded.dictionary)))])
    found = pa.StructArray.from_arrays([pa.array(n[order]), ids.take(counts.value_parent_indices().take(pa.array(order)))], ["n", "id"])
    postings = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), found)
    return pa.RecordBatch.from_arrays(
        [coded.dictionary, pa.array(np.full(len(postings), block)), postings], ["word", "block", "postings"]
    )


def build_index(
    texts: DataFrame, id_col: str, root: str, text_col: str = "text", variant: str = "extractor", docs_per_block: int = DOCS_PER_BLOCK
) -> None:
    """Write the index of `texts` below `root`; a text is one row, and a null id is not indexed.

    Words are counted and folded to postings where the texts are. The one shuffle brings the rows of
    a bucket together; they are stored before it, so that a lost task cannot deal its blocks anew.
    """
    rows = texts.where(F.col(id_col).isNotNull())
    n_docs = rows.count()
    each = counted_words(rows, id_col, text_col, variant).select(F.col(id_col).alias("id"), "counts")
    postings = materialize(block_postings(each, docs_per_block), "blocks")
    dealt = postings.withColumn("bucket", F.pmod(F.xxhash64("word"), F.lit(BUCKETS)).cast("int"))
    # Files by bucket, large buckets in several of them, rows of a word next to each other.
    stored = dealt.hint("rebalance", "bucket").sortWithinPartitions("bucket", "word", "block")
    best, df = F.array_max(F.col("postings.n")), F.size("postings").cast("long")
    stored = stored.select("word", "block", "postings", best.alias("best"), df.alias("df"), "bucket")
    stored.write.partitionBy("bucket").mode("overwrite").parquet(f"{root}/postings")
    id_type = rows.schema[id_col].dataType.simpleString()
    rows.sparkSession.createDataFrame([(n_docs, None)], f"n_docs long, id {id_type}").coalesce(1).write.mode("overwrite").parquet(f"{root}/facts")


def _index(spark: SparkSession, root: str) -> DataFrame:
    id_type = spark.read.parquet(f"{root}/facts").schema["id"].dataType.simpleString()
    schema = f"word string, block long, postings array<struct<n: bigint, id: {id_type}>>, best long, df long, bucket int"
    return spark.read.schema(schema).parquet(f"{root}/postings")


def asked_words(spark: SparkSession, query: str, variant: str = "extractor") -> list[str]:
    """Distinct words of a question, by the same rule as those of the texts."""
    found = spark.range(1).select(F.array_distinct(text.tokens(F.lit(query), variant)).alias("w")).first()["w"]
    return sorted(found)


def postings_of(spark: SparkSession, root: str, words: list[str]) -> DataFrame:
    """Index rows of the words; the bucket prunes folders, the word row groups."""
    bucket = F.pmod(F.xxhash64("w"), F.lit(BUCKETS)).cast("int")
    rows = spark.createDataFrame([(w,) for w in words], "w string").select(bucket.alias("b")).collect()  # a few words
    return _index(spark, root).where(F.col("bucket").isin(sorted({r["b"] for r in rows})) & F.col("word").isin(words))


def word_weight(n_docs: int, df: int) -> int:
    """Rare words weigh more."""
    return math.floor(1000 * math.log(1 + n_docs / df))


def _worth(weights: dict[str, int], n: Column) -> Column:
    """What `n` occurrences of the row's word add to a score; grows with n, ever more slowly."""
    weight = F.element_at(F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]), F.col("word")).cast("long")
    return weight * F.floor(F.lit(1000) * n / (n + 1))


def search(spark: SparkSession, root: str, query: str, k: int = 10, variant: str = "extractor", first_blocks: int = FIRST_BLOCKS) -> DataFrame:
    """The k best documents (id, score) for the words of `query`; equal scores by id.

    The best count of each word bounds what a block can score. The blocks with the highest bounds are
    scored first; of the others only those are read whose bound reaches the k-th score so far.
    """
    nothing = _index(spark, root).select(F.explode("postings.id").alias("id"), F.lit(0).cast("long").alias("score")).limit(0)
    words = asked_words(spark, query, variant)
    if not words:
        return nothing
    asked = postings_of(spark, root, words)
    n_docs = spark.read.parquet(f"{root}/facts").first()["n_docs"]
    df = {r["word"]: r["df"] for r in asked.groupBy("word").agg(F.sum("df").alias("df")).collect()}
    if not df:
        return nothing
    weights = {w: word_weight(n_docs, n) for w, n in df.items()}
    bounds = asked.groupBy("block").agg(F.sum(_worth(weights, F.col("best"))).alias("bound"))

    def scores(blocks: DataFrame) -> DataFrame:
        rows = asked.join(blocks, "block", "left_semi").select("word", F.inline("postings"))
        return rows.groupBy("id").agg(F.sum(_worth(weights, F.col("n"))).alias("score"))

    order = [F.col("score").desc(), F.col("id")]
    first = [r["block"] for r in bounds.orderBy(F.col("bound").desc(), "block").limit(first_blocks).collect()]
    top = scores(bounds.where(F.col("block").isin(first))).orderBy(*order).limit(k).collect()
    least = top[-1]["score"] if len(top) == k else 0
    more = scores(bounds.where((F.col("bound") >= least) & ~F.col("block").isin(first)))
    known = spark.createDataFrame([(r["id"], r["score"]) for r in top], nothing.schema)
    return more.unionByName(known).orderBy(*order).limit(k)

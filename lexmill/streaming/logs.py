"""Idempotent outputs of micro-batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.session import read_or_empty

Merge = Callable[[DataFrame], DataFrame]


class BatchLog:
    """One folder per micro-batch; a repeated batch replaces its own folder.

    Results are merged when read, so a batch only writes its own rows, never the whole table. What a
    batch has to know of all earlier ones is kept small by bases: at every `every`-th batch the rows
    before it are merged into one folder, and later batches read it and the batches since.
    """

    def __init__(self, spark: SparkSession, root: str, schema: str, every: int = 10):
        self.spark, self.root, self.schema, self.every = spark, root.rstrip("/"), schema, every

    def write(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.root}/batch={batch_id}")

    def read(self) -> DataFrame:
        """Rows of all batches, with the number of theirs; none before the first batch."""
        return read_or_empty(self.spark, f"{self.schema}, batch long", self.root)

    def batch(self, batch_id: int) -> DataFrame:
        """Rows of one batch, from its own folder."""
        return self._some([batch_id])

    def _some(self, batches: Sequence[int]) -> DataFrame:
        schema = f"{self.schema}, batch long"
        rows = self.spark.createDataFrame([], schema)
        for number in batches:  # at most `every`
            one = read_or_empty(self.spark, self.schema, f"{self.root}/batch={number}")
            rows = rows.unionByName(one.withColumn("batch", F.lit(number).cast("long")))
        return rows

    def before(self, batch_id: int, merge: Merge | None = None) -> DataFrame:
        """Rows of earlier batches, so that a repeated batch does not see its own first attempt.

        `merge` turns rows (with `batch`) into fewer rows of the same columns that serve as well as
        the old ones; with it, a call reads one base and fewer than `every` batches. The base of a
        batch is built from the base before and the batches since, and the same when built again.
        """
        if merge is None:
            return self.read().where(F.col("batch") < batch_id)
        start = batch_id // self.every * self.every
        if start and batch_id == start:
            merge(self._since(start - self.every, start)).write.mode("overwrite").parquet(self._base(start))
        return self._since(start, batch_id)

    def _base(self, start: int) -> str:
        return f"{self.root}-base/{start}"

    def _since(self, start: int, batch_id: int) -> DataFrame:
        schema = f"{self.schema}, batch long"
        base = read_or_empty(self.spark, schema, self._base(start)) if start else self.spark.createDataFrame([], schema)
        return base.unionByName(self._some(range(start, batch_id)))

    def best(self, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
        """The largest row per key in `order`; repeats combine before the shuffle."""
        rows = self.read()
        rest = F.struct(*[F.col(c) for c in rows.columns if c not in (*keys, "batch")])
        picked = rows.groupBy(*keys).agg(F.max_by(rest, F.struct(*order)).alias("__r"))
        return picked.select(*keys, "__r.*")

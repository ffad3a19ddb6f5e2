"""Plugging user functions into a job: named, batch-wise, optionally dropping rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from lexmill.functions.scoring import window_chunk_estimate
from lexmill.session import materialize


@dataclass(frozen=True)
class Transformation:
    """A function from one pandas batch to another with a declared output.

    `accepts` restricts the rows it is given. A row whose `required` output is null is dropped.
    """

    name: str
    function: Callable[[pd.DataFrame], pd.DataFrame]
    schema: str
    accepts: Callable[[], Column] | None = None
    required: str | None = None

    def apply(self, df: DataFrame) -> DataFrame:
        chosen = df.where(self.accepts()) if self.accepts else df
        function = self.function

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield function(batch)

        out = chosen.mapInPandas(run, self.schema)
        return out.where(F.col(self.required).isNotNull()) if self.required else out

    def apply_or_quarantine(self, df: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
        """(results, failures) where `apply` would end the job at the first row that raises.

        A batch that fails is halved until the failing rows are alone, so the function must give the
        same for a row whatever stands beside it. A failure has the `key` columns of the row, `error`
        and `step`. Both are computed once and stored.
        """
        chosen = df.where(self.accepts()) if self.accepts else df
        function, key = self.function, list(key)
        declared = df.sparkSession.createDataFrame([], self.schema).schema
        kinds = to_arrow_schema(declared)
        keys = {f"__key{i}": k for i, k in enumerate(key)}

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for whole in batches:
                todo = [whole]
                while todo:
                    batch = todo.pop()
                    try:
                        out = function(batch.copy())
                        for field in kinds:  # what Spark could not take counts as an error of the function
                            pa.Array.from_pandas(out[field.name], type=field.type)
                    except Exception as error:
                        if len(batch) > 1:
                            half = len(batch) // 2
                            todo += [batch.iloc[half:], batch.iloc[:half]]
                            continue
                        nothing = {name: [None] * len(batch) for name in kinds.names}
                        row = {a: batch[k].to_numpy() for a, k in keys.items()}
                        yield pd.DataFrame({**nothing, **row, "__error": f"{type(error).__name__}: {error}"})
                    else:
                        yield out[kinds.names].assign(**dict.fromkeys([*keys, "__error"]))

        fields = [StructField(f.name, f.dataType) for f in declared]
        fields += [StructField(a, df.schema[k].dataType) for a, k in keys.items()]
        schema = StructType([*fields, StructField("__error", StringType())])
        both = materialize(chosen.mapInPandas(run, schema), "transformed")
        good = both.where("__error IS NULL").select(*declared.names)
        good = good.where(F.col(self.required).isNotNull()) if self.required else good
        bad = both.where("__error IS NOT NULL").select(*[F.col(a).alias(k) for a, k in keys.items()], F.col("__error").alias("error"), F.lit(self.name).alias("step"))
        return good, bad

    def estimate(self, df: DataFrame, id_col: str, text_col: str, size: int, overlap: int) -> DataFrame:
        """Expected chunk count per row, for planning the calls."""
        return df.select(id_col, window_chunk_estimate(F.length(text_col), size, overlap).alias("n_chunks"))


_REGISTERED: dict[str, Transformation] = {}


def register(transformation: Transformation) -> Transformation:
    _REGISTERED[transformation.name] = transformation
    return transformation


def named(name: str) -> Transformation:
    if name not in _REGISTERED:
        raise KeyError(f"no transformation named {name}; known: {sorted(_REGISTERED)}")
    return _REGISTERED[name]

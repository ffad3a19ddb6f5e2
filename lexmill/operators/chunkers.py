"""Chunkers that a user adds: how to split a text, and how to make a whole of what became of its chunks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult


@dataclass(frozen=True)
class Chunker:
    """`split` gives the chunks of a text in order; `join` takes chunks in that order."""

    name: str
    split: Callable[[str], Iterable[str]]
    join: Callable[[list[str]], str] = "".join


_REGISTERED: dict[str, Chunker] = {}


def register(chunker: Chunker) -> Chunker:
    _REGISTERED[chunker.name] = chunker
    return chunker


def named(name: str) -> Chunker:
    if name not in _REGISTERED:
        raise KeyError(f"no chunker named {name}; known: {sorted(_REGISTERED)}")
    return _REGISTERED[name]


def _splitter(chunker: Chunker):
    @F.udtf
    class Split:
        """Rows (id, text) to (id, chunk_index, total_chunks, chunk); the id keeps its name and type."""

        @staticmethod
        def analyze(rows: AnalyzeArgument) -> AnalyzeResult:
            own = rows.dataType.fields[0]
            numbers = [StructField(c, IntegerType()) for c in ("chunk_index", "total_chunks")]
            return AnalyzeResult(StructType([StructField(own.name, own.dataType), *numbers, StructField("chunk", StringType())]))

        def eval(self, rows: Row) -> Iterator[tuple]:
            key, text = rows[0], rows[1]
            chunks = [None] if text is None else list(chunker.split(text))
            for i, chunk in enumerate(chunks):
                yield key, i, len(chunks), chunk

    return Split


def _joiner(chunker: Chunker):
    @F.udtf
    class Join:
        """Rows (id, chunk_index, chunk) of one document, in order, to (id, n_chunks, text)."""

        @staticmethod
        def analyze(rows: AnalyzeArgument) -> AnalyzeResult:
            own = rows.dataType.fields[0]
            out = [StructField(own.name, own.dataType), StructField("n_chunks", IntegerType()), StructField("text", StringType())]
            return AnalyzeResult(StructType(out))

        def __init__(self):
            self.key, self.chunks = None, []

        def eval(self, rows: Row) -> None:
            self.key = rows[0]
            self.chunks.append(rows[2])

        def terminate(self) -> Iterator[tuple]:
            if self.chunks:
                known = [c for c in self.chunks if c is not None]
                yield self.key, len(self.chunks), chunker.join(known) if known else None

    return Join


def split(texts: DataFrame, id_col: str, chunker: str, text_col: str = "text") -> DataFrame:
    """(id, chunk_index from 0, total_chunks, chunk) by a registered chunker.

    A null text is one null chunk. A table function over the rows: no shuffle.
    """
    return _splitter(named(chunker))(texts.select(id_col, text_col).asTable())


def join(chunks: DataFrame, id_col: str, chunker: str, chunk_col: str = "chunk") -> DataFrame:
    """(id, n_chunks, text): the chunks of each id in order of chunk_index, joined by the chunker.

    One task sees one document after another and holds the chunks of a single one.
    """
    rows = chunks.select(id_col, "chunk_index", F.col(chunk_col).alias("chunk"))
    return _joiner(named(chunker))(rows.asTable().partitionBy(id_col).orderBy("chunk_index"))

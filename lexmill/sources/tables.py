"""State tables as plain Parquet, partitioned by document type and year."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.ids import parse_document_id
from lexmill.schemas import PARTITIONS, TABLES
from lexmill.session import materialize, read_or_empty

Parts = frozenset[tuple[str | None, int | None]]
NULL_PART = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Change:
    """What a step does to a table.

    `rows` are all rows of the partitions in `parts`, or of the whole table without `parts`; with
    `append` they are added.
    """

    rows: DataFrame
    parts: Parts | None = None
    append: bool = False


def parts_of(df: DataFrame, type_col: str = "type", year_col: str = "year") -> Parts:
    """The (type, year) pairs of `df`: at most the number of types times that of years."""
    return frozenset((r[0], r[1]) for r in df.select(type_col, year_col).distinct().collect())


def parts_by_id(df: DataFrame, id_col: str = "document_id") -> Parts:
    """The (type, year) pairs of the documents named in `df`."""
    return parts_of(df.select(parse_document_id(F.col(id_col)).alias("k")).select("k.type", "k.year"))


def in_parts(parts: Parts, type_col: str, year_col: str) -> Column:
    """A condition on partition columns alone, so other partitions are not listed or read."""
    years: dict[str | None, set] = {}
    for kind, year in parts:
        years.setdefault(kind, set()).add(year)
    terms = []
    for kind, some in sorted(years.items(), key=repr):
        known = sorted(y for y in some if y is not None)
        year = F.col(year_col).isin(known) if known else F.lit(False)
        year = year | F.col(year_col).isNull() if None in some else year
        terms.append((F.col(type_col).isNull() if kind is None else F.col(type_col) == kind) & year)
    return reduce(lambda a, b: a | b, terms, F.lit(False))


class StateTables:
    """Tables below one folder, each with partitions by type and year where documents have them.

    A merge reads and replaces only the partitions that its batch touches, so it costs what these
    hold, not what the table holds. New rows are computed and stored aside before anything is
    replaced: a failed computation changes nothing. Partitions are then replaced one by one; after a
    crash in that phase some are new and some old, each of them whole, and the same batch again
    brings them all up to date, since merging is idempotent. One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def partitions(self, name: str) -> tuple[str, ...]:
        """The type and year columns that cut the table, if any."""
        return PARTITIONS.get(name, ())

    def read(self, name: str, parts: Parts | None = None) -> DataFrame:
        """The table, or its rows in `parts` only."""
        columns = self.partitions(name)
        names = [f.name for f in self.spark.createDataFrame([], TABLES[name]).schema]
        extra = [f"{c} {kind}" for c, kind in zip(columns, ("string", "int"), strict=False) if c not in names]
        df = read_or_empty(self.spark, ", ".join([TABLES[name], *extra]), f"{self.root}/{name}")
        if parts is not None and columns:
            df = df.where(in_parts(parts, *columns))
        return df.select(*names)

    def parts(self, name: str, where: Column | str = "true") -> Parts:
        """Partitions with rows for which `where` holds; only the columns it names are read."""
        return parts_of(self.placed(name, self.read(name).where(where)), *self.partitions(name))

    def placed(self, name: str, rows: DataFrame) -> DataFrame:
        """`rows` with the partition columns, which some tables only have in the document's id."""
        missing = [c for c in self.partitions(name) if c not in rows.columns]
        key = parse_document_id(F.col("document_id"))
        return rows.withColumns({c: key[c] for c in missing}) if missing else rows

    def write(self, name: str, rows: DataFrame, parts: Parts | None = None) -> None:
        self.apply({name: Change(rows, parts)})

    def append(self, name: str, rows: DataFrame) -> None:
        self.apply({name: Change(rows, append=True)})

    def apply(self, changes: dict[str, Change | DataFrame]) -> None:
        """Carry out the changes of one step; the registry, which says what is done, comes last."""
        staged = {}
        for name, change in changes.items():
            change = change if isinstance(change, Change) else Change(change)
            names = [f.name for f in self.spark.createDataFrame([], TABLES[name]).schema]
            staged[name] = change, materialize(self.placed(name, change.rows.select(*names)), f"new-{name}")
        for name in sorted(staged, key=lambda n: n == "registry"):
            change, rows = staged[name]
            self._replace(name, rows, change)

    def _replace(self, name: str, rows: DataFrame, change: Change) -> None:
        columns, path = self.partitions(name), f"{self.root}/{name}"
        if columns:
            # Rows of a partition come together, so that it is a few files and not one per task.
            rows = rows.repartition(*columns)
        writer = rows.write.partitionBy(*columns) if columns else rows.write
        if change.append:
            writer.mode("append").parquet(path)
        elif change.parts is None or not columns:
            writer.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
        else:
            new = parts_of(rows, *columns)
            if not new <= change.parts:
                raise ValueError(f"{name}: rows outside the partitions to be replaced: {sorted(new - change.parts, key=repr)}")
            if new:
                writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
            self._clear(name, rows, change.parts - new)

    def _clear(self, name: str, rows: DataFrame, gone: Iterable[tuple]) -> None:
        """Partitions that lost all their rows; an empty file takes the place of theirs."""
        columns = self.partitions(name)
        nothing = rows.drop(*columns).limit(0)
        for part in self.parts(name) & frozenset(gone):
            folder = "/".join(f"{c}={NULL_PART if v is None else v}" for c, v in zip(columns, part, strict=True))
            nothing.write.mode("overwrite").parquet(f"{self.root}/{name}/{folder}")


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, low: int, high: int, parts: int, **options) -> DataFrame:
    """Read a relational table in parallel over ranges of an integer key."""
    return spark.read.jdbc(
        url, table, column=key, lowerBound=low, upperBound=high, numPartitions=parts, properties=options
    )


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", batch: int = 1000, **options) -> None:
    df.write.option("batchsize", batch).jdbc(url, table, mode=mode, properties=options)

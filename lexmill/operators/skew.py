"""Joins and ordered computations that keep working when one key holds a third of all rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.session import materialize, materialize_measured

# Rows of one key that a single task may order. A key above it is cut into ranges.
MAX_ROWS_PER_TASK = 1_000_000
# A lookup is broadcast only when its measured size is below this.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 64


@dataclass(frozen=True)
class Lookup:
    """A lookup that is stored once, with its measured size; see `stored_lookup`."""

    df: DataFrame
    size: int


def stored_lookup(df: DataFrame, label: str = "lookup") -> Lookup:
    """Compute a lookup once, for every later join and size check."""
    return Lookup(*materialize_measured(df, label))


def lookup_join(
    df: DataFrame,
    lookup: DataFrame | Lookup,
    on: Sequence[str],
    how: str = "inner",
    max_bytes: int = MAX_BROADCAST_BYTES,
    salts: int = SALTS,
    hot_rows: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """Join a large side with a lookup whose keys may be very unevenly used.

    The lookup is stored once and measured by the same job. Below `max_bytes` it is broadcast. A
    larger one is joined by key; keys that more than `hot_rows` rows of the large side use, at most
    rows / hot_rows of them, are dealt over `salts` tasks, and only their lookup rows are repeated.
    """
    on = list(on)
    lookup = lookup if isinstance(lookup, Lookup) else stored_lookup(lookup)
    if lookup.size <= max_bytes:
        return df.join(F.broadcast(lookup.df), on, how)
    hot = df.groupBy(*on).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > hot_rows).select(*on)
    hot = materialize(hot.withColumn("__hot", F.lit(True)), "hot-keys")
    spread = F.when(F.col("__hot"), F.pmod(F.monotonically_increasing_id(), F.lit(salts))).otherwise(F.lit(0))
    salted = df.join(F.broadcast(hot), on, "left").withColumn("__salt", spread.cast("long")).drop("__hot")
    copies = F.when(F.col("__hot"), F.lit(salts - 1)).otherwise(F.lit(0))
    repeated = lookup.df.join(F.broadcast(hot), on, "left")
    repeated = repeated.withColumn("__salt", F.explode(F.sequence(F.lit(0), copies).cast("array<bigint>"))).drop("__hot")
    return salted.join(repeated, on + ["__salt"], how).drop("__salt")


def _order_key(order: Sequence[Column]) -> Column:
    return F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])


@dataclass(frozen=True)
class Ordered:
    """Rows prepared for running values.

    `split` says whether large keys were cut into ranges, `stored` whether `df` is a table already.
    """

    df: DataFrame
    keys: tuple[str, ...]
    split: bool
    stored: bool = False


def ordered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    max_rows: int = MAX_ROWS_PER_TASK,
    sized_by: DataFrame | None = None,
) -> Ordered:
    """Prepare `df` for running values per key in ascending `order`.

    `df` is stored once (unless `sized_by` names a cheaper table with the same keys), and the rows
    per key are counted by a narrow aggregate. If no key exceeds `max_rows`, the rows are hashed by
    key and every later window reuses that layout. Otherwise the rows are range-partitioned by key
    and the whole order, with splitters sampled from the rows, so ranges hold about equal numbers
    whatever the values; the number of its range becomes the column `__seg` of a row. Only rows that
    agree in every order column stay together.
    """
    keys = list(keys)
    if sized_by is None:
        df = sized_by = materialize(df, "unordered")
    sizes = sized_by.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    found = sizes.agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
    if (found["most"] or 0) <= max_rows:
        return Ordered(df.repartition(*keys), tuple(keys), False)
    # Half as many rows as allowed are aimed at, since sampled ranges are not exact.
    parts = -(-2 * found["all"] // max_rows)
    placed = {f"__by{i}": c for i, c in enumerate(order)}
    cut = df.withColumns(placed).repartitionByRange(parts, *keys, *placed).withColumn("__seg", F.spark_partition_id().cast("long"))
    return Ordered(materialize(cut.drop(*placed), "ranges"), tuple(keys), True, stored=True)


def running_values(
    rows: Ordered,
    order: Sequence[Column],
    values: dict[str, tuple[str, Column]],
    within: Sequence[str] = (),
) -> Ordered:
    """Add running values in ascending `order`, restarting for each value of the `within` columns.

    `values` maps an output name to (kind, column). The kinds "sum", "max" and "last" (latest value
    that is not null) include the current row; "max_before" stops at the row before, and "previous"
    is the value of the row before. `order` must be total within a key.

    For split keys the windows run per range, one summary row per range is carried forward, and
    the carry is joined back.
    """
    if rows.split and not rows.stored:  # a split table is read twice below
        rows = replace(rows, df=materialize(rows.df, "running"), stored=True)
    df, keys = rows.df, [*rows.keys, *within]
    part_by = [*keys, "__seg"] if rows.split else keys
    upto = Window.partitionBy(*part_by).orderBy(*order)
    frame = upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = upto.rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*keys).orderBy("__seg").rowsBetween(Window.unboundedPreceding, -1)
    position = _order_key(order)
    local, summary, carry = [], [], []
    for name, (kind, col) in values.items():
        part, total = f"__l_{name}", f"__t_{name}"
        if kind == "sum":
            local.append(F.sum(col).over(frame).alias(part))
            summary.append(F.sum(col).alias(total))
            carry.append(F.sum(total).over(before).alias(total))
        elif kind in ("max", "max_before"):
            local.append(F.max(col).over(frame if kind == "max" else earlier).alias(part))
            summary.append(F.max(col).alias(total))
            carry.append(F.max(total).over(before).alias(total))
        elif kind == "last":
            local.append(F.last(col, ignorenulls=True).over(frame).alias(part))
            summary.append(F.max_by(col, F.when(col.isNotNull(), position)).alias(total))
            carry.append(F.last(total, ignorenulls=True).over(before).alias(total))
        elif kind == "previous":
            boxed = F.struct(col.alias("v"))
            local.append(F.lag(boxed).over(upto).alias(part))
            summary.append(F.max_by(boxed, position).alias(total))
            carry.append(F.last(total, ignorenulls=True).over(before).alias(total))
        else:
            raise ValueError(f"unknown running kind: {kind}")

    result = df.select("*", *local)
    if rows.split:
        # Summary rows carry something only for keys that lie in several ranges; every range has one
        # such key at each end at most, so two rows per range bound the broadcast.
        totals = df.groupBy(*part_by).agg(*summary).select(
            *part_by, *carry, F.count(F.lit(1)).over(Window.partitionBy(*keys)).alias("__ranges")
        )
        totals = totals.where(F.col("__ranges") > 1).drop("__ranges")
        result = result.join(F.broadcast(totals), part_by, "left")
    out = []
    for name, (kind, _) in values.items():
        part = F.col(f"__l_{name}")
        if not rows.split:
            out.append((part["v"] if kind == "previous" else part).alias(name))
            continue
        total = F.col(f"__t_{name}")
        if kind == "sum":
            both = F.when(total.isNull(), part).otherwise(F.coalesce(part, F.lit(0)) + total)
        elif kind in ("max", "max_before"):
            both = F.greatest(part, total)
        else:
            both = F.coalesce(part, total)
        out.append((both["v"] if kind == "previous" else both).alias(name))
    return replace(rows, df=result.select(*df.columns, *out), stored=False)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    values: dict[str, tuple[str, Column]],
    max_rows: int = MAX_ROWS_PER_TASK,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """One round of running values; see `ordered` and `running_values`."""
    rows = running_values(ordered(df, keys, order, max_rows, sized_by), order, values)
    return rows.df.drop("__seg")


def micros(ts: Column) -> Column:
    """Microseconds since the epoch of a timestamp without zone; strictly monotone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, ts.cast("timestamp_ntz"))

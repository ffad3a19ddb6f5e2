"""Mixing sources to target weights by Pareto order sampling.

A source's target divided by its size is the number of copies expected of each of its documents.
The whole part is given to every document; the fraction is the inclusion probability of one more
copy. Documents are ranked by their random odds over their inclusion odds, and a source takes them
in that order until its target is met. Random numbers come from the document id, so reruns agree.

The order is never sorted as a whole: sums per cell of the order are narrow aggregates, the cell in
which a source meets its target is cut once more, and only the rows of that last cell are sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.texts import n_words, unit_hash
from lexmill.operators.skew import Lookup, lookup_join, stored_lookup
from lexmill.session import materialize

CELLS = 1024


def source_key(source: Column) -> Column:
    """A key that is never null; null sources form one source of their own."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def source_targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), max_copies: int = 3) -> DataFrame:
    """One row per source: __source, source_size, target, whole (copies), fraction.

    `sizes` has __source and size. Sources by code point, null last, weigh `weights`, repeating,
    and share all sizes; a target stops at `max_copies` times its source's size, and the excess is
    shared again by weight. The level at which that ends is found by one pass over the sources in
    the order in which they reach their limit. The windows see one row per source.
    """
    totals = sizes.groupBy("__source").agg(F.sum("size").alias("source_size"))
    # The key of the null source, "n", sorts before those of the others, which begin with "s".
    by_name = Window.orderBy(F.col("__source") == "n", "__source")
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    everyone = Window.partitionBy()
    first = totals.select(
        "*",
        F.get(F.array(*[F.lit(w).cast("long") for w in weights]), turn).alias("w"),
        (F.lit(max_copies) * F.col("source_size")).alias("cap"),
    ).select("*", F.sum("source_size").over(everyone).alias("total"), F.sum("w").over(everyone).alias("all_w"))
    by_limit = Window.orderBy(F.col("cap") / F.col("w"), "__source").rowsBetween(Window.unboundedPreceding, -1)
    capped = F.coalesce(F.sum("cap").over(by_limit), F.lit(0))
    used = F.coalesce(F.sum("w").over(by_limit), F.lit(0))
    levels = first.withColumn("t", (F.col("total") - capped) / (F.col("all_w") - used))
    level = F.max(F.when(F.col("t") <= F.col("cap") / F.col("w"), F.col("t"))).over(everyone)
    targets = levels.select("__source", "source_size", F.least(F.col("cap").cast("double"), F.col("w") * level).alias("target"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    return targets.withColumn("whole", whole.cast("long")).withColumn(
        "rest", F.col("target") - F.col("whole") * F.col("source_size")
    ).withColumn("fraction", F.when(F.col("source_size") > 0, F.col("rest") / F.col("source_size")).otherwise(F.lit(0.0)))


def pareto_rank(u: Column, inclusion: Column) -> Column:
    """Random odds over inclusion odds; an inclusion probability of 0 ranks last."""
    odds = inclusion / (F.lit(1.0) - inclusion)
    return F.when(inclusion <= 0, F.lit(float("inf"))).otherwise((u / (F.lit(1.0) - u)) / odds)


def _cell(rank: Column, level: int) -> Column:
    """Cells cut the order into equal shares of (0, 1); a higher level cuts each cell again."""
    place = F.when(rank == float("inf"), F.lit(1.0)).otherwise(rank / (F.lit(1.0) + rank))
    n = CELLS ** (level + 1)
    return F.least(F.floor(place * F.lit(float(n))), F.lit(n - 1)).cast("long")


def fixed_size_cut(ranked: DataFrame, quota: DataFrame, levels: int = 2) -> DataFrame:
    """Where each source's sample ends: __source, cell, cut (rank, id), filler (rank, id).

    `ranked` has __source, __id (unique in its source), size, rank; `quota` has __source, rest. The
    sample is every document below `cell`, those of the cell up to `cut`, and the `filler`: the
    document after the cut that leaves the least of the quota open, if it leaves less than none.
    """
    state = quota.select("__source", "rest", F.lit(0).cast("long").alias("before"), F.lit(None).cast("long").alias("cell"))
    for level in range(levels):
        rows = lookup_join(ranked, state, ["__source"])
        inside = F.lit(True) if level == 0 else _cell(F.col("rank"), level - 1) == F.col("cell")
        sums = (
            rows.where(inside)
            .groupBy("__source", _cell(F.col("rank"), level).alias("next"))
            .agg(F.sum("size").alias("size"), F.first("rest").alias("rest"), F.first("before").alias("before"))
        )
        so_far = Window.partitionBy("__source").orderBy("next")
        sums = sums.withColumn("upto", F.col("before") + F.sum("size").over(so_far))
        over = F.col("upto") > F.col("rest")
        found = sums.groupBy("__source").agg(
            F.coalesce(F.min(F.when(over, F.col("next"))), F.max("next") + 1).alias("cell"),
            F.coalesce(F.min(F.when(over, F.col("upto") - F.col("size"))), F.max("upto")).alias("before"),
        )
        # A source that has no row left in its cell ends where that cell begins.
        kept = _df(state).select("__source", "rest", F.col("before").alias("b"), (F.col("cell") * CELLS).alias("c"))
        state = kept.join(found, "__source", "left").select(
            "__source", "rest", F.coalesce("before", "b").alias("before"), F.coalesce("cell", "c").alias("cell")
        )
        state = stored_lookup(state, "mix-cut")
    last, state = lookup_join(ranked, state, ["__source"]), state.df
    place = F.struct(F.col("rank").alias("rank"), F.col("__id").alias("id"))
    in_cell = last.where(_cell(F.col("rank"), levels - 1) == F.col("cell"))
    order = Window.partitionBy("__source").orderBy("rank", "__id")
    upto = F.col("before") + F.sum("size").over(order)
    fits = in_cell.withColumn("upto", upto).where(F.col("upto") <= F.col("rest"))
    cut = fits.groupBy("__source").agg(F.max(place).alias("cut"), F.max("upto").alias("filled"))
    state = stored_lookup(
        state.join(cut, "__source", "left").withColumn("gap", F.col("rest") - F.coalesce("filled", "before")), "mix-cut"
    )
    behind = lookup_join(ranked, state, ["__source"]).where(~_below(levels))
    short = F.abs(F.col("gap") - F.col("size"))
    filler = (
        behind.where((short < F.col("gap")) & (F.col("rank") < float("inf")))
        .groupBy("__source")
        .agg(F.min(F.struct(short.alias("short"), F.col("rank").alias("rank"), F.col("__id").alias("id"))).alias("filler"))
    )
    return materialize(state.df.join(filler, "__source", "left").select("__source", "cell", "cut", "filler"), "mix-cut")


def _df(state: DataFrame | Lookup) -> DataFrame:
    return state.df if isinstance(state, Lookup) else state


def _below(levels: int = 2) -> Column:
    at = _cell(F.col("rank"), levels - 1)
    place = F.struct(F.col("rank").alias("rank"), F.col("__id").alias("id"))
    return (at < F.col("cell")) | ((at == F.col("cell")) & F.coalesce(place <= F.col("cut"), F.lit(False)))


def _id_key(id_col: Column) -> Column:
    return F.coalesce(id_col.cast("string"), F.lit("null"))


class Mix:
    """A mix of sources, planned once from the sizes; see `plan`."""

    def __init__(self, sizes: DataFrame, sources: Lookup, seed: int):
        self.sizes, self.sources, self.seed = sizes, sources, seed

    def copies(self, df: DataFrame, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
        """`df` with `source_size`, `target` and `__copies` added; a column with such a name gives way.

        Whether a document is taken once more follows from its own id and its source's row.
        """
        kept = {f"in{i}": c for i, c in enumerate(df.columns) if c not in ("source_size", "target", "__copies")}
        keyed = df.select(
            source_key(F.col(source_col)).alias("__source"), _id_key(F.col(id_col)).alias("__id"),
            *[F.col(c).alias(a) for a, c in kept.items()],
        )
        # The id joins `sources` as a plain column; rows of a hot source spread over salts there.
        rows = lookup_join(keyed, self.sources, ["__source"], "left")
        rows = rows.withColumn("rank", pareto_rank(unit_hash(F.col("__id"), self.seed), F.col("fraction")))
        is_filler = F.coalesce((F.col("__id") == F.col("filler.id")) & (F.col("fraction") > 0), F.lit(False))
        extra = (_below() & (F.col("fraction") > 0)) | is_filler
        rows = rows.withColumn("__copies", F.col("whole") + F.coalesce(extra, F.lit(False)).cast("long"))
        return rows.select(*[F.col(a).alias(c) for a, c in kept.items()], "source_size", "target", "__copies")


def plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: Sequence[int] = (5, 2, 1),
    max_copies: int = 3,
    seed: int = 17,
) -> Mix:
    """Plan the mix of `docs`. Texts are read once, for their sizes in words.

    Null texts have size 0 and a null source is a source of its own, last in order. Rows that repeat
    an id within a source are taken or left together. An empty table gives an empty plan. A document
    is taken at most `max_copies` times.
    """
    sizes = materialize(
        docs.select(
            F.col(id_col).alias("id"), F.col(source_col).alias("source"),
            source_key(F.col(source_col)).alias("__source"), n_words(F.col(text_col)).alias("size"),
        ),
        "mix-sizes",
    )
    targets = materialize(source_targets(sizes, weights, max_copies), "mix-targets")
    # A source that takes whole copies only has no sample, and its documents no order.
    sampled = targets.where("fraction > 0")
    units = sizes.groupBy("__source", _id_key(F.col("id")).alias("__id")).agg(F.sum("size").alias("size"))
    ranked = lookup_join(units, sampled.select("__source", "fraction"), ["__source"]).select(
        "__source", "__id", "size", pareto_rank(unit_hash(F.col("__id"), seed), F.col("fraction")).alias("rank")
    )
    cuts = fixed_size_cut(materialize(ranked, "mix-ranks"), sampled.select("__source", "rest"))
    sources = stored_lookup(targets.join(cuts, "__source", "left"), "mix-sources")
    return Mix(sizes, sources, seed)


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it."""
    planned = plan(docs, id_col, source_col, text_col, **options)
    inner = [F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]
    at = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    taken = planned.copies(docs.select(*inner), at[id_col], at[source_col]).where(F.col("__copies") > 0)
    taken = taken.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))))
    return taken.select(*[F.col(at[c]).alias(c) for c in docs.columns])

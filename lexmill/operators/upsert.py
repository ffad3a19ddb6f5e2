"""Merging new rows into state tables. Every function returns the new snapshot."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.schemas import STATUSES

ChangeRule = Callable[[Column, Column], Column]


def latest(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], descending: bool = True) -> DataFrame:
    """One row per key, the last (or first) in `order`.

    An aggregate rather than a window: repeats of a hot key combine before the shuffle.
    """
    keys = list(keys)
    rest = F.struct(*[F.col(c) for c in rows.columns if c not in keys])
    pick = F.max_by if descending else F.min_by
    chosen = rows.groupBy(*keys).agg(pick(rest, F.struct(*order)).alias("__r"))
    return chosen.select(*keys, "__r.*").select(*rows.columns)


def merge(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    replace: ChangeRule,
    keep_when_null: Sequence[str] = (),
) -> DataFrame:
    """Full outer merge; column `change` says new, updated, skipped or kept.

    `replace(old, new)` gets the two rows as struct columns and decides whether the new one wins.
    Columns named in `keep_when_null` keep the stored value where the new one is null. Columns that
    only the stored table has are always kept.
    """
    keys = list(keys)
    old_cols = [c for c in existing.columns if c not in keys]
    new_cols = [c for c in incoming.columns if c not in keys]
    old = existing.select(*keys, F.struct(F.lit(True).alias("__here"), *old_cols).alias("__old"))
    new = incoming.select(*keys, F.struct(F.lit(True).alias("__here"), *new_cols).alias("__new"))
    both = old.join(new, keys, "full_outer")
    o, n = F.col("__old"), F.col("__new")
    wins = F.coalesce(replace(o, n), F.lit(False))
    change = (
        F.when(n.isNull(), "kept").when(o.isNull(), "new").when(wins, "updated").otherwise("skipped")
    )
    both = both.withColumn("change", change)
    take_new = F.col("change").isin("new", "updated")
    out = []
    for c in old_cols:
        if c not in new_cols:
            out.append(o[c].alias(c))
        elif c in keep_when_null:
            out.append(F.when(take_new, F.coalesce(n[c], o[c])).otherwise(o[c]).alias(c))
        else:
            out.append(F.when(take_new, n[c]).otherwise(o[c]).alias(c))
    return both.select(*keys, *out, "change").select(*existing.columns, "change")


def change_counts(merged: DataFrame) -> DataFrame:
    """One row: how many incoming rows were new, updated or skipped."""
    return merged.agg(
        F.count_if(F.col("change") == "new").alias("n_new"),
        F.count_if(F.col("change") == "updated").alias("n_updated"),
        F.count_if(F.col("change") == "skipped").alias("n_skipped"),
    )


def upsert_fetch_results(existing: DataFrame, incoming: DataFrame, force: bool = False) -> DataFrame:
    """New ids are added; known ids are refreshed with `force`, or when they were rate-limited."""
    rule = (lambda o, n: F.lit(True)) if force else (lambda o, n: o["status"] == "RATE_LIMITED")
    return merge(existing, incoming, ["document_id"], rule)


def upsert_registry(existing: DataFrame, incoming: DataFrame, force: bool = False) -> DataFrame:
    """Like the fetch results; columns the probe does not know keep their stored value."""
    rule = (lambda o, n: F.lit(True)) if force else (lambda o, n: o["status"] == "RATE_LIMITED")
    kept = [c for c in existing.columns if c in ("url", "pdf_path", "ocr_path", "sha256")]
    return merge(existing, incoming, ["type", "year", "number"], rule, keep_when_null=kept)


def upsert_downloads(existing: DataFrame, incoming: DataFrame, present: DataFrame, force: bool = False) -> DataFrame:
    """Recorded downloads whose file is still present are skipped unless `force`."""
    flagged = incoming.join(
        present.select("document_id", F.lit(True).alias("__present")), "document_id", "left"
    ).withColumn("__present", F.coalesce("__present", F.lit(False)))
    rule = (lambda o, n: F.lit(True)) if force else (lambda o, n: ~n["__present"])
    return merge(existing, flagged, ["document_id"], rule)


def insert_ignore(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add rows whose key is absent; of several new rows with one key the smallest is kept."""
    keys = list(keys)
    rest = [F.col(c) for c in incoming.columns if c not in keys]
    if rest:
        fresh = latest(incoming, keys, rest, descending=False)
    else:
        fresh = incoming.select(*keys).distinct()
    fresh = fresh.join(existing.select(*keys), keys, "left_anti")
    return existing.unionByName(fresh.select(*existing.columns))


def better_by_confidence(threshold: float = 0.0) -> ChangeRule:
    """The candidate must exceed the stored confidence by more than `threshold`."""
    return lambda old, new: new["confidence"] > old["confidence"] + threshold


def always(old: Column, new: Column) -> Column:
    return F.lit(True)


def never(old: Column, new: Column) -> Column:
    return F.lit(False)


def reprocess_flag(policy: ChangeRule, old: Column, new: Column) -> Column:
    """Whether to process again: yes without a stored row, or when the comparison has no answer."""
    return F.when(old.isNull(), F.lit(True)).otherwise(F.coalesce(policy(old, new), F.lit(True)))


def keep_better(existing: DataFrame, incoming: DataFrame, policy: ChangeRule | None = None) -> DataFrame:
    """Extraction results: the candidate replaces the stored row only if the policy says so."""
    rule = policy or better_by_confidence()
    return merge(existing, incoming, ["document_id"], rule)


def set_status(registry: DataFrame, ids: DataFrame, status: str, id_col: str = "document_id") -> DataFrame:
    """Set the status of the listed documents; unknown ids have no effect."""
    if status not in STATUSES:
        raise ValueError(f"unknown status: {status}")
    marks = ids.select(id_col).distinct().withColumn("__hit", F.lit(True))
    return registry.join(marks, id_col, "left").select(
        *[
            F.when(F.col("__hit"), F.lit(status)).otherwise(F.col("status")).alias("status") if c == "status" else F.col(c)
            for c in registry.columns
        ]
    )


def move_status(registry: DataFrame, source: str, target: str) -> DataFrame:
    """All rows of one status move to another."""
    for s in (source, target):
        if s not in STATUSES:
            raise ValueError(f"unknown status: {s}")
    return registry.withColumn(
        "status", F.when(F.col("status") == source, F.lit(target)).otherwise(F.col("status"))
    )


def record_errors(registry: DataFrame, ids: DataFrame) -> DataFrame:
    return set_status(registry, ids, "FAILED")


def delete_documents(table: DataFrame, ids: DataFrame, id_col: str = "document_id") -> DataFrame:
    return table.join(ids.select(id_col).distinct(), id_col, "left_anti")

"""The jobs over stored tables, at the cost of their batch.

Each job finds the partitions (type, year) that its input can change, gives the job of
`lexmill.plans.jobs` only these, and returns the new content of these alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import ids
from lexmill.operators import upsert
from lexmill.plans import jobs
from lexmill.sources.tables import Change, StateTables, in_parts, parts_by_id, parts_of


def merge(
    store: StateTables, name: str, incoming: DataFrame, keys: list[str], rule: upsert.ChangeRule, keep_when_null: tuple = ()
) -> Change:
    """`upsert.merge` of some rows into a stored table; reads and returns only the partitions they lie in."""
    placed = store.placed(name, incoming)
    parts = parts_of(placed, *store.partitions(name)) if store.partitions(name) else None
    merged = upsert.merge(store.read(name, parts), incoming, keys, rule, keep_when_null)
    return Change(merged.drop("change"), parts)


def fetch(store: StateTables, probes: DataFrame, as_of: str, options: jobs.FetchOptions = jobs.FetchOptions()) -> dict[str, Change]:
    """Partitions are those of the candidates that were probed. Missing numbers are read as far as the cursors look."""
    cursors, not_found = store.read("cursors"), store.read("not_found")
    candidates, _ = jobs.plan_fetch(cursors, not_found, options)
    parts = parts_of(candidates.join(probes.select("document_id").distinct(), "document_id", "left_semi"))
    out = jobs.run_fetch(
        store.read("registry", parts), store.read("fetch_results", parts), cursors, not_found, probes, as_of, options
    )
    changes = {name: Change(out[name], parts) for name in ("fetch_results", "registry")}
    changes["cursors"] = Change(out["cursors"])
    if "not_found" in out:
        changes["not_found"] = Change(out["not_found"].where(in_parts(parts, "document_type", "year")), parts)
    return changes


def download(store: StateTables, inventory: DataFrame, payloads: DataFrame, as_of: str, **options) -> dict[str, Change]:
    parts = parts_by_id(payloads)
    out = jobs.run_download(
        store.read("registry", parts), inventory, store.read("download_results", parts), payloads, as_of, **options
    )
    return {name: Change(out[name], parts) for name in ("download_results", "registry")}


def extract(
    store: StateTables, texts: DataFrame, dictionary: DataFrame, as_of: str, options: jobs.ExtractOptions = jobs.ExtractOptions(), **results
) -> dict[str, Change]:
    """New unknown words are appended; those known already are not written again."""
    parts, known = parts_by_id(texts), store.read("unrecognized_words")
    out = jobs.run_extract(
        store.read("registry", parts), texts, store.read("extractions", parts), dictionary, known, as_of, options, **results
    )
    fresh = out["unrecognized_words"].join(known, "word", "left_anti")
    changes = {name: Change(out[name], parts) for name in ("extractions", "registry")}
    return changes | {"unrecognized_words": Change(fresh, append=True)}


def consolidate(store: StateTables, as_of: str, type_: str | None = None, prune_stale: bool = False) -> dict[str, Change]:
    """Partitions with extracted documents; finding them reads three narrow columns of the registry."""
    waiting = (F.col("status") == "EXTRACTED") & ids.type_filter(F.col("type"), type_)
    parts = store.parts("registry", waiting)
    names = ("consolidated_metadata", "consolidated_articles", "consolidated_signatories")
    stored = [store.read(name, parts) for name in ("registry", "extractions", *names)]
    out = jobs.run_consolidate(*stored, as_of, type_, prune_stale)
    return {name: Change(out[name], parts) for name in (*names, "registry")}


def fix(store: StateTables, inventory: DataFrame, stuck: Column | None = None, **options) -> dict[str, Change]:
    """An audit looks at every row; only the partitions with a repaired document are written."""
    out = jobs.run_fix(
        store.read("registry"), inventory, store.read("download_results"), store.read("extractions"), stuck=stuck, **options
    )
    parts = parts_by_id(out["fix_results"])
    return {
        "fix_results": Change(out["fix_results"]),
        "registry": Change(out["registry"].where(in_parts(parts, "type", "year")), parts),
    }


def delete(store: StateTables, documents: DataFrame, names: tuple[str, ...]) -> dict[str, Change]:
    """The named tables without the rows of `documents` (document_id)."""
    parts = parts_by_id(documents)
    return {name: Change(upsert.delete_documents(store.read(name, parts), documents), parts) for name in names}

"""How far the sources of each language differ in the words they use.

Every partition folds its documents into stripes: for each term of a language the number of
documents that have it and its count in each source. A full table of stripes is handed on (spilled)
and begun anew. The shuffle brings the stripes of a term together, sorted, and one pass merges them.
A merged stripe directly gives the term's share in every source, its part of the divergence of every
pair of sources, and its rank among the terms that set a source apart.

A term occurs once in a table of stripes, so a common term is no hot key: it has one row per spill.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.texts import fold_table, parts_of
from lexmill.operators.skew import lookup_join, stored_lookup
from lexmill.session import materialize

MIN_DOCS = 10
TOP_TERMS = 10
UNIT = 1_000_000_000
SPILL_ENTRIES = 400_000  # (term, source) counts that a task holds
SPILL_BYTES = 64 << 20  # of terms
BLOCK = 512  # sources that one task compares with as many others
ENTRIES_PER_TASK = 200_000
CELLS = 1 << 20
FOLD = fold_table()
KEEPS_64_BITS = 9_000_000_000  # counts below it, times UNIT, fit into 64 bits


def groups_of(docs: DataFrame, lang_col: str, source_col: str) -> DataFrame:
    """(lang, source, sid): each pair that occurs, sources of a language numbered in order from 0."""
    pairs = docs.select(lang_col, source_col).distinct()
    return pairs.withColumn("sid", F.row_number().over(Window.partitionBy(lang_col).orderBy(source_col)) - 1)


def words_of(text: bytes | None) -> Counter:
    """How often each term occurs; long texts are split part by part."""
    found: Counter = Counter()
    for part in parts_of((text or b"").translate(FOLD)):
        found.update(part.split())
    return found


def stripes(docs: DataFrame, entries: int, size: int) -> DataFrame:
    """(lang, term, df, sids, counts) from (lang, sid, text), each term once per spill."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, dict[bytes, dict[int, int]]] = {}
        held = held_bytes = 0
        for batch in batches:
            for lang, sid, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                table = tables.setdefault(lang, {})
                for term, n in words_of(text.as_py()).items():
                    stripe = table.get(term)
                    if stripe is None:
                        table[term] = {-1: 1, sid: n}
                        held, held_bytes = held + 1, held_bytes + len(term)
                    else:
                        stripe[-1] += 1
                        if sid in stripe:
                            stripe[sid] += n
                        else:
                            stripe[sid] = n
                            held += 1
                if held >= entries or held_bytes >= size:
                    yield from spill(tables)
                    held = held_bytes = 0
        yield from spill(tables)

    def spill(tables) -> Iterator[pa.RecordBatch]:
        for lang, table in tables.items():
            while table:
                out = [table.popitem() for _ in range(min(len(table), 20_000))]
                df = [s.pop(-1) for _, s in out]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(out), pa.string()), pa.array([t for t, _ in out], pa.binary()), pa.array(df, pa.int64()),
                        pa.array([list(s) for _, s in out], pa.list_(pa.int32())),
                        pa.array([list(s.values()) for _, s in out], pa.list_(pa.int64())),
                    ],
                    ["lang", "term", "df", "sids", "counts"],
                )
        tables.clear()

    return docs.mapInArrow(run, "lang string, term binary, df long, sids array<int>, counts array<long>")


def joined(term: np.ndarray, df: np.ndarray, lengths: np.ndarray, sids: np.ndarray, counts: np.ndarray):
    """Stripes with the same term number (ascending) added up: term numbers, df, lengths, sids, counts."""
    first = np.flatnonzero(np.diff(term, prepend=-1))
    owner = np.repeat(np.cumsum(np.diff(term, prepend=-1) != 0) - 1, lengths)
    order = np.lexsort((sids, owner))
    owner, sids, counts = owner[order], sids[order], counts[order]
    new = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | (np.diff(sids, prepend=-1) != 0))
    total = np.add.reduceat(counts, new) if len(new) else counts
    return term[first], np.add.reduceat(df, first), np.bincount(owner[new], minlength=len(first)), sids[new], total


def merged(rows: DataFrame, min_docs: int) -> DataFrame:
    """The stripes of each (lang, term) in at least `min_docs` documents, added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # the last stripe of a batch may go on in the next
        for batch in batches:
            if rest is not None:
                batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            if not batch.num_rows:
                continue
            lang, term = batch.column(0), batch.column(1)
            last = len(lang) - 1
            new = pc.or_(pc.not_equal(lang[1:], lang[:last]), pc.not_equal(term[1:], term[:last])).to_numpy(zero_copy_only=False)
            number = np.concatenate(([0], np.cumsum(new)))
            first = np.concatenate(([0], np.flatnonzero(new) + 1))
            sids, counts = batch.column(3).flatten().to_numpy(), batch.column(4).flatten().to_numpy()
            lengths = pc.list_value_length(batch.column(3)).to_numpy()
            _, df, lengths, sids, counts = joined(number, batch.column(2).to_numpy(), lengths, sids, counts)
            offsets = pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32())
            lists = [
                pa.ListArray.from_arrays(offsets, pa.array(v), type=batch.schema.field(i).type) for i, v in ((3, sids), (4, counts))
            ]
            where = pa.array(first)
            out = pa.RecordBatch.from_arrays([lang.take(where), term.take(where), pa.array(df), *lists], schema=batch.schema)
            rest = out.slice(out.num_rows - 1)
            out = out.slice(0, out.num_rows - 1)
            yield out.filter(pc.greater_equal(out.column(2), min_docs))
        if rest is not None:
            yield rest.filter(pc.greater_equal(rest.column(2), min_docs))

    placed = rows.repartition("lang", "term").sortWithinPartitions("lang", "term")
    return placed.mapInArrow(run, rows.schema)


def share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(UNIT * (count + 2) / total), exact; `total` has the smoothing in it."""
    if count.size and count.max() >= KEEPS_64_BITS:
        exact = UNIT * (count.astype(object) + 2) // np.maximum(total, 1).astype(object)
        return exact.astype(np.int64) + 1
    return UNIT * (count + 2) // np.maximum(total, 1) + 1


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)); shares are at most UNIT + 1, so 64 bits hold the square."""
    return (p - q) ** 2 // (p + q)


def compare(stripe: pa.Table, groups: pa.Table, top: int) -> pa.Table:
    """What the stripes of one part say about two blocks of sources.

    `groups` holds sid, total (with smoothing), and lang_total of both. For each pair of a source of
    the first block and one of the second, the sum over terms that either has, less what the term
    would give if both lacked it; within one block also the best terms of each source.
    """
    bi, bj = groups.column("bi")[0].as_py(), groups.column("bj")[0].as_py()
    sid, total = groups.column("sid").to_numpy(), groups.column("total").to_numpy()
    lang_total = groups.column("lang_total")[0].as_py()
    order = np.argsort(sid)
    sid, total = sid[order], total[order]
    left, right = np.flatnonzero(sid // BLOCK == bi), np.flatnonzero(sid // BLOCK == bj)
    sums = np.zeros((len(left), len(right)), np.int64)
    none = share(np.zeros(len(sid), np.int64), total)
    neither = apart(none[left][:, None], none[right][None])
    terms = stripe.column("term").combine_chunks()
    terms = terms.chunk(0) if isinstance(terms, pa.ChunkedArray) else terms
    kept: dict[int, list] = {}
    step = max(1, CELLS // len(sid))
    for at in range(0, stripe.num_rows, step):
        part = stripe.slice(at, step).combine_chunks()
        lists = part.column("sids")
        lengths = pc.list_value_length(lists).to_numpy()
        row = np.repeat(np.arange(len(lengths)), lengths)
        col = np.searchsorted(sid, pc.list_flatten(lists).to_numpy())
        count = np.zeros((len(lengths), len(sid)), np.int64)
        count[row, col] = pc.list_flatten(part.column("counts")).to_numpy()
        p = share(count, total[None])
        for i, g in enumerate(left):
            hs = right[right > g] if bi == bj else right
            if len(hs):
                sums[i, np.searchsorted(right, hs)] += (apart(p[:, g : g + 1], p[:, hs]) - neither[i, np.searchsorted(right, hs)]).sum(axis=0)
        if bi != bj:
            continue
        q = share(part.column("total").to_numpy(), np.array([lang_total]))
        for g in range(len(sid)):
            found = np.flatnonzero((count[:, g] > 0) & (p[:, g] > q))
            f = apart(p[found, g], q[found])
            if len(f) > top:
                most = f >= np.partition(f, len(f) - top)[len(f) - top]
                found, f = found[most], f[most]
            new = [(-v, terms[at + t].as_py()) for v, t in zip(f.tolist(), found.tolist(), strict=True)]
            kept[g] = sorted([*kept.get(g, []), *new])[:top]
    lang = groups.column("lang")[0].as_py()
    a, b = np.nonzero(sums)
    best = [(int(sid[g]), t, -v) for g, entries in kept.items() for v, t in entries]
    n = len(a) + len(best)
    return pa.table(
        {
            "lang": pa.array([lang] * n, pa.string()),
            "sid": pa.array([*sid[left][a].tolist(), *[x[0] for x in best]], pa.int32()),
            "other": pa.array([*sid[right][b].tolist(), *[None] * len(best)], pa.int32()),
            "term": pa.array([*[None] * len(a), *[x[1] for x in best]], pa.binary()),
            "value": pa.array([*sums[a, b].tolist(), *[x[2] for x in best]], pa.int64()),
        }
    )


def audit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_docs: int = MIN_DOCS,
    top: int = TOP_TERMS,
    spill_entries: int = SPILL_ENTRIES,
    spill_bytes: int = SPILL_BYTES,
    entries_per_task: int = ENTRIES_PER_TASK,
) -> DataFrame:
    """(lang, source, part, item, value, rank): divergences of sources, and the terms that set them apart.

    A null text, language or source counts as empty. Terms are runs of letters and characters beyond
    ASCII; each language keeps those that at least `min_docs` of its documents have. Every source of a
    language is compared with each other one (part `pair`, all ranks) and with the language as a whole
    (part `term`, the `top` terms it has more of). Repeated rows count again, a language without kept
    terms gives pairs of value 0, equal values are ordered by item, an empty table gives no rows, and
    other columns are not looked at. Shares are whole billionths; all sums are exact.
    """
    own = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"))], F.col(text_col).alias("text"))
    lookup = stored_lookup(groups_of(own, "lang", "source"), "groups")
    groups = lookup.df
    numbered = lookup_join(own, lookup, ["lang", "source"]).select("lang", "sid", F.col("text").cast("binary"))
    found = materialize(merged(stripes(numbered, spill_entries, spill_bytes), min_docs), "stripes")

    each = found.select("lang", F.inline(F.arrays_zip("sids", "counts"))).groupBy("lang", F.col("sids").alias("sid"))
    n_of = each.agg(F.sum("counts").alias("n"), F.count(F.lit(1)).alias("entries"))
    v_of = found.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    sizes = groups.join(n_of, ["lang", "sid"], "left").join(v_of, "lang", "left").na.fill(0, ["n", "entries", "v"])
    sizes = materialize(sizes, "sizes")
    langs = sizes.groupBy("lang").agg(
        (F.sum("n") + 2 * F.max("v")).alias("lang_total"), F.max("v").alias("v"),
        F.floor(F.max("sid") / BLOCK).cast("int").alias("last"),
        F.ceil(F.sum("entries") / F.lit(entries_per_task)).cast("int").alias("parts"),
    )
    langs = materialize(langs, "langs")
    sizes = sizes.join(langs.drop("v"), "lang").withColumn("total", F.col("n") + 2 * F.col("v"))

    # A stripe goes to the pairs of blocks that hold one of its sources, with only the counts of these.
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("total")
    lookup = langs.select("lang", "last", "parts")
    rows = lookup_join(found.select("lang", "term", "sids", "counts", total), lookup, ["lang"])
    rows = rows.withColumn("part", F.pmod(F.xxhash64("term"), F.col("parts")).cast("int"))
    blocks = F.array_distinct(F.transform("sids", lambda s: F.floor(s / BLOCK).cast("int")))
    rows = rows.withColumn("b", F.explode(blocks)).withColumn("c", F.explode(F.sequence(F.lit(0), "last")))
    rows = rows.withColumn("bi", F.least("b", "c")).withColumn("bj", F.greatest("b", "c"))
    # A stripe with sources in both blocks comes from either; the smaller block sends it.
    rows = rows.where((F.col("b") <= F.col("c")) | ~F.exists("sids", lambda s: F.floor(s / BLOCK) == F.col("c")))
    here = F.filter(F.arrays_zip("sids", "counts"), lambda x: F.floor(x["sids"] / BLOCK).isin(F.col("bi"), F.col("bj")))
    rows = rows.withColumn("here", here).select("lang", "bi", "bj", "part", "term", "total", F.col("here.sids").alias("sids"), F.col("here.counts").alias("counts"))

    mine = F.floor(F.col("sid") / BLOCK).cast("int")
    right = sizes.where("parts > 0").withColumn("c", F.explode(F.sequence(F.lit(0), "last"))).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    right = right.select("lang", F.least(mine, "c").alias("bi"), F.greatest(mine, "c").alias("bj"), "part", "sid", "total", "lang_total")

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        return compare(left, right, top)

    keys = ["lang", "bi", "bj", "part"]
    said = rows.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(work, "lang string, sid int, other int, term binary, value long")
    said = materialize(said, "divergences")
    return _pairs(said, sizes).unionByName(_terms(said, groups, top))


def _pairs(said: DataFrame, sizes: DataFrame) -> DataFrame:
    """Every source of a language with each other one: what terms that both lack give, and the rest."""
    none = F.expr(f"1 + (2 * {UNIT}L) div greatest(total, 1L)")
    one = sizes.select("lang", "source", "sid", "v", none.alias("p"))
    two = sizes.select("lang", F.col("source").alias("item"), F.col("sid").alias("other"), none.alias("q"))
    base = F.expr("v * (((p - q) * (p - q)) div (p + q))")
    both = one.join(two, "lang").where("sid != other")
    found = said.where("other IS NOT NULL").groupBy("lang", F.least("sid", "other").alias("lo"), F.greatest("sid", "other").alias("hi"))
    found = found.agg(F.sum("value").alias("value"))
    keyed = both.select("lang", "source", "item", base.alias("base"), F.least("sid", "other").alias("lo"), F.greatest("sid", "other").alias("hi"))
    rows = keyed.join(found, ["lang", "lo", "hi"], "left").select("lang", "source", "item", (F.col("base") + F.coalesce("value", F.lit(0))).alias("value"))
    return rows.select("lang", "source", F.lit("pair").alias("part"), "item", "value", _rank().alias("rank"))


def _terms(said: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    rows = said.where("term IS NOT NULL").withColumn("item", F.col("term").cast("string"))
    rows = rows.select("lang", "sid", "item", "value").join(groups, ["lang", "sid"])
    rows = rows.select("lang", "source", F.lit("term").alias("part"), "item", "value").withColumn("rank", _rank())
    return rows.where(F.col("rank") <= top)


def _rank() -> Column:
    return F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))

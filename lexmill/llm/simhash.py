"""SimHash fingerprints and groups of documents whose fingerprints differ in a few bits.

The search is a hierarchical index in Gray order. Sorted by Gray rank, neighbouring fingerprints
share long bit patterns; a node keeps the bits all its members share, an upper node the bits its
children share, and a child only what its parent leaves open. A search adds up the differences on
the way down and drops a whole node once they exceed the limit.

To spread the index over tasks, its top level is a shuffle key: cut into `max_bits + 1` bands, two
fingerprints within the limit agree in one band at least, so each fingerprint enters one index for
each band, where its band value is the top node and allows no difference. A top node with more
members than a task should hold gets a second level of bands over the bits left open, and so on;
the bits left shrink until no node can be too large. Nothing is dropped or capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.components import connected_components
from lexmill.session import materialize

SEED = 42
FANOUT = 8
PAIRS_AT_ONCE = 1 << 20
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of a text; 0 without words. A bit is set if more than half the hashes set it."""
    import xxhash

    digest = xxhash.xxh64_digest
    data = (text or "").encode("utf-8", "surrogatepass").lower()  # bytes: A-Z only
    words = data.split()  # bytes: ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    n = len(words) - width + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 65536):
        to = min(at + 65536, n)
        spans = zip(starts[at:to].tolist(), ends[at + width - 1 : to + width - 1].tolist(), strict=True)
        ones += _ones(np.frombuffer(b"".join([digest(joined[a:b], SEED) for a, b in spans]), np.uint8))
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprint_of(hashes: np.ndarray) -> int:
    """64-bit SimHash of shingles given by their unsigned 64-bit hashes; 0 without any."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        ones += _ones(hashes[at : at + 65536].astype(">u8").view(np.uint8))
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def _ones(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes, given as bytes, set each bit."""
    return np.unpackbits(hashes.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp) for every row; fp is the fingerprint as a signed 64-bit number."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col)).mapInArrow(run, f"id {id_type}, fp long")


def _deal(rows: DataFrame, width: int, bands: int) -> tuple[DataFrame, int]:
    """Rows (code, rest, key) once for each band of the `width` low bits of rest, and the bits left."""
    cuts = [width * i // bands for i in range(bands + 1)]
    least = min(b - a for a, b in zip(cuts, cuts[1:], strict=False))

    def low(n: int) -> int:
        return (1 << n) - 1

    parts: list[Column] = []
    for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        value = F.shiftrightunsigned("rest", a).bitwiseAND(F.lit(low(b - a)))
        above = F.shiftleft(F.shiftrightunsigned("rest", b), a) if b < width else F.lit(0).cast("long")
        rest = above.bitwiseOR(F.col("rest").bitwiseAND(F.lit(low(a))))
        # A clash of keys merges two groups; distances are checked on whole codes, so it is harmless.
        parts.append(F.struct(rest.alias("rest"), F.xxhash64("key", F.lit(i), value).alias("key")))
    return rows.select("code", F.inline(F.array(*parts))), width - least


def band_groups(codes: DataFrame, max_bits: int, max_group: int) -> DataFrame:
    """(key, code): codes that differ in at most `max_bits` bits share a key with at most `max_group` members."""
    if max_group < 256:
        raise ValueError("groups below 256 cannot always be reached")
    rows = codes.select("code", F.col("code").alias("rest"), F.lit(0).cast("long").alias("key"))
    done, width = None, 64
    while True:
        rows, width = _deal(rows, width, max_bits + 1)
        rows = materialize(rows, "bands")
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        if (1 << width) <= max_group:
            large = None
        else:
            # At most rows / max_group keys.
            large = materialize(sizes.where(F.col("n") > max_group).select("key"), "large-bands")
            large = None if large.isEmpty() else large
        small = rows.select("key", "code")
        if large is not None:
            small = small.join(large, "key", "left_anti")
        done = small if done is None else done.unionByName(small)
        if large is None:
            return done
        rows = rows.join(large, "key", "left_semi")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in Gray order: the running exclusive-or of its bits from the top."""
    out = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(shift)
    return out


def _runs(owner: np.ndarray, size: int) -> np.ndarray:
    """Starts of runs of up to `size` neighbours with the same owner."""
    first = np.concatenate(([True], owner[1:] != owner[:-1]))
    begin = np.flatnonzero(first)
    inside = np.arange(len(owner)) - np.repeat(begin, np.diff(np.append(begin, len(owner))))
    return np.flatnonzero(inside % size == 0)


def build_index(group: np.ndarray, codes: np.ndarray) -> list[dict[str, np.ndarray]]:
    """Levels of the index over codes sorted by (group, Gray rank), the codes first, one root per group last."""
    levels = [{"group": group, "pattern": codes, "mask": np.full(len(codes), ALL), "low": np.arange(len(codes))}]
    while True:
        below = levels[-1]
        starts = _runs(below["group"], FANOUT)
        pattern = below["pattern"][starts]
        spread = below["pattern"] ^ np.repeat(pattern, np.diff(np.append(starts, len(below["pattern"]))))
        mask = np.bitwise_and.reduceat(below["mask"], starts) & ~np.bitwise_or.reduceat(spread, starts)
        below["own"] = below["mask"] & ~np.repeat(mask, np.diff(np.append(starts, len(spread))))
        levels.append({
            "group": below["group"][starts], "pattern": pattern, "mask": mask, "low": below["low"][starts],
            "first": starts, "last": np.append(starts[1:], len(spread)),
        })
        if len(np.unique(levels[-1]["group"])) == len(starts):
            return levels


def close_pairs(levels: list[dict[str, np.ndarray]], queries: np.ndarray, roots: np.ndarray, max_bits: int):
    """Pairs (query, earlier member of its group) that differ in at most `max_bits` bits."""
    codes = levels[0]["pattern"]
    query, node = queries, roots
    top = levels[-1]
    diff = np.bitwise_count((codes[query] ^ top["pattern"][node]) & top["mask"][node]).astype(np.int64)
    for level in range(len(levels) - 1, 0, -1):
        here, below = levels[level], levels[level - 1]
        fan = here["last"][node] - here["first"][node]
        child = np.repeat(here["first"][node] - np.cumsum(fan) + fan, fan) + np.arange(fan.sum())
        query, diff = np.repeat(query, fan), np.repeat(diff, fan)
        diff = diff + np.bitwise_count((codes[query] ^ below["pattern"][child]) & below["own"][child])
        keep = (diff <= max_bits) & (below["low"][child] < query)
        query, node, diff = query[keep], child[keep], diff[keep]
    return query, node


def merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining a[i] with b[i]; a label is the smallest member."""
    while True:
        la, lb = labels[a], labels[b]
        low, high = np.minimum(la, lb), np.maximum(la, lb)
        if np.array_equal(low, high):
            return labels
        np.minimum.at(labels, high, low)
        while not np.array_equal(labels, after := labels[labels]):
            labels = after


def group_links(key: np.ndarray, codes: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (code, first code of its local component) within groups of equal key: a star per component."""
    order = np.lexsort((gray_rank(codes), key))
    key, codes = key[order], codes[order]
    new = np.ones(len(key), bool)  # no rows at all where a batch only goes on with a group
    new[1:] = key[1:] != key[:-1]
    group = np.cumsum(new) - 1
    several = np.bincount(group)[group] > 1
    group, codes = np.unique(group[several], return_inverse=True)[1], codes[several]
    if not len(codes):
        return codes, codes
    levels = build_index(group, codes)
    labels = np.arange(len(codes))
    work = np.cumsum(np.bincount(group)[group])
    block = work // PAIRS_AT_ONCE
    for queries in np.split(labels, np.flatnonzero(np.diff(block)) + 1):
        labels = merge(labels, *close_pairs(levels, queries, group[queries], max_bits))
    linked = np.flatnonzero(labels != np.arange(len(codes)))
    return codes[linked], codes[labels[linked]]


def links(codes: DataFrame, max_bits: int = 3, max_group: int = 2048) -> DataFrame:
    """Links (a, b) that connect every two codes within `max_bits` bits of each other, directly or by way of others.

    `codes` has distinct 64-bit numbers. A group of m codes gives at most m - 1 links.
    """
    dealt = band_groups(codes, max_bits, max_group)
    tasks = max(int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = dealt.repartition(tasks, "key").sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            key = np.concatenate((rest[0], batch.column(0).to_numpy()))
            code = np.concatenate((rest[1], batch.column(1).to_numpy()))
            cut = np.searchsorted(key, key[-1]) if len(key) else 0  # the last group may go on
            rest = key[cut:], code[cut:]
            yield out(key[:cut], code[:cut])
        yield out(*rest)

    def out(key, code):
        a, b = group_links(key, code.view(np.uint64), max_bits)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    max_bits: int = 3,
    max_group: int = 2048,
) -> DataFrame:
    """One row per row of `docs`: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest id reachable over links between fingerprints that differ in at most
    `max_bits` bits; null ids count only where a component has no other. Null, empty and wordless
    texts have fingerprint zero and are linked like others. Equal fingerprints are one node, however
    many rows share it. An empty table gives no rows.
    """
    rows = materialize(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    codes = materialize(rows.groupBy(F.col("fp").alias("code")).agg(F.min("id").alias("least")), "codes")
    found = materialize(links(codes.select("code"), max_bits, max_group), "links")
    if found.isEmpty():
        by_code = codes.select("code", F.col("least").alias("component_id"))
    else:
        labels = connected_components(found)
        own = codes.join(labels.withColumnRenamed("v", "code"), "code", "left")
        own = own.select("code", F.coalesce("label", "code").alias("label"), "least")
        heads = own.groupBy("label").agg(F.min("least").alias("component_id"))
        by_code = materialize(own.select("code", "label").join(heads, "label").select("code", "component_id"), "heads")
    out = rows.join(by_code.withColumnRenamed("code", "fp"), "fp")
    return out.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs` with the smallest id of their component; rows without an id stay."""
    groups = near_duplicates(docs, id_col, text_col, **options)
    heads = groups.where("doc_id = component_id").select(F.col("doc_id").alias("__head")).distinct()
    kept = docs.join(heads, F.col(id_col) == F.col("__head"), "left_semi")
    return kept.unionByName(docs.where(F.col(id_col).isNull()))

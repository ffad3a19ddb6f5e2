"""Groups of documents whose sets of word runs are similar: SimHash links, checked, completed by an exact join.

The SimHash of a set of runs is searched by the index of `simhash`; the links it finds count if the
whole sets are similar. Sets with a similarity near the limit differ in more bits than an index can
search, so a similarity join adds every pair that is not in one component by then.

Two sets with a Jaccard similarity of `num / den` or more share one of their first elements: in any
order that holds for all sets, the first n - ceil(num * n / den) + 1 of n. Only these are shuffled,
lists of the documents that share one are made, and the pairs are checked on the whole sets. The
order puts runs that a sample of the documents has often last, so lists are short; the sample
changes the work, never the result. A bit per hash value says whether an odd number of a set's runs
has it: two sets differ in at least as many runs as bits, so most pairs are turned down unseen.

In a long list every member is first paired with a few fixed members. Pairs that are in one
component by then cannot change the result, all others in the list are checked too: its members are
dealt over cells by the size of their sets, since similar sets are of similar size, and a cell with
many members over blocks. Each member is checked with the closest of its block first, by their sketches; what is
in one component then need not meet any more. A member that can have no similar set with this run as the first shared one
is left out before. Runs that very many documents of the sample have make no list in one task at all.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.components import connected_components, joined_components
from lexmill.llm.simhash import SEED, fingerprint_of, links
from lexmill.llm.texts import by_bytes, tidy
from lexmill.operators.skew import lookup_join, stored_lookup
from lexmill.session import materialize, materialize_measured

SHINGLE = 5
SIMILAR = (4, 5)
MAX_BITS = 3  # of two fingerprints that the index links
SAMPLE = 16  # one in so many documents is counted for the order
OFTEN = 4  # documents of the sample
MOST_OFTEN = 100_000  # runs that travel with the tasks
HOT = 64  # documents of the sample from which on a run makes no list in one task
LONG_LIST = 64
CENTRES = 3
BLOCK = 8192  # members of a cell that are compared with as many others in one task
CLOSEST = 2  # members of a block that each is checked with before all others
PAIRS = 1 << 18  # pairs that a task puts out at once
BROADCAST_BYTES = 64 << 20
SKETCH_BITS = 1024


def runs(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word runs, with the words of `simhash.fingerprint`."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    width = min(shingle, len(words))
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    return np.unique(np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64))


def code_of(found: np.ndarray) -> int:
    """A signed 64-bit number for a whole set; equal sets have equal numbers."""
    import xxhash

    return int(np.uint64(xxhash.xxh64_intdigest(found.tobytes(), SEED)).astype(np.int64))


def sketch(found: np.ndarray) -> bytes:
    """Parities of the runs per hash value; each run that only one of two sets has changes one bit."""
    odd = np.bincount((found % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def frequent_runs(docs: DataFrame, text_col: str, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs that many documents of the sample have, sorted, and in how many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(runs(text.as_py(), shingle).view(np.int64))], ["run"])

    sample = docs.select(F.col(text_col)).where(F.pmod(F.xxhash64(text_col), F.lit(SAMPLE)) == 0)
    counts = sample.mapInArrow(tidy(run), "run long").groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    found = counts.where(F.col("n") >= OFTEN).orderBy(F.col("n").desc(), "run").limit(MOST_OFTEN).collect()
    found.sort(key=lambda r: r["run"] % (1 << 64))
    return np.array([r["run"] for r in found], np.int64).view(np.uint64), np.array([r["n"] for r in found], np.int64)


def first_runs(docs: DataFrame, id_col: str, text_col: str, shingle: int, similar: tuple[int, int], hot: int) -> DataFrame:
    """(id, text_key, code, n, fp, sketch, first, hot_from) for every row: its set's number, size, SimHash and sketch, the
    first runs in the common order, and the position from which on they are in `hot` or more documents of the sample."""
    often, count = frequent_runs(docs, text_col, shingle)
    num, den = similar

    def head(found: np.ndarray) -> tuple[np.ndarray, int]:
        keep = len(found) - -(-num * len(found) // den) + 1 if len(found) else 0
        hot_from = keep
        if len(often) and len(found):
            place = np.minimum(np.searchsorted(often, found), len(often) - 1)
            known = np.where(often[place] == found, count[place], 0)
            order = np.lexsort((found, known))[:keep]
            found, hot_from = found[order], int(np.searchsorted(known[order], hot))
        return found[:keep].view(np.int64), hot_from

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, batch in (part for whole in batches for part in by_bytes(whole, 2)):
            sets = [runs(t.as_py(), shingle) for t in batch.column(2)]
            heads = [head(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array([code_of(s) for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array(np.array([fingerprint_of(s) for s in sets], np.uint64).view(np.int64)),
                    pa.array([sketch(s) for s in sets], pa.binary()),
                    pa.array([h for h, _ in heads], pa.list_(pa.int64())), pa.array([h for _, h in heads], pa.int32()),
                ],
                ["id", "text_key", "code", "n", "fp", "sketch", "first", "hot_from"],
            )

    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col))
    return rows.mapInArrow(tidy(run), f"id {id_type}, text_key long, code long, n int, fp long, sketch binary, first array<long>, hot_from int")


def index_pairs(codes: DataFrame, max_bits: int) -> DataFrame:
    """Pairs (a, b) of sets whose fingerprints are equal or linked by the SimHash index."""
    heads = materialize(codes.groupBy("fp").agg(F.min("code").alias("head")), "fingerprints")
    equal = codes.join(heads, "fp").where("code != head").select(F.col("head").alias("a"), F.col("code").alias("b"))
    found = links(heads.select(F.col("fp").alias("code")), max_bits)
    found = found.join(heads.select(F.col("fp").alias("a"), F.col("head").alias("x")), "a")
    found = found.join(heads.select(F.col("fp").alias("b"), F.col("head").alias("y")), "b")
    return equal.unionByName(found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))


def apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) that are not in one component (v, label) yet."""
    found = pairs.join(labels.select(F.col("v").alias("a"), F.col("label").alias("x")), "a", "left")
    found = found.join(labels.select(F.col("v").alias("b"), F.col("label").alias("y")), "b", "left")
    return found.where(F.coalesce("x", "a") != F.coalesce("y", "b")).select("a", "b")


def possible(n: np.ndarray, at: np.ndarray, a: np.ndarray, b: np.ndarray, similar: tuple[int, int]) -> np.ndarray:
    """Whether members a and b of a list can be similar if its run is the first that they share."""
    num, den = similar
    return (num + den) * np.minimum(n[a] - at[a], n[b] - at[b]) >= num * (n[a] + n[b])


def by_group(rows: DataFrame, keys: list[str], order: list[str], work: Callable, schema: str) -> DataFrame:
    """`work` over whole groups of equal `keys`: arrays of keys and `order`, sorted by them, of one or more groups.

    Binary columns have one width and become rows of 64-bit numbers.
    """
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = rows.select(*keys, *order).repartition(tasks, *keys).sortWithinPartitions(*keys, *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[list[np.ndarray]] = []
        for batch in batches:
            here = [numbers(c) for c in batch.columns]
            if not len(here[0]):
                continue
            begins = starts(here[: len(keys)])
            cut = int(begins[-1])  # the last group may go on
            if rest and any(rest[-1][k][-1] != here[k][0] for k in range(len(keys))):
                yield from work(*joined(rest))
                rest = []
            if cut:
                yield from work(*joined([*rest, [c[:cut] for c in here]]))
                rest = []
            rest.append([c[cut:] for c in here])
        if rest:
            yield from work(*joined(rest))

    def numbers(column: pa.Array) -> np.ndarray:
        if pa.types.is_binary(column.type):
            return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), -1)
        return column.to_numpy(zero_copy_only=False).astype(np.int64)

    def joined(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
        return [np.concatenate(c) for c in zip(*parts, strict=True)]

    return dealt.mapInArrow(tidy(run), schema)


def starts(keys: list[np.ndarray]) -> np.ndarray:
    """Where a new group begins in sorted arrays of keys."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def list_pairs(rows: DataFrame, similar: tuple[int, int], long_list: int) -> DataFrame:
    """Pairs (a, b) of short lists and of the centres of long ones; members of long lists with run, n and at, b null."""

    def work(run, code, n, at):
        own = starts([run, code])  # equal sets once
        run, code, n, at = (c[own] for c in (run, code, n, at))
        begins = starts([run])
        size = np.diff(np.append(begins, len(run)))
        long = np.repeat(size > long_list, size)
        left, right = [], []
        short = np.flatnonzero(~long)
        for d in range(1, long_list):
            short = short[short + d < len(run)]
            short = short[run[short + d] == run[short]]
            if not len(short):
                break
            left.append(short)
            right.append(short + d)
        member, begin = np.flatnonzero(long), np.repeat(begins, size)[long]
        for k in range(CENTRES):
            other = member > begin + k
            left.append(begin[other] + k)
            right.append(member[other])
        a, b = np.concatenate(left), np.concatenate(right)
        good = possible(n, at, a, b, similar)
        a, b = a[good], b[good]
        none = [None] * len(a)
        columns = [
            pa.array(np.concatenate((code[a], code[member]))), pa.array([*code[b].tolist(), *[None] * len(member)], pa.int64()),
            pa.array([*none, *run[member].tolist()], pa.int64()), pa.array([*none, *n[member].tolist()], pa.int32()),
            pa.array([*none, *at[member].tolist()], pa.int32()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["a", "b", "run", "n", "at"])

    return by_group(rows, ["run"], ["code", "n", "at"], work, "a long, b long, run long, n int, at int")


def centre_pairs(rows: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) of members of very long lists with the centres of their list, which an aggregate finds."""
    num, den = similar
    part = F.pmod(F.xxhash64("code"), F.lit(CENTRES))
    centres = rows.groupBy("run").agg(
        *[F.min(F.when(part == k, F.struct("code", "n", "at"))).alias(f"c{k}") for k in range(CENTRES)]
    )
    found = lookup_join(rows, stored_lookup(centres, "centres"), ["run"])
    found = found.withColumn("c", F.explode(F.array(*[f"c{k}" for k in range(CENTRES)]))).where("c.code != code")
    shared = F.least(F.col("n") - F.col("at"), F.col("c.n") - F.col("c.at"))
    found = found.where((num + den) * shared.cast("long") >= num * (F.col("n") + F.col("c.n")).cast("long"))
    return found.select(F.least("code", "c.code").alias("a"), F.greatest("code", "c.code").alias("b")).distinct()


def size_class(n: Column, similar: tuple[int, int]) -> Column:
    num, den = similar
    return n.cast("int") if num == den else F.floor(F.log(n) / math.log(den / num)).cast("int")


def dealt_members(members: DataFrame, similar: tuple[int, int], block: int) -> DataFrame:
    """Members of long lists by run, cell of set sizes and pair of blocks (s, l), as the smaller or the larger set of a pair.

    `most` is the largest set that can be similar to a member if this run is the first they share.
    Cells in which no two members can be a pair that still matters are left out. A sketch travels along if given.
    """
    num, den = similar
    also = ["sketch"] * ("sketch" in members.columns)
    rows = members.withColumn("most", F.expr(f"({num + den}L * (n - at)) div {num} - n"))
    rows = rows.select("run", "code", F.col("n").cast("long").alias("n"), "label", "most", *also)
    last = size_class(F.expr(f"(n * {den}) div {num}"), similar)
    small = rows.where("most >= n").withColumn("cell", F.explode(F.sequence(size_class(F.col("n"), similar), last)))
    large = rows.where(f"most * {den} >= n * {num}").withColumn("cell", size_class(F.col("n"), similar))
    both = small.withColumn("small", F.lit(True)).unionByName(large.withColumn("small", F.lit(False)))
    both = materialize(both, "members")
    n_small, n_large = F.count_if("small"), F.count_if(~F.col("small"))
    cells = both.groupBy("run", "cell").agg(
        n_small.alias("n_small"), n_large.alias("n_large"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    cells = cells.where("n_small > 0 and n_large > 0 and low < high").select(
        "run", "cell", F.ceil(F.col("n_small") / block).alias("of_s"), F.ceil(F.col("n_large") / block).alias("of_l")
    )
    found = lookup_join(both, stored_lookup(cells, "cells"), ["run", "cell"])

    def block_of(mine: Column, count: str) -> Column:
        own = F.array(F.pmod(F.xxhash64("code"), F.col(count)))
        return F.explode(F.when(mine, own).otherwise(F.sequence(F.lit(0).cast("long"), F.col(count) - 1)))

    found = found.withColumn("s", block_of(F.col("small"), "of_s")).withColumn("l", block_of(~F.col("small"), "of_l"))
    return found.select("run", "cell", "s", "l", "n", "code", "label", "most", "small", *also)


def other_pairs(members: DataFrame, similar: tuple[int, int], block: int = BLOCK, closest: int | None = None) -> DataFrame:
    """Pairs (a, b) of long lists whose sets can be similar, by size and any sketch, and that have different labels.

    With `closest`, each set is paired with only so many others of a block, those whose sketches differ least.
    """
    num, den = similar

    def batch_of(pairs: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        x, y = (np.concatenate([p[k] for p in pairs]) for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])

    def work(run, cell, s, l, n, code, label, most, small, bits=None):
        begins = starts([run, cell, s, l])
        pairs, held = [], 0
        for first, last in zip(begins.tolist(), [*begins[1:].tolist(), len(run)], strict=True):
            part = slice(first, last)
            left = first + np.flatnonzero(small[part])
            right = first + np.flatnonzero(small[part] == 0)
            low = np.searchsorted(n[left], -(-num * n[right] // den))
            high = np.searchsorted(n[left], np.minimum(n[right], most[right]), side="right")
            for i, at, end in zip(right.tolist(), low.tolist(), high.tolist(), strict=True):
                j = left[at:end]
                j = j[(label[j] != label[i]) & (most[j] >= n[i]) & ((n[j] < n[i]) | (code[j] < code[i]))]
                if bits is not None:
                    differ = np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1, dtype=np.int64)
                    near = (num + den) * differ <= (den - num) * (n[j] + n[i])
                    j, differ = j[near], differ[near]
                    if closest is not None and len(j) > closest:
                        j = j[np.argpartition(differ, closest - 1)[:closest]]
                if len(j):
                    pairs.append((code[j], np.full(len(j), code[i])))
                    held += len(j)
                if held >= PAIRS:
                    yield batch_of(pairs)
                    pairs, held = [], 0
        if pairs:
            yield batch_of(pairs)

    dealt = dealt_members(members, similar, block)
    order = dealt.columns[4:]
    return by_group(dealt, dealt.columns[:4], order, work, "a long, b long")


def plausible(pairs: DataFrame, codes: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) whose sketches differ in no more bits than similar sets can differ in runs."""
    num, den = similar

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(c.to_pylist()), np.uint64).reshape(len(c), -1) for c in batch.columns[2:4])
            bits = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
            both = batch.column(4).to_numpy().astype(np.int64) + batch.column(5).to_numpy()
            yield batch.select(["a", "b"]).filter(pa.array((num + den) * bits <= (den - num) * both))

    found = pairs.join(codes.select(F.col("code").alias("a"), F.col("sketch").alias("x"), F.col("n").alias("nx")), "a")
    found = found.join(codes.select(F.col("code").alias("b"), F.col("sketch").alias("y"), F.col("n").alias("ny")), "b")
    return found.select("a", "b", "x", "y", "nx", "ny").mapInArrow(run, "a long, b long")


def whole_sets(docs: DataFrame, text_col: str, pairs: DataFrame, codes: DataFrame, shingle: int) -> DataFrame:
    """(code, runs) of the sets in `pairs`; texts are read again, and only narrow rows are joined with them."""
    wanted = pairs.select(F.col("a").alias("code")).unionByName(pairs.select(F.col("b").alias("code"))).distinct()
    wanted, size = materialize_measured(wanted.join(codes, "code").select("code", "text_key"), "wanted")
    wanted = F.broadcast(wanted) if size <= BROADCAST_BYTES else wanted

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, batch in (part for rows in batches for part in by_bytes(rows, 1)):
            whole = pa.array([runs(t.as_py(), shingle).tobytes() for t in batch.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), whole], ["code", "runs"])

    texts = docs.select(F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text")).join(wanted, "text_key")
    found = texts.select("code", "text").mapInArrow(tidy(run), "code long, runs binary")
    return materialize(found.dropDuplicates(["code"]), "sets")


def checked(pairs: DataFrame, sets: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar."""
    num, den = similar

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, batch in (part for rows in batches for part in by_bytes(rows, 2)):
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(den * both >= num * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    found = pairs.join(sets.select(F.col("code").alias("a"), F.col("runs").alias("x")), "a")
    found = found.join(sets.select(F.col("code").alias("b"), F.col("runs").alias("y")), "b")
    return found.select("a", "b", "x", "y").mapInArrow(tidy(run), "a long, b long")


def similar_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    similar: tuple[int, int] = SIMILAR,
    long_list: int = LONG_LIST,
    hot: int = HOT,
    block: int = BLOCK,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per row of `docs`: doc_id and component_id, the smallest id reachable over pairs of texts
    whose sets of `shingle`-word runs have a Jaccard similarity of at least `similar` (num, den).

    Words are those of `simhash.fingerprint`; a shorter text is one run. All such pairs count, however
    many there are. Null ids count only where a component has no other. Texts without words are equal.
    `max_bits` is what the index searches; it, `long_list`, `hot` and `block` change how the work is dealt,
    never the result.
    """
    rows = materialize(first_runs(docs, id_col, text_col, shingle, similar, hot), "first-runs")
    codes = rows.groupBy("code").agg(
        F.min("id").alias("least"), F.min("text_key").alias("text_key"), F.min("n").alias("n"), F.min("fp").alias("fp"), F.min("sketch").alias("sketch")
    )
    codes = materialize(codes, "codes")
    lists = rows.select("code", "n", "hot_from", F.posexplode("first").alias("at", "run"))
    everywhere = lists.where("at >= hot_from").drop("hot_from")
    found = materialize(list_pairs(lists.where("at < hot_from"), similar, long_list), "list-pairs")
    members = found.where("b is null").select(F.col("a").alias("code"), "run", "n", "at")
    members = members.unionByName(everywhere.select("code", "run", "n", "at"))

    def similar_of(pairs: DataFrame) -> DataFrame:
        return materialize(checked(pairs, whole_sets(docs, text_col, pairs, codes, shingle), similar), "similar")

    def linked_of(pairs: DataFrame) -> DataFrame:
        return similar_of(materialize(plausible(pairs, codes, similar), "pairs"))

    def joined(labels: DataFrame | None, linked: DataFrame) -> DataFrame | None:
        if linked.isEmpty():
            return labels
        return connected_components(linked) if labels is None else joined_components(labels, linked)

    def others(labels: DataFrame | None, closest: int | None = None) -> DataFrame:
        own = F.col("code").alias("label")
        rows = members
        if labels is not None:
            rows = rows.join(labels.withColumnRenamed("v", "code"), "code", "left")
            own = F.coalesce("label", "code").alias("label")
        rows = rows.select("run", "code", "n", "at", own, "sketch")
        return similar_of(materialize(other_pairs(rows, similar, block, closest).distinct(), "pairs"))

    labels = joined(None, linked_of(index_pairs(codes, max_bits).distinct()))
    more = found.where(F.col("b").isNotNull()).select("a", "b").unionByName(centre_pairs(everywhere, similar))
    more = materialize(more.distinct(), "more-pairs")
    labels = joined(labels, linked_of(more if labels is None else apart(more, labels)))
    if not members.isEmpty():
        members = materialize(members.distinct().join(codes.select("code", "sketch"), "code"), "list-members")
        # Near copies find each other first, so that a group of them is one component before all its pairs would meet.
        labels = joined(labels, others(labels, CLOSEST))
        labels = joined(labels, others(labels))
    if labels is None:
        heads = codes.select("code", F.col("least").alias("component_id"))
    else:
        own = codes.join(labels.withColumnRenamed("v", "code"), "code", "left")
        own = own.select("code", F.coalesce("label", "code").alias("label"), "least")
        least = own.groupBy("label").agg(F.min("least").alias("component_id"))
        heads = materialize(own.select("code", "label").join(least, "label").select("code", "component_id"), "heads")
    return rows.select("id", "code").join(heads, "code").select(F.col("id").alias("doc_id"), "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs` with the smallest id of their component; rows without an id stay."""
    groups = similar_documents(docs, id_col, text_col, **options)
    heads = groups.where("doc_id = component_id").select(F.col("doc_id").alias("__head")).distinct()
    kept = docs.join(heads, F.col(id_col) == F.col("__head"), "left_semi")
    return kept.unionByName(docs.where(F.col(id_col).isNull()))

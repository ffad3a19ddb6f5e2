"""Ranked lexical search of many items without an index of the documents.

The terms of all items form one automaton. Each term is guarded by a space on both sides, and so are
the words of a text once everything that is no term character is a space, so the automaton finds
whole terms only, all of them in one pass over the text. Its outputs are term numbers; a list from
terms to items turns the counts of a document into scores. Every task keeps the best documents of
each item that it has seen, so what is shuffled does not grow with the documents of a task.

Items whose terms need more than `term_bytes` are dealt over several automata, each with a scan.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.texts import fold_table
from lexmill.session import materialize

# Term characters, and the order of upper and lower case letters.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM_BYTES = 2 << 20  # distinct terms of one automaton: some 50 bytes of memory each
PAIRS = 4 << 20  # (item, term) pairs of one automaton
WINDOW_BYTES = 1 << 20
DEPTH = 1024  # bytes of a term in the automaton
CELLS = 1 << 21  # scores or products that are held at once
FOLD = fold_table(b"0123456789")


def item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item, term) once each."""
    lower = F.translate(F.col(text_col), UPPER, LOWER)
    found = items.select(F.col(item_col).alias("item"), F.explode(F.regexp_extract_all(lower, F.lit(TERM), F.lit(0))).alias("term"))
    return found.distinct()


def dealt(pairs: DataFrame, term_bytes: int, max_pairs: int) -> tuple[DataFrame, list[int]]:
    """`pairs` with the number of its automaton, and the numbers in use; an item is in one of them."""
    size = F.sum(F.octet_length("term")).alias("bytes"), F.count(F.lit(1)).alias("n")
    most = pairs.groupBy("item").agg(*size).agg(F.max("bytes").alias("bytes"), F.max("n").alias("n")).first()
    term_bytes, max_pairs = max(term_bytes, most["bytes"] or 0), max(max_pairs, most["n"] or 0)
    parts = 1
    while True:
        placed = pairs.withColumn("part", F.pmod(F.xxhash64("item"), F.lit(parts)))
        each = placed.groupBy("part", "term").agg(F.count(F.lit(1)).alias("n"))
        each = each.groupBy("part").agg(F.sum(F.octet_length("term")).alias("bytes"), F.sum("n").alias("n"))
        large = each.where((F.col("bytes") > term_bytes) | (F.col("n") > max_pairs))
        if large.isEmpty():
            return placed, sorted(r["part"] for r in each.select("part").collect())
        parts *= 2


class Terms:
    """The terms of some items and, for each term, the items that have it."""

    def __init__(self, pairs: list[tuple]):
        self.items = sorted({i for i, _ in pairs}, key=lambda i: (i is None, i))
        self.terms = sorted({t for _, t in pairs})
        item_no = {x: n for n, x in enumerate(self.items)}
        term_no = {x: n for n, x in enumerate(self.terms)}
        t = np.array([term_no[t] for _, t in pairs], np.int64)
        order = np.argsort(t, kind="stable")
        self.of = np.array([item_no[i] for i, _ in pairs], np.int64)[order]
        self.start = np.searchsorted(t[order], np.arange(len(self.terms) + 1))


class Matcher:
    """All terms between spaces, as the bytes of their UTF-8; outputs are their numbers.

    Of a term longer than `DEPTH` bytes only the first ones are in the automaton, which is built
    recursively; the rest is compared where they are found.
    """

    def __init__(self, terms: list[str]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        self.long: dict[int, list[tuple[str, int]]] = {}
        heads: dict[str, int] = {}
        for n, term in enumerate(terms):
            key = f" {term.encode().decode('latin-1')} "
            if len(key) <= DEPTH:
                self.automaton.add_word(key, n)
            else:
                head = heads.setdefault(key[:DEPTH], -1 - len(heads))
                self.automaton.add_word(key[:DEPTH], head)
                self.long.setdefault(head, []).append((key, n))
        self.automaton.make_automaton()

    def matches(self, text: str) -> Iterator[int]:
        for end, n in self.automaton.iter(text):
            if n >= 0:
                yield n
            else:
                yield from (m for key, m in self.long[n] if text.startswith(key, end + 1 - DEPTH))

    def count(self, text: bytes | None) -> tuple[int, Counter]:
        """Terms of a text with repeats, and how often each term of the automaton occurs."""
        data = b" " + (text or b"").translate(FOLD) + b" "
        inside = np.frombuffer(data, np.uint8) != 32
        n = int(np.count_nonzero(inside[1:] & ~inside[:-1]))
        found: Counter = Counter()
        if n:
            for part in windows(data):
                part = part.decode("latin-1")
                found.update(self.matches(part) if self.long else (v for _, v in self.automaton.iter(part)))
        return n, found


def windows(data: bytes, size: int = WINDOW_BYTES) -> Iterator[bytes]:
    """`data`, which begins and ends with a space, in parts that share the spaces between them."""
    at = 0
    while len(data) - at > size:
        cut = data.rfind(b" ", at + 1, at + size)
        cut = cut if cut > 0 else data.find(b" ", at + size)
        if cut < 0 or cut == len(data) - 1:
            break
        yield data[at : cut + 1]
        at = cut
    yield data[at:]


def scanned(docs: DataFrame, id_col: str, text_col: str, terms: list[str]) -> DataFrame:
    """(doc_id, n, terms, tf) of each document that has a term of its own; `terms` and `tf` as arrays."""
    id_type = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value)
        for batch in batches:
            n, which, tf = [], [], []
            for text in batch.column(1):
                count, found = matcher.count(text.as_py())
                n.append(count)
                which.append(np.fromiter(found.keys(), np.int32, len(found)))
                tf.append(np.fromiter(found.values(), np.int64, len(found)))
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(which, pa.list_(pa.int32())), pa.array(tf, pa.list_(pa.int64()))],
                ["doc_id", "n", "terms", "tf"],
            )
            yield out.filter(pa.array(np.array(n, np.int64) > 0))

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary"))
    return rows.mapInArrow(run, f"doc_id {id_type}, n long, terms array<int>, tf array<long>")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_factor(n: int, n_docs: int, total: int) -> int:
    return 100 - 90 + (90 * n * n_docs) // total


class Best:
    """The k best documents of each item among those offered so far."""

    def __init__(self, n_items: int, k: int):
        self.k, self.kept, self.least = k, [[] for _ in range(n_items)], np.ones(n_items, np.int64)

    def offer(self, scores: np.ndarray, ids: list) -> None:
        """Scores as documents x items."""
        k = self.k
        least = self.least
        if len(scores) > k:  # no document below the k-th best of these can be among the best
            least = np.maximum(least, np.partition(scores, len(scores) - k, axis=0)[len(scores) - k])
        doc, item = np.nonzero(scores >= least)
        order = np.argsort(item, kind="stable")
        doc, item = doc[order], item[order]
        cuts = np.flatnonzero(np.diff(item)) + 1
        for rows in np.split(np.arange(len(item)), cuts) if len(item) else ():
            i = int(item[rows[0]])
            column = scores[doc[rows], i].tolist()
            new = [(-s, ids[d] is None, ids[d]) for s, d in zip(column, doc[rows].tolist(), strict=True)]
            self.kept[i] = sorted([*self.kept[i], *new], key=_order)[:k]
            if len(self.kept[i]) == k:
                self.least[i] = -self.kept[i][-1][0]


def _order(entry: tuple) -> tuple:
    return entry if not entry[1] else (entry[0], True)


def scores_of(items_of: tuple, n_items: int, weights: np.ndarray, n: np.ndarray, which: list, tf: list) -> np.ndarray:
    """Documents x items: sums of the weighted counts, in 64-bit integers. `n` holds length factors."""
    first, items = items_of
    lengths = np.array([len(w) for w in which], np.int64)
    doc = np.repeat(np.arange(len(which)), lengths)
    term = np.concatenate(which).astype(np.int64) if len(which) else np.zeros(0, np.int64)
    count = np.concatenate(tf) if len(tf) else np.zeros(0, np.int64)
    value = weights[term] * ((1_000_000_000 * count) // (1000 * count + 8 * n[doc]))
    fan = first[term + 1] - first[term]
    out = np.zeros(len(which) * n_items, np.int64)
    # Expand (document, term) into (document, item), some products at a time.
    upto = np.cumsum(fan)
    at = 0
    while at < len(term):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + CELLS, side="right")))
        f = fan[at:end]
        inner = np.arange(int(f.sum())) - np.repeat(np.cumsum(f) - f, f)
        item = items[np.repeat(first[term[at:end]], f) + inner]
        np.add.at(out, np.repeat(doc[at:end], f) * n_items + item, np.repeat(value[at:end], f))
        at = end
    return out.reshape(len(which), n_items)


def best_of(rows: DataFrame, terms: Terms, weights: np.ndarray, n_docs: int, total: int, k: int) -> DataFrame:
    """(item_no, doc_id, score): the k best of each item in each task."""
    id_type = rows.schema["doc_id"].dataType.simpleString()
    shared = rows.sparkSession.sparkContext.broadcast(((terms.start, terms.of), weights))
    n_items = len(terms.items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items_of, weights = shared.value
        best = Best(n_items, k)
        id_kind = pa.int64()
        step = max(1, CELLS // max(1, n_items))
        for batch in batches:
            id_kind = batch.schema.field(0).type
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                factors = np.array([length_factor(x, n_docs, total) for x in part.column(1).to_pylist()], np.int64)
                which = [x.values.to_numpy() for x in part.column(2)]
                tf = [x.values.to_numpy() for x in part.column(3)]
                best.offer(scores_of(items_of, n_items, weights, factors, which, tf), part.column(0).to_pylist())
        found = [(i, e[2], -e[0]) for i, kept in enumerate(best.kept) for e in kept]
        columns = [pa.array([x[j] for x in found], t) for j, t in enumerate((pa.int64(), id_kind, pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["item_no", "doc_id", "score"])

    return rows.mapInArrow(run, f"item_no long, doc_id {id_type}, score long")


def search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    k: int = 10,
    term_bytes: int = TERM_BYTES,
    max_pairs: int = PAIRS,
) -> DataFrame:
    """The k best documents of each item: item_id, rank (from 1), doc_id, score.

    Every row of `docs` is a document, repeated ones too. Rows of `items` with the same id, null
    included, are one item with the terms of them all. Texts without terms, null or empty, take no
    part on either side, and a score of 0 is no result. Equal scores are ordered by id, null last.
    Other columns are not looked at. An empty table on either side gives no rows. The terms of one
    item must fit into `term_bytes`, or its automaton is as large as they are.
    """
    spark = docs.sparkSession
    schema = f"item_id {items.schema[item_col].dataType.simpleString()}, rank int, doc_id {docs.schema[id_col].dataType.simpleString()}, score long"
    pairs, parts = dealt(materialize(item_terms(items, item_col, item_text_col), "item-terms"), term_bytes, max_pairs)
    found = spark.createDataFrame([], schema)
    for part in parts:
        # Bounded by `term_bytes` and `max_pairs`.
        own = [(r["item"], r["term"]) for r in pairs.where(F.col("part") == part).collect()]
        terms = Terms(own)
        rows = materialize(scanned(docs, id_col, text_col, terms.terms), "term-counts")
        facts = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("total")).first()
        if not facts["n"]:
            continue
        df = np.zeros(len(terms.terms), np.int64)
        for r in rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect():
            df[r["term"]] = r["n"]
        weights = np.array([weight(facts["n"], int(d)) for d in df], np.int64)
        local = best_of(rows, terms, weights, facts["n"], facts["total"], k)
        # A first round among the tasks of a share, so that no item's rows meet in one task at once.
        order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
        for keys in (["item_no", "share"], ["item_no"]):
            if "share" in keys:
                local = local.withColumn("share", F.pmod(F.spark_partition_id(), F.lit(64)))
            local = local.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
        names = spark.createDataFrame([(n, i) for n, i in enumerate(terms.items)], f"item_no long, {schema.split(',')[0]}")
        found = found.unionByName(local.join(names, "item_no").select("item_id", "rank", "doc_id", "score"))
    return found

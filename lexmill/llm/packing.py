"""Packing token sequences into as few fixed-size bins as possible.

A piece matters to the plan only by its length, so the plan is made from the number of pieces of
each length: at most `capacity` numbers, whatever the size of the data. Pieces above a third of the
capacity fit at most twice into a bin; they are matched greedily, the longest with the longest
partner that fits. Shorter ones then fill the remaining gaps, each the smallest gap that takes it.
Equal bins stay together as groups, so the plan's size depends on the capacity alone. A piece finds
its place from its rank among the pieces of its length.
"""

from __future__ import annotations

import bisect
import os
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Collection, Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.texts import by_bytes, tidy
from lexmill.session import materialize

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
# Memory for the words that a task remembers; it only saves encoding them again.
CACHED_BYTES = 64 << 20
ENTRY_BYTES = 200  # of a word and its ids, beside their contents
SLICE_CHARS = 1 << 20
SLICE_BYTES, SLICE_ROWS = 8 << 20, 4000  # texts whose words are learned together


# Trailing ASCII marks other than the apostrophe, after a letter or digit: always a piece of their own.
MARKS = frozenset(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")
MARKS_BEHIND = re.compile(rb"([^<|]*[a-z0-9])([!-&(-/:-@\[-`{-~]+)")

# How byte-level vocabularies write bytes: printable characters as they are, the rest from 256 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}


def _tokenizer(name: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs a task per core
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(name if "/" in name else public_tokenizers.path(name))


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case unless the text may name a special token."""
    data = text.encode("utf-8", "surrogatepass")
    return (data if b"<|" in data else data.lower()).split()


class WordEncoder(dict):
    """Ids of words as little-endian 32-bit bytes.

    The vocabulary lower-cases, splits at white space before anything else and drops it, so the ids
    of a text are those of its words one after another, and a word that ends in marks is the word
    and the marks. Letters that normalising leaves alone are one piece and go to the model directly.
    """

    def __init__(self, tokenizer):
        self.encode, self.merge, self.size = tokenizer.encode_batch_fast, tokenizer.model.tokenize, 0

    def add(self, words: set[bytes]) -> None:
        """Learn the words that are not known yet."""
        new = words.difference(self)
        if self.size > CACHED_BYTES:  # the words of this slice stay, the common ones among them
            stay = {w: self[w] for w in words.intersection(self)}
            self.clear()
            self.update(stay)
            self.size = self.bytes_of(stay)
        match = MARKS_BEHIND.fullmatch
        marked = {w: m.groups() for w in new if w[-1] in MARKS and (m := match(w))}
        plain = {p for pair in marked.values() for p in pair}.difference(self)
        plain.update(new.difference(marked) if marked else new)
        rest, merge = [], self.merge
        for p in plain:
            if p.isalpha() and p.islower():  # bytes: a-z
                self[p] = array("I", [t.id for t in merge(p.decode())]).tobytes()
                continue
            text = p.decode("utf-8", "replace")
            if text.isalpha() and text == text.lower() and is_normalized("NFC", text):
                tokens = self.merge(p.decode("latin-1").translate(BYTE_LETTERS))
                self[p] = array("I", [t.id for t in tokens]).tobytes()
            else:
                rest.append((p, text))
        for at in range(0, len(rest), 4096):
            part = rest[at : at + 4096]
            for (p, _), e in zip(part, self.encode([t for _, t in part], add_special_tokens=False), strict=True):
                self[p] = array("I", e.ids).tobytes()
        for w, (head, marks) in marked.items():
            self[w] = self[head] + self[marks]
        self.size += self.bytes_of(plain) + self.bytes_of(marked)

    def bytes_of(self, words: Collection[bytes]) -> int:
        return sum(map(len, words)) + sum(map(len, map(self.__getitem__, words))) + ENTRY_BYTES * len(words)

    def ids(self, words: list[bytes]) -> bytes:
        return b"".join(map(self.__getitem__, words))


def slices(text: str, size: int = SLICE_CHARS) -> Iterator[str]:
    """The text in parts that end at a space, so that a very long one is never held as words whole."""
    at = 0
    while len(text) - at > size:
        cut = max(text.rfind(c, at, at + size) for c in " \n\t\r")
        cut = cut if cut > at else min((p for c in " \n\t\r\x0b\x0c" if (p := text.find(c, at)) > at), default=len(text))
        yield text[at:cut]
        at = cut
    yield text[at:]


def ids_of_texts(texts: pa.Array, known: WordEncoder) -> list[bytes | None]:
    """Ids of each text; None for one that may name a special token or is long, which goes by `ids_in_parts`.

    Arrow splits the texts into words and numbers the distinct ones; only these are looked up, and
    their ids take the places of the words again.
    """
    apart = pc.or_(pc.match_substring(texts, "<|"), pc.greater(pc.binary_length(texts), SLICE_CHARS))
    apart = pc.fill_null(apart, False)
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.if_else(apart, "", pc.fill_null(texts, ""))))
    coded = split.flatten().dictionary_encode()
    words = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
    known.add(set(words) - {b""})  # between leading white space and the first word
    ids = pa.array([known[w] if w else b"" for w in words], pa.binary()).take(coded.indices)
    ends = np.frombuffer(ids.buffers()[1], np.int32, len(ids) + 1) if len(ids) else np.zeros(1, np.int32)
    last = ends[np.cumsum(pc.list_value_length(split).to_numpy())].tolist()
    data = memoryview(ids.buffers()[2] or b"")
    return [None if a else bytes(data[x:y]) for a, x, y in zip(apart.to_pylist(), [0, *last], last)]


def ids_in_parts(text: str, known: WordEncoder) -> Iterator[bytes]:
    """Ids of a text of any length, part by part."""
    for part in slices(text):
        words = words_of(part)
        known.add(set(words))
        yield known.ids(words)


def token_pieces(docs: DataFrame, id_col: str, text_col: str, capacity: int, tokenizer: str, with_ids: bool) -> DataFrame:
    """Pieces of at most `capacity` ids: doc_id, piece, start, length, ids_crc32[, ids].

    Every document ends with id 0; only longer ones are cut. A null text is empty.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordEncoder(_tokenizer(tokenizer))
        width = 4 * capacity
        for batch in batches:
            ids = batch.column(0)
            index, piece, start, length, crc, kept = [], [], [], [], [], []

            def put(i, data, n, at):
                index.append(i), piece.append(n), start.append(at // 4), length.append(len(data) // 4)
                crc.append(zlib.crc32(data))
                if with_ids:
                    kept.append(data)

            for first, some in by_bytes(batch, 1, SLICE_BYTES, SLICE_ROWS):
                texts = some.column(1)
                for i, whole in enumerate(ids_of_texts(texts, known)):
                    rest, n, at = b"", 0, 0
                    for part in [whole] if whole is not None else ids_in_parts(texts[i].as_py(), known):
                        rest += part
                        while len(rest) > width:  # the end is still to come, so a full piece is not the last
                            put(first + i, rest[:width], n, at)
                            rest, n, at = rest[width:], n + 1, at + width
                    rest += bytes(4)
                    while rest:
                        put(first + i, rest[:width], n, at)
                        rest, n, at = rest[width:], n + 1, at + width
                    if len(index) >= 20_000 or sum(map(len, kept)) > 1 << 24:
                        yield _piece_batch(ids, index, piece, start, length, crc, kept, with_ids)
                        for x in (index, piece, start, length, crc, kept):
                            x.clear()
            yield _piece_batch(ids, index, piece, start, length, crc, kept, with_ids)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(tidy(run), schema)


def _piece_batch(ids, index, piece, start, length, crc, kept, with_ids) -> pa.RecordBatch:
    columns = [
        ids.take(pa.array(index, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
        pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
    ]
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    if with_ids:
        columns.append(pa.array(kept, pa.binary()))
        names.append("ids")
    return pa.RecordBatch.from_arrays(columns, names)


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Groups of equal bins: (number of bins, [(length, times), ...]) for `counts` pieces of each length."""
    left = {n: c for n, c in counts.items() if c > 0}
    if any(n < 1 or n > capacity for n in left):
        raise ValueError("a piece must have between 1 and `capacity` tokens")
    gaps: dict[int, list[tuple[int, tuple]]] = defaultdict(list)
    large = sorted(n for n in left if 3 * n > capacity)
    while large:  # the longest, with the longest partner that fits
        n = large[-1]
        at = bisect.bisect_right(large, min(n, capacity - n)) - 1
        if at < 0:
            gaps[capacity - n].append((left[n], ((n, 1),)))
            left[n] = 0
        elif large[at] == n:
            pairs, single = divmod(left[n], 2)
            if pairs:
                gaps[capacity - 2 * n].append((pairs, ((n, 2),)))
            left[n] = single
            if single:  # its partner is the next shorter one, if there is any
                large.pop()
                if large:
                    m = large[-1]
                    gaps[capacity - n - m].append((1, ((n, 1), (m, 1))))
                    left[m] -= 1
                else:
                    gaps[capacity - n].append((1, ((n, 1),)))
                left[n] = 0
        else:
            m = large[at]
            bins = min(left[n], left[m])
            gaps[capacity - n - m].append((bins, ((n, 1), (m, 1))))
            left[n] -= bins
            left[m] -= bins
        large = [x for x in large if left[x] > 0]
    open_gaps = sorted(gaps)
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        more = left[n]
        while more:
            at = bisect.bisect_left(open_gaps, n)
            if at == len(open_gaps):  # no gap takes it
                each = capacity // n
                bins, odd = divmod(more, each)
                parts = [(bins, each), (1, odd)]
                gap, pattern, more = capacity, (), 0
            else:
                gap = open_gaps[at]
                bins, pattern = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
                    open_gaps.pop(at)
                each = gap // n
                full, odd = min(bins, more // each), 0
                if full < bins:
                    odd = more - full * each
                more -= full * each + odd
                parts = [(full, each), (1 if odd else 0, odd), (bins - full - bool(odd), 0)]
            for number, times in parts:
                if number and (times or pattern):
                    rest = gap - times * n
                    if rest not in gaps:
                        bisect.insort(open_gaps, rest)
                    gaps[rest].append((number, (*pattern, (n, times)) if times else pattern))
    return [(bins, list(pattern)) for gap in sorted(gaps) for bins, pattern in gaps[gap]]


def _slots(groups) -> dict[int, np.ndarray]:
    """For each length its runs of places: (first rank, first bin, places in a bin, offset of the first)."""
    runs, used, first = defaultdict(list), defaultdict(int), 0
    for bins, pattern in groups:
        offset = 0
        for n, times in pattern:
            runs[n].append((used[n], first, times, offset))
            used[n] += bins * times
            offset += n * times
        first += bins
    return {n: np.array(r, np.int64) for n, r in runs.items()}


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    tokenizer: str = TOKENIZER,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids].

    Texts are tokenised once; the pieces go to the shared folder, are counted by length, and get
    their places. Repeated rows are packed like any others, a null or empty text is a piece of one
    id, and an empty table gives no rows. `tokenizer` names a public vocabulary or a file that every
    executor can open.
    """
    pieces = materialize(token_pieces(docs, id_col, text_col, capacity, tokenizer, with_ids), "pieces")
    spark = docs.sparkSession
    # At most `capacity` rows.
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    slots = _slots(plan_bins(counts, capacity))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    # A part of the pieces is ranked in one task; a part holds at most some 250,000.
    parts = max(tasks, total // 250_000)
    dealt = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = dealt.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")).select(
        "part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    within = Window.partitionBy("part", "length").orderBy("doc_id", "piece", "ids_crc32")
    ranked = dealt.withColumn("nth", F.row_number().over(within) - 1).join(base, ["part", "length"])
    ranked = ranked.withColumn("nth", F.col("nth") + F.col("base")).drop("part", "base")
    names = [c for c in ranked.columns if c not in ("length", "nth")]
    ranked = ranked.select("length", "nth", *names)
    kinds = {f.name: f.dataType.simpleString() for f in ranked.schema.fields}
    schema = ", ".join(f"{c} {kinds[c]}" for c in ["length", *names]) + ", sequence_id long, offset long"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, nth = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            bins, offsets = np.zeros(len(nth), np.int64), np.zeros(len(nth), np.int64)
            order = np.argsort(lengths, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
                if len(rows):
                    n = int(lengths[rows[0]])
                    runs = slots[n]
                    run = runs[np.searchsorted(runs[:, 0], nth[rows], side="right") - 1]
                    inside = nth[rows] - run[:, 0]
                    bins[rows] = run[:, 1] + inside // run[:, 2]
                    offsets[rows] = run[:, 3] + inside % run[:, 2] * n
            columns = [batch.column(0), *[batch.column(i + 2) for i in range(len(names))]]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(bins), pa.array(offsets)], ["length", *names, "sequence_id", "offset"]
            )

    placed = ranked.mapInArrow(place, schema)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *["ids"] * with_ids)


def sequences(packed: DataFrame) -> DataFrame:
    """Ids of each packed sequence, from `pack(with_ids=True)`: sequence_id, length, ids.

    A sequence has at most `capacity` pieces, so a group is bounded.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda acc, p: F.concat(acc, p["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))

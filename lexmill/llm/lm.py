"""Language-model scores from a lattice of all segmentations of a text.

A text is a sequence of words and one end. A word may be read as a whole, with the count it has in
the training texts, or as any sequence of pieces of an existing subword vocabulary; its probability
is the sum over all readings, and a text's is the product over its tokens, so all segmentations of
the text count. The sum runs forward over the word's bytes in log space. Whole words give up a fixed
discount each; that mass belongs to the pieces, which start from the order of the vocabulary and
are weighted by expected counts over all distinct training words.

Scores are kept for each class of texts (the languages of the training texts). Which class a text
belongs to is one more open choice: its probability is the sum over the classes, at their shares.

Tokens meet corpus counts block by block. A block of documents keeps who uses which word how often,
and asks for each of its words once; words are dealt over parts by hash, and a block and a part share
one packed row. A part adds up the counts of all blocks, scores each distinct word once, and answers
every block in one row. A frequent word is one entry per block, and the number of parts grows with the
bytes of the texts, so no task holds more than its share.
"""

from __future__ import annotations

import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.session import materialize

VOCABULARY = "piece_bpe_32k.model"
BLOCK_BYTES = 16 << 20
BLOCK_DOCS = 20_000
PART_BYTES = 256 << 20
# Words of at least LONG bytes are cut into stretches, which are the rows of one pass.
LONG, STRETCH, STRETCHES_AT_ONCE = 1024, 128, 256
CELLS_AT_ONCE = 1 << 21
SLOTS = 18
BASE = np.uint64(0x100000001B3)
TURN = np.uint64(0x9E3779B97F4A7C15)
# Shares of the discounts' mass: for words as counted in any class, and for an end that no training text has.
ANYWHERE, END_SHARE = 0.1, 0.01
LN10 = float(np.log(10))


def vocabulary(path: str = VOCABULARY) -> tuple[list[bytes], list[bytes]]:
    """Pieces that begin a word, and pieces within one, in the order of the vocabulary's scores."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path if "/" in path else public_tokenizers.path(path))
    order = sorted(range(model.vocab_size()), key=lambda i: (-model.get_score(i), i))
    first, inner = [], []
    for i in order:
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i):
            continue
        piece = model.id_to_piece(i)
        body = piece.removeprefix("▁")
        if not body or "▁" in body or body != body.lower():
            continue  # nothing left, more than one word, or not in a lower-cased text
        (first if piece != body else inner).append(body.encode())
    return first, inner


def _hash(data: np.ndarray) -> np.ndarray:
    """Running hashes of the rows of a byte matrix: column j covers the first j bytes."""
    out = np.zeros((data.shape[0], data.shape[1] + 1), np.uint64)
    for j in range(data.shape[1]):
        out[:, j + 1] = out[:, j] * BASE + data[:, j] + np.uint64(1)
    return out


class PieceTable:
    """Numbers of pieces by hash: as many slot tables as it takes for every piece to have a slot.

    It travels to the tasks as its list of pieces and is built there.
    """

    def __init__(self, pieces: list[bytes]):
        known = list(dict.fromkeys([*(bytes([b]) for b in range(256)), *pieces]))
        self.pieces, self.longest = known, max(map(len, known))
        self.hashes = np.zeros(len(known), np.uint64)
        for rows, data in by_length(known):
            self.hashes[rows] = _hash(data)[:, -1]
        if len(np.unique(self.hashes)) != len(known):
            raise ValueError("two pieces share a hash")
        self.tables, left = [], np.arange(len(known))
        while len(left):
            slot = (self.hashes[left] * (TURN + np.uint64(2 * len(self.tables)))) >> np.uint64(64 - SLOTS)
            _, at = np.unique(slot, return_index=True)
            table = np.full(1 << SLOTS, -1, np.int32)
            table[slot[at]] = left[at]
            self.tables.append(table)
            left = np.delete(left, at)

    def __reduce__(self):
        return PieceTable, (self.pieces[256:],)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of the piece with each hash, or the number of pieces where there is none."""
        out = np.full(hashes.shape, len(self.pieces), np.int32)
        for i, table in enumerate(self.tables):
            got = table[(hashes * (TURN + np.uint64(2 * i))) >> np.uint64(64 - SLOTS)]
            hit = (got >= 0) & (self.hashes[got] == hashes)
            out[hit] = got[hit]
        return out


Weights = tuple[np.ndarray, np.ndarray]  # logs: pieces that begin a word, pieces within with the stop last


@dataclass
class Lattice:
    """Piece vocabulary with log weights for each class."""

    first: PieceTable
    inner: PieceTable
    weights: list[Weights]

    @classmethod
    def of(cls, first: list[bytes], inner: list[bytes], classes: int = 1) -> Lattice:
        tables = PieceTable(first), PieceTable(inner)
        # The vocabulary's order is all its scores say: weights fall with rank, bytes are rarest.
        starts = [np.concatenate((np.full(256, 0.1 / len(t.pieces)), 1 / (100.0 + np.arange(len(t.pieces) - 256)))) for t in tables]
        return cls(*tables, [cls.normal(starts[0], np.append(starts[1], starts[1].sum() / 2))] * classes)

    @staticmethod
    def normal(first: np.ndarray, inner: np.ndarray) -> Weights:
        return np.log(first / first.sum()), np.log(inner / inner.sum())

    def numbers(self, data: np.ndarray) -> list[np.ndarray]:
        """For each piece length the piece that begins at each byte, for words of one length (rows)."""
        size = data.shape[1]
        hashes = _hash(data)
        out = []
        for length in range(1, min(size, max(self.first.longest, self.inner.longest)) + 1):
            power = np.uint64(pow(int(BASE), length, 1 << 64))
            part = hashes[:, length:] - hashes[:, : size + 1 - length] * power
            found = np.empty(part.shape, np.int32)
            found[:, 0] = self.first.find(part[:, 0])
            found[:, 1:] = self.inner.find(part[:, 1:])
            out.append(found)
        return out

    @staticmethod
    def values(numbers: list[np.ndarray], weights: Weights) -> list[np.ndarray]:
        """Log weights of the pieces in `numbers`; minus infinity where there is none."""
        first, inner = np.append(weights[0], -np.inf), np.append(weights[1][:-1], -np.inf)
        return [np.concatenate((first[n[:, :1]], inner[n[:, 1:]]), axis=1) for n in numbers]

    @staticmethod
    def forward(values: list[np.ndarray]) -> np.ndarray:
        """Log probability of all readings of the first j bytes, by j."""
        n, size = values[0].shape
        alpha = np.full((n, size + 1), -np.inf)
        alpha[:, 0] = 0
        for j in range(1, size + 1):
            alpha[:, j] = _log_sum(np.stack([alpha[:, j - m] + values[m - 1][:, j - m] for m in range(1, min(j, len(values)) + 1)]))
        return alpha

    def log_probability(self, data: np.ndarray) -> np.ndarray:
        """Marginal natural-log probability, by class, of words of one length given as a byte matrix."""
        stops = np.array([w[1][-1] for w in self.weights])
        if data.shape[1] >= LONG:
            return np.stack([self._boundaries(row, range(len(self.weights)))[-1][:, -1] + stops for row in data])
        numbers = self.numbers(data)
        return np.stack([self.forward(self.values(numbers, w))[:, -1] for w in self.weights], axis=1) + stops

    def expected(self, data: np.ndarray, k: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Expected uses of first pieces, inner pieces and the stop, over all readings of words of class k."""
        n, size = data.shape
        if size >= LONG:
            first, inner = (sum(x) for x in zip(*(self._expected_long(row, k) for row in data), strict=True))
        else:
            leave = np.full((n, size + 1), -np.inf)
            leave[:, size] = self.weights[k][1][-1]
            first, inner = self._uses(data, leave, k)
        inner[-2] = n  # the number after the last piece means none and has no share; every word stops once
        return first[:-1], inner[:-1]

    def _uses(self, data: np.ndarray, leave: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Expected uses of pieces within `data`, where `leave` are the logs of what may follow after j bytes."""
        size = data.shape[1]
        numbers = self.numbers(data)
        values = self.values(numbers, self.weights[k])
        alpha, beta = self.forward(values), leave.copy()
        for i in range(size - 1, -1, -1):
            within = [values[m - 1][:, i] + beta[:, i + m] for m in range(1, min(size - i, len(values)) + 1)]
            beta[:, i] = _log_sum(np.stack([leave[:, i], *within]))
        first, inner = (np.zeros(len(w) + 1) for w in self.weights[k])
        for m, (found, value) in enumerate(zip(numbers, values, strict=True), 1):
            share = np.exp(alpha[:, : size + 1 - m] + value + beta[:, m:] - beta[:, :1])
            first += np.bincount(found[:, 0], share[:, 0], len(first))
            inner += np.bincount(found[:, 1:].ravel(), share[:, 1:].ravel(), len(inner))
        return first, inner

    # A long word is a head and stretches after it. The recursion reaches back `reach` bytes, so all that a
    # stretch needs to know of what came before are the sums at the last `reach` places, and what it makes
    # of each of them is a small matrix. The matrices of all stretches are found side by side.

    def _stretches(self, row: np.ndarray) -> tuple[int, list[np.ndarray]]:
        """Length of the head, and portions of the stretches after it, each row with the `reach` bytes before."""
        reach = self.inner.longest
        size = max(STRETCH, reach, self.first.longest)
        head = len(row) - size * (len(row) // size - 1)
        view = np.lib.stride_tricks.sliding_window_view(row, reach + size)[head - reach :: size]
        return head, [view[i : i + STRETCHES_AT_ONCE] for i in range(0, len(view), STRETCHES_AT_ONCE)]

    def _ending(self, data: np.ndarray) -> np.ndarray:
        """The piece that ends with byte j of each stretch and is `reach` - i bytes long, by (stretch, j, i)."""
        reach = self.inner.longest
        hashes, size = _hash(data), data.shape[1] - reach
        out = np.empty((len(data), size, reach), np.int32)
        for m in range(1, reach + 1):
            power = np.uint64(pow(int(BASE), m, 1 << 64))
            at = reach + 1 - m
            out[:, :, reach - m] = self.inner.find(hashes[:, reach + 1 :] - hashes[:, at : at + size] * power)
        return out

    def _logs(self, numbers: np.ndarray, k: int) -> np.ndarray:
        return np.append(self.weights[k][1][:-1], -np.inf)[numbers]

    @staticmethod
    def _transfer(logs: np.ndarray) -> np.ndarray:
        """Log of what each place before a stretch adds to each of its last places, by (stretch, from, to)."""
        n, size, reach = logs.shape
        weights = np.exp(logs)
        sums = np.zeros((n, reach + size, reach))  # (stretch, to, from)
        sums[:, range(reach), range(reach)] = 1
        scale = np.zeros(n)
        for j in range(size):
            sums[:, reach + j] = (weights[:, j, None, :] @ sums[:, j : j + reach])[:, 0]
            if j % 4 == 3 or j == size - 1:  # often enough for weights of 1e-50; a single byte always has one
                top = sums[:, reach + j].max(axis=1)
                sums[:, j + 1 : reach + j + 1] /= top[:, None, None]
                scale += np.log(top)
        with np.errstate(divide="ignore"):
            return np.log(sums[:, size:]).transpose(0, 2, 1) + scale[:, None, None]

    def _boundaries(self, row: np.ndarray, classes: Sequence[int]) -> list[np.ndarray]:
        """Log sums at the last `reach` places of the head and of each stretch, one row for each class."""
        head, portions = self._stretches(row)
        start = self.numbers(row[None, :head])
        out = [np.concatenate([self.forward(self.values(start, self.weights[k]))[:, -self.inner.longest :] for k in classes])]
        for data in portions:
            numbers = self._ending(data)
            steps = np.stack([self._transfer(self._logs(numbers, k)) for k in classes], axis=2)
            for step in steps:  # (from, class, to)
                out.append(_log_sum(out[-1].T[:, :, None] + step))
        return out

    def _expected_long(self, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """`_uses` of one long word: stretches from the last to the first, then the head."""
        reach = self.inner.longest
        head, portions = self._stretches(row)
        before = np.concatenate(self._boundaries(row, [k]))
        stop = self.weights[k][1][-1]
        after = np.append(np.full(reach - 1, -np.inf), stop)  # logs of what follows beyond a stretch, by its last places
        total, inner = before[-1, -1] + stop, np.zeros(len(self.weights[k][1]) + 1)
        at = len(before) - 1
        for data in reversed(portions):
            numbers = self._ending(data)
            logs = self._logs(numbers, k)
            n, size = logs.shape[:2]
            at -= n
            leave = np.full((n, size), -np.inf)
            for i, step in reversed(list(enumerate(self._transfer(logs)))):
                leave[i, -reach:] = after
                after = _log_sum((step + after).T)
            alpha = np.concatenate((before[at : at + n], np.empty((n, size))), axis=1)
            for j in range(size):
                alpha[:, reach + j] = _log_sum((alpha[:, j : j + reach] + logs[:, j]).T)
            beta = leave.copy()
            for j in range(size - 2, -1, -1):
                m = np.arange(1, min(reach, size - 1 - j) + 1)
                within = logs[:, j + m, reach - m] + beta[:, j + m]
                beta[:, j] = _log_sum(np.concatenate((leave[:, j : j + 1], within), axis=1).T)
            begins = np.lib.stride_tricks.sliding_window_view(alpha, reach, axis=1)[:, :size]
            share = np.exp(begins + logs + beta[:, :, None] - total)
            inner += np.bincount(numbers.ravel(), share.ravel(), len(inner))
        leave = np.full((1, head + 1), -np.inf)
        leave[0, -reach:] = after
        first, more = self._uses(row[None, :head], leave, k)
        return first, inner + more


def _log_sum(terms: np.ndarray) -> np.ndarray:
    top = terms.max(axis=0)
    safe = np.where(np.isfinite(top), top, 0)
    with np.errstate(divide="ignore"):
        return safe + np.log(np.exp(terms - safe).sum(axis=0))


def by_length(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, byte matrix) of words of equal length, in bounded portions."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    for same in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
        if len(same):
            size = int(lengths[same[0]])
            step = max(1, CELLS_AT_ONCE // (16 * size))
            for at in range(0, len(same), step):
                rows = same[at : at + step]
                yield rows, np.frombuffer(b"".join([words[i] for i in rows]), np.uint8).reshape(len(rows), size)


def pack(array: np.ndarray | list[bytes], kind: str = "") -> bytes:
    """Numbers, or words (which hold no space), as compressed bytes."""
    return zlib.compress(b" ".join(array) if isinstance(array, list) else array.astype(kind).tobytes(), 1)


def unpack_words(data: bytes) -> list[bytes]:
    return zlib.decompress(data).split(b" ")


def unpack(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), kind)


def token_blocks(
    docs: DataFrame, id_col: str, text_col: str, held: Column, kind: Column, classes: int, parts: int
) -> DataFrame:
    """Blocks of documents: a row per document (block, doc, id, held, n_tokens), and a row per part of the
    words (block, part, words, counts by class in training documents, postings); there `doc` is null."""
    id_type = docs.schema[id_col].dataType.simpleString()
    columns = {
        "block": ("long", pa.int64()), "doc": ("int", pa.int32()), "id": (id_type, None), "held": ("boolean", pa.bool_()),
        "n_tokens": ("long", pa.int64()), "kind": ("int", pa.int32()), "part": ("int", pa.int32()),
        "words": ("binary", pa.binary()), "counts": ("binary", pa.binary()), "postings": ("binary", pa.binary()),
    }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, at, size = [], 0, 0
            for i, value in enumerate(batch.column(1)):
                texts.append((value.as_py() or "").encode("utf-8", "surrogatepass").lower().split())
                size += sum(map(len, texts[-1])) + len(texts[-1])
                if size >= BLOCK_BYTES or len(texts) >= BLOCK_DOCS or i == batch.num_rows - 1:
                    yield from block(batch.slice(at, len(texts)), texts)
                    texts, at, size = [], i + 1, 0

    def block(batch, texts):
        # Written once to a table, so a random name is as good as any.
        name, n = uuid.uuid4().int >> 65, len(texts)
        held = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
        kind = batch.column(3).to_numpy()
        sizes = np.fromiter(map(len, texts), np.int64, n)
        yield make(n, batch, block=[name] * n, doc=np.arange(n), id=batch.column(0), held=held, n_tokens=sizes + 1, kind=kind)
        number = defaultdict(count().__next__)
        words = np.fromiter((number[w] for words in texts for w in words), np.int64, int(sizes.sum()))
        known = list(number)
        if not known:
            return
        # Numbers in the order of (part, word): neighbours pack well, and a part is one slice.
        part = np.fromiter((zlib.crc32(w) % parts for w in known), np.int64, len(known))
        order = sorted(range(len(known)), key=lambda i: (part[i], known[i]))
        place = np.empty(len(known), np.int64)
        place[order] = np.arange(len(known))
        pairs, uses = np.unique(place[words] * n + np.repeat(np.arange(n), sizes), return_counts=True)
        word, doc = pairs // n, pairs % n
        trained = np.bincount(word * classes + kind[doc], uses * ~held[doc], len(known) * classes).reshape(-1, classes)
        first = np.append(np.flatnonzero(np.diff(word, prepend=-1)), len(word))
        part = part[order]
        cuts = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
        rows = {c: [] for c in ("block", "part", "words", "counts", "postings")}
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            x, y = first[a], first[b]
            postings = [np.diff(first[a : b + 1]), doc[x:y], uses[x:y]]
            rows["block"].append(name)
            rows["part"].append(part[a])
            rows["words"].append(pack([known[i] for i in order[a:b]]))
            rows["counts"].append(pack(trained[a:b].ravel(), "<i4"))
            rows["postings"].append(pack(np.concatenate(postings), "<i4"))
        yield make(len(rows["part"]), batch, **rows)

    def make(n, batch, **given):
        kinds = {c: kind or batch.column(0).type for c, (_, kind) in columns.items()}
        arrays = [
            pa.nulls(n, kind) if (x := given.get(c)) is None else x if isinstance(x, pa.Array) else pa.array(x, kind)
            for c, kind in kinds.items()
        ]
        return pa.RecordBatch.from_arrays(arrays, list(columns))

    rows = docs.select(F.col(id_col), F.col(text_col), F.coalesce(held, F.lit(False)).alias("held"), kind.alias("kind"))
    return rows.mapInArrow(run, ", ".join(f"{c} {kind}" for c, (kind, _) in columns.items()))


FACTS = ("tokens", "seen", "once", "twice")


def word_counts(asked: DataFrame, classes: int) -> DataFrame:
    """Words of each part with their training counts over all blocks: part, words, counts, n, and sums by class."""
    schema = "part int, words binary, counts binary, n long, known long, " + ", ".join(f"{x} array<long>" for x in FACTS)

    def add(table: pa.Table) -> pa.Table:
        number = defaultdict(count().__next__)
        sums = np.zeros((0, classes), np.int64)
        for words, counts in zip(table["words"].to_pylist(), table["counts"].to_pylist(), strict=True):
            rows = np.array([number[w] for w in unpack_words(words)])
            if len(number) > len(sums):
                sums = np.concatenate((sums, np.zeros((2 * len(number) - len(sums), classes), np.int64)))
            sums[rows] += unpack(counts, "<i4").reshape(-1, classes)  # a block names a word once
        sums = sums[: len(number)]
        facts = [sums.sum(axis=0), (sums > 0).sum(axis=0), (sums == 1).sum(axis=0), (sums == 2).sum(axis=0)]
        values = [table["part"][0].as_py(), pack(list(number)), pack(sums.ravel(), "<i8"), len(number), int((sums.sum(axis=1) > 0).sum())]
        kinds = [pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64()] + [pa.list_(pa.int64())] * 4
        return pa.table(
            [pa.array([v], k) for v, k in zip([*values, *(f.tolist() for f in facts)], kinds, strict=True)],
            names=["part", "words", "counts", "n", "known", *FACTS],
        )

    return asked.select("part", "words", "counts").groupBy("part").applyInArrow(add, schema)


def fit_pieces(words: DataFrame, lattice: Lattice, rounds: int) -> Lattice:
    """Weights from expected counts over all distinct training words of each class, once per round."""
    classes = len(lattice.weights)
    n_first, n_inner = map(len, lattice.weights[0])
    for _ in range(rounds):

        def run(batches: Iterator[pa.RecordBatch], lattice=lattice) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((classes, n_first + n_inner))
            for batch in batches:
                for packed, counts in zip(batch.column(0), batch.column(1), strict=True):
                    known = unpack_words(packed.as_py())
                    c = unpack(counts.as_py(), "<i8").reshape(-1, classes)
                    for k in range(classes):
                        for _, data in by_length([known[i] for i in np.flatnonzero(c[:, k] > 0)]):
                            sums[k] += np.concatenate(lattice.expected(data, k))
            used = np.flatnonzero(sums.ravel())
            yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(sums.ravel()[used])], ["piece", "n"])

        sums = words.select("words", "counts").mapInArrow(run, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n"))
        counts = np.zeros(classes * (n_first + n_inner))
        for r in sums.collect():  # at most a row for each piece of the vocabulary and class
            counts[r["piece"]] = r["n"]
        counts = counts.reshape(classes, -1)
        weights = [Lattice.normal(c[:n_first] + 0.01, c[n_first:] + 0.01) if c.any() else w for c, w in zip(counts, lattice.weights, strict=True)]
        lattice = Lattice(lattice.first, lattice.inner, weights)
    return lattice


@dataclass
class TokenModel:
    """Natural-log probabilities of tokens in each class, from counts (rows by class) and pieces."""

    total: np.ndarray  # training tokens by class, ends among them
    distinct: np.ndarray
    discount: np.ndarray
    ends: np.ndarray

    def tokens(self, c: np.ndarray, pieces: np.ndarray) -> np.ndarray:
        """The whole word in its class, the whole word anywhere, or pieces; `pieces` are logs."""
        escape = (self.discount * self.distinct + 1) / (self.total + 1)
        with np.errstate(divide="ignore"):
            own = np.log(np.maximum(c - self.discount, 0) / (self.total + 1))
            anywhere = np.log(escape * ANYWHERE * c.sum(axis=1, keepdims=True) / max(self.total.sum(), 1))
        spelled = np.log(escape * (1 - ANYWHERE - END_SHARE)) + pieces
        return np.logaddexp(np.logaddexp(own, anywhere), spelled)

    def end(self) -> np.ndarray:
        escape = (self.discount * self.distinct + 1) / (self.total + 1)
        anywhere = ANYWHERE * self.ends.sum() / max(self.total.sum(), 1)
        return np.log(np.maximum(self.ends - self.discount, 0) / (self.total + 1) + escape * (anywhere + END_SHARE))

    def shares(self) -> np.ndarray:
        return np.log((self.ends + 1) / (self.ends + 1).sum())


def lattice_scores(
    docs: DataFrame,
    held: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    class_col: str | None = None,
    vocabulary_file: str = VOCABULARY,
    rounds: int = 3,
    max_classes: int = 8,
) -> DataFrame:
    """One row per row of `docs`: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows where `held` is not true and scores all, by their texts alone. Words are
    what ASCII white space separates, with A-Z lower-cased; every text ends with one end token.
    `base_score` is the sum of log10((c + 1) / (N + V + 1)); `score` the log10 probability of the
    text under the lattice. `class_col` tells classes of training texts apart: the `max_classes` most
    frequent values, and one class for all others and null. Null and empty texts are an end alone;
    repeated rows count and are scored each; without training rows the pieces keep the weights of the
    vocabulary's order. An empty table gives no rows.
    """
    held = F.coalesce(held, F.lit(False))
    names, label, others = [], F.lit(None).cast("string"), True
    if class_col:  # bounded: max_classes rows and one
        label = F.col(class_col).cast("string")
        sizes = docs.where(~held).groupBy(label.alias("k")).count()
        named = sizes.where("k is not null").orderBy(F.col("count").desc(), "k").limit(max_classes).collect()
        names = [r["k"] for r in named]
        others = not names or sizes.agg(F.sum("count")).first()[0] > sum(r["count"] for r in named)
    classes = len(names) + bool(others)
    place = F.array_position(F.array(*[F.lit(n) for n in names]), label) if names else F.lit(0)
    kind = F.coalesce(F.when(place > 0, place - 1), F.lit(classes - 1)).cast("int")
    spark = docs.sparkSession
    size = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text_col))), F.lit(0))).first()[0]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism, -(-size // PART_BYTES))
    blocks = materialize(token_blocks(docs, id_col, text_col, held, kind, classes, parts), "blocks")
    asked = blocks.where("doc is null")
    words = materialize(word_counts(asked, classes), "words")
    sums = [F.coalesce(F.sum(F.get(x, F.lit(k))), F.lit(0)).alias(f"{x}{k}") for x in FACTS for k in range(classes)]
    facts = words.agg(F.coalesce(F.sum("known"), F.lit(0)).alias("known"), *sums).first()
    tokens, seen, once, twice = (np.array([facts[f"{x}{k}"] for k in range(classes)], float) for x in FACTS)
    ends = np.zeros(classes)
    for r in blocks.where("doc is not null and not held").groupBy("kind").count().collect():  # a row per class
        ends[r["kind"]] = r["count"]
    discount = np.where(once > 0, once / np.maximum(once + 2 * twice, 1), 0.5)
    model = TokenModel(tokens + ends, seen + (ends > 0), discount, ends)
    total, distinct = int(model.total.sum()), facts["known"] + int(ends.any())
    lattice = fit_pieces(words, Lattice.of(*vocabulary(vocabulary_file), classes), rounds)

    def answer(asks: pa.Table, own: pa.Table) -> pa.Table:
        """Counts and values of the words of each block, in the block's order; single precision on the way."""
        out = []
        if own.num_rows:
            known = unpack_words(own["words"][0].as_py())
            c = unpack(own["counts"][0].as_py(), "<i8").reshape(-1, classes)
            pieces = np.empty((len(known), classes))
            for rows, data in by_length(known):
                pieces[rows] = lattice.log_probability(data)
            values, number = model.tokens(c, pieces), {w: i for i, w in enumerate(known)}
            c = c.sum(axis=1)
            for block, part, asked_words in zip(asks["block"].to_pylist(), asks["part"].to_pylist(), asks["words"].to_pylist(), strict=True):
                rows = np.array([number[w] for w in unpack_words(asked_words)])
                out.append((block, part, pack(c[rows], "<i8"), pack(values[rows].ravel(), "<f4")))
        columns = list(zip(*out, strict=True)) if out else [()] * 4
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["block", "part", "found", "values"])

    questions = asked.select("block", "part", "words").groupBy("part")
    answers = questions.cogroup(words.select("part", "words", "counts").groupBy("part"))
    answers = answers.applyInArrow(answer, "block long, part int, found binary, values binary")
    heads = blocks.select("block", "doc", "id", "held", "n_tokens", "part", "postings")
    both = heads.unionByName(answers, allowMissingColumns=True)
    end_base = np.log10((int(ends.sum()) + 1) / (total + distinct + 1))

    def fold(table: pa.Table) -> pa.Table:
        docs_part = table.filter(pa.compute.is_valid(table["doc"]))
        n = docs_part.num_rows
        base, known = np.full(n, end_base), np.full(n, int(ends.any()), np.int64)
        value = np.tile(model.end() + model.shares(), (n, 1))
        used = table.filter(pa.compute.is_valid(table["postings"]))
        postings = dict(zip(used["part"].to_pylist(), used["postings"].to_pylist(), strict=True))
        told = table.filter(pa.compute.is_valid(table["found"]))
        for part, found, values in zip(told["part"].to_pylist(), told["found"].to_pylist(), told["values"].to_pylist(), strict=True):
            c = unpack(found, "<i8")
            v = unpack(values, "<f4").reshape(-1, classes).astype(float)
            numbers = unpack(postings[part], "<i4")
            sizes, (doc, uses) = numbers[: len(c)], np.split(numbers[len(c) :], 2)
            base += np.bincount(doc, uses * np.repeat(np.log10((c + 1) / (total + distinct + 1)), sizes), n)
            known += np.bincount(doc, uses * np.repeat(c > 0, sizes), n).astype(np.int64)
            for k in range(classes):
                value[:, k] += np.bincount(doc, uses * np.repeat(v[:, k], sizes), n)
        at = docs_part["doc"].to_numpy()
        return pa.table(
            [docs_part["id"], docs_part["held"], docs_part["n_tokens"], pa.array(known[at]), pa.array(np.full(n, total, np.int64)),
             pa.array(base[at]), pa.array(np.logaddexp.reduce(value, axis=1)[at] / LN10)],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    id_type = blocks.schema["id"].dataType.simpleString()
    schema = f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return both.groupBy("block").applyInArrow(fold, schema)

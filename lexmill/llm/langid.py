"""Language identification with a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time, on windows from a bounded sample of
labelled documents. It reads a text as bytes, forwards and backwards, labels every byte, and a
document's probabilities are the mean over all its bytes. Long texts are read in windows that cover
every byte; windows of many documents run together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.texts import by_bytes, tidy

UNDETERMINED = "und"
DIRECTIONS = 2
SLICE_BYTES = 8 << 20  # texts of a batch that run together


@dataclass(frozen=True)
class Options:
    """Sizes of the network and of its training sample.

    The sample has `docs_per_language` documents of each language, those with the smallest hash of
    their text, and `windows_per_doc` windows of each, spread over the whole text.
    """

    hidden: int = 8
    window: int = 256
    docs_per_language: int = 400
    windows_per_doc: int = 6
    train_window: int = 64
    batch: int = 512
    steps: int = 220
    rate: float = 0.02
    max_languages: int = 500
    seed: int = 5


def _act(x: np.ndarray) -> np.ndarray:
    """Logistic function in place, by way of tanh."""
    x *= 0.5
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5
    return x


def init(n_labels: int, hidden: int, seed: int) -> dict[str, np.ndarray]:
    """Parameters of both directions: input table by byte, recurrent weights, output weights."""
    rng = np.random.default_rng(seed)

    def draw(*shape):
        return rng.normal(0, 1 / np.sqrt(hidden), shape).astype(np.float32)

    return {
        "x": draw(DIRECTIONS, 256, 3 * hidden) * np.float32(0.3), "u": draw(DIRECTIONS, hidden, 3 * hidden),
        "o": draw(DIRECTIONS, hidden, n_labels), "c": np.zeros(n_labels, np.float32),
    }


def run_direction(p: dict, d: int, steps: np.ndarray, alive: np.ndarray, keep: bool = False):
    """States of one direction over `steps` (time, windows); `alive[t]` windows, the first ones, last beyond t.

    Yields per step the states, and with `keep` what the backward pass needs.
    """
    x, u = p["x"][d], p["u"][d]
    h_size = u.shape[0]
    h = np.zeros((steps.shape[1], h_size), np.float32)
    for t in range(len(steps)):
        n = alive[t]
        before = h[:n]
        a = x[steps[t, :n]]
        b = before @ u
        gates = _act(a[:, : 2 * h_size] + b[:, : 2 * h_size])
        z, r = gates[:, :h_size], gates[:, h_size:]
        c = np.tanh(a[:, 2 * h_size :] + r * b[:, 2 * h_size :])
        h = c + z * (before - c)
        yield (h, (before, z, r, c, b[:, 2 * h_size :])) if keep else h


def label_logits(p: dict, windows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Logits (time, windows, labels) of every byte; `lengths` descend, bytes beyond them are padding."""
    size, n_labels = windows.shape[0], len(p["c"])
    alive = np.searchsorted(-lengths, -np.arange(size), side="left")
    out = np.zeros((size, windows.shape[1], n_labels), np.float32)
    for t, h in enumerate(run_direction(p, 0, windows, alive)):
        out[t, : len(h)] = h @ p["o"][0]
    at = lengths[None, :] - 1 - np.arange(size)[:, None]
    turned = np.take_along_axis(windows, np.maximum(at, 0), axis=0)
    back = np.zeros_like(out)
    for t, h in enumerate(run_direction(p, 1, turned, alive)):
        back[t, : len(h)] = h @ p["o"][1]
    out += np.take_along_axis(back, np.maximum(at, 0)[:, :, None], axis=0)
    return out + p["c"]


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def loss_and_gradient(p: dict, windows: np.ndarray, lengths: np.ndarray, labels: np.ndarray):
    """Mean cross-entropy of all bytes and its gradient, by backpropagation through time."""
    size = windows.shape[0]
    alive = np.searchsorted(-lengths, -np.arange(size), side="left")
    inside = np.arange(size)[:, None] < lengths[None, :]
    total = max(int(lengths.sum()), 1)
    at = np.maximum(lengths[None, :] - 1 - np.arange(size)[:, None], 0)
    inputs = [windows, np.take_along_axis(windows, at, axis=0)]
    runs = [list(run_direction(p, d, inputs[d], alive, keep=True)) for d in range(DIRECTIONS)]
    logits = [np.zeros((size, windows.shape[1], len(p["c"])), np.float32) for _ in range(DIRECTIONS)]
    for d in range(DIRECTIONS):
        for t, (h, _) in enumerate(runs[d]):
            logits[d][t, : len(h)] = h @ p["o"][d]
    prob = softmax(logits[0] + np.take_along_axis(logits[1], at[:, :, None], axis=0) + p["c"])
    picked = np.take_along_axis(prob, np.broadcast_to(labels[None, :, None], (*prob.shape[:2], 1)), axis=2)[:, :, 0]
    loss = -np.log(np.maximum(picked[inside], 1e-30)).sum() / total
    delta = prob
    np.put_along_axis(delta, np.broadcast_to(labels[None, :, None], (*prob.shape[:2], 1)), picked[:, :, None] - 1, axis=2)
    delta = delta * (inside[:, :, None] / np.float32(total)).astype(np.float32)
    deltas = [delta, np.take_along_axis(delta, at[:, :, None], axis=0) * inside[:, :, None]]
    grad = {k: np.zeros_like(v) for k, v in p.items()}
    grad["c"] = delta.sum(axis=(0, 1))
    for d in range(DIRECTIONS):
        u, o = p["u"][d], p["o"][d]
        k = u.shape[0]
        carry = np.zeros((windows.shape[1], k), np.float32)
        for t in range(size - 1, -1, -1):
            h, (before, z, r, c, bn) = runs[d][t]
            n = len(h)
            if not n:
                continue
            e = deltas[d][t, :n]
            grad["o"][d] += h.T @ e
            dh = carry[:n] + e @ o.T
            dc = dh * (1 - z) * (1 - c * c)
            dz = dh * (before - c) * z * (1 - z)
            dr = dc * bn * r * (1 - r)
            da = np.concatenate((dz, dr, dc), axis=1)
            db = np.concatenate((dz, dr, dc * r), axis=1)
            np.add.at(grad["x"][d], inputs[d][t, :n], da)
            grad["u"][d] += before.T @ db
            carry[:n] = dh * z + db @ u.T
    return loss, grad


def train(windows: list[bytes], labels: np.ndarray, n_labels: int, options: Options) -> dict[str, np.ndarray]:
    """Adam over random batches, languages in equal shares, the rate falling to zero."""
    rng = np.random.default_rng(options.seed)
    p = init(n_labels, options.hidden, options.seed)
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    by_label = [np.flatnonzero(labels == i) for i in range(n_labels)]
    for step in range(1, options.steps + 1):
        rows = np.concatenate([rng.choice(m, max(options.batch // n_labels, 1)) for m in by_label])
        rows = rows[np.argsort([-len(windows[i]) for i in rows], kind="stable")]
        data, lengths = pad([windows[i] for i in rows])
        _, grad = loss_and_gradient(p, data, lengths, labels[rows])
        rate = options.rate * (1 - (step - 1) / options.steps)
        for k, g in grad.items():
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return p


def pad(windows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Windows of descending length as (time, windows), and the lengths."""
    lengths = np.array([len(w) for w in windows], np.int64)
    data = np.zeros((len(windows), lengths[0]), np.uint8)
    data[np.arange(lengths[0])[None, :] < lengths[:, None]] = np.frombuffer(b"".join(windows), np.uint8)
    return np.ascontiguousarray(data.T), lengths


def document_probabilities(p: dict, texts: list[bytes], window: int, at_once: int = 4096) -> np.ndarray:
    """Mean probabilities over all bytes of each text, which must not be empty."""
    sums = np.zeros((len(texts), len(p["c"])))
    cuts = [(i, a) for i, t in enumerate(texts) for a in range(0, len(t), window)]
    cuts.sort(key=lambda x: -min(window, len(texts[x[0]]) - x[1]))
    for k in range(0, len(cuts), at_once):
        some = cuts[k : k + at_once]
        data, lengths = pad([texts[i][a : a + window] for i, a in some])
        prob = softmax(label_logits(p, data, lengths))
        prob *= (np.arange(len(data))[:, None] < lengths[None, :])[:, :, None]
        np.add.at(sums, [i for i, _ in some], prob.sum(axis=0))
    return sums / np.array([max(len(t), 1) for t in texts])[:, None]


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").lower()


def training_sample(docs: DataFrame, text_col: str, label_col: str, learn: Column, options: Options):
    """(languages, windows, labels) from a bounded number of documents of each language."""
    rows = docs.where(learn & F.col(label_col).isNotNull() & F.coalesce(F.regexp_like(text_col, F.lit(r"\p{L}")), F.lit(False)))
    size, k = options.train_window, options.windows_per_doc
    # Windows begin at even steps over the whole text; only they are ranked and reach the driver.
    step = F.greatest((F.octet_length(text_col) - F.lit(size)) / F.lit(float(max(k - 1, 1))), F.lit(0.0))
    starts = F.array_distinct(F.array(*[F.floor(step * F.lit(i)).cast("int") + 1 for i in range(k)]))
    windows = F.transform(starts, lambda a: F.substring(F.col(text_col).cast("binary"), a, F.lit(size)))
    rows = rows.select(F.col(label_col).cast("string").alias("lang"), F.xxhash64(text_col).alias("h"), windows.alias("windows"))
    # A language is cut by hash first, so a common one is ranked in many tasks.
    shares = 16
    in_share = Window.partitionBy("lang", "share").orderBy("h", "windows")
    ranked = rows.withColumn("share", F.pmod("h", F.lit(shares))).withColumn("nth", F.row_number().over(in_share))
    few = ranked.where(F.col("nth") <= -(-options.docs_per_language // shares))
    found = few.select("lang", "h", F.explode("windows").alias("w")).orderBy("lang", "h", "w").collect()
    languages = sorted({r["lang"] for r in found})
    if len(languages) > options.max_languages:
        raise ValueError(f"{len(languages)} languages; raise max_languages to train on so many")
    number = {lang: i for i, lang in enumerate(languages)}
    return languages, [bytes(r["w"]).lower() for r in found], np.array([number[r["lang"]] for r in found], np.int64)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    weights: dict
    window: int

    def predict(self, docs: DataFrame, text_col: str = "text", prefix: str = "") -> DataFrame:
        """`docs` with lang_pred (`und` for a text that is null or has no letter) and score.

        A batch-wise function over the scan: no shuffle, and every byte of every text is read. Other
        columns pass through; `prefix` goes before the two new names.
        """
        model, names = self, docs.columns
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
        schema = f"{fields}, `{prefix}lang_pred` string, `{prefix}score` double"
        at = names.index(text_col)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for _, batch in by_bytes(whole, at, SLICE_BYTES):
                    texts = [t.as_py() for t in batch.column(at)]
                    named = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))] if model.languages else []
                    pred, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
                    if named:
                        prob = document_probabilities(model.weights, [_bytes(texts[i]) for i in named], model.window)
                        best = prob.argmax(axis=1)
                        score[named] = np.clip(prob[np.arange(len(named)), best], 0, 1)
                        for i, b in zip(named, best, strict=True):
                            pred[i] = model.languages[b]
                    columns = [batch.column(i) for i in range(len(names))]
                    yield pa.RecordBatch.from_arrays(
                        [*columns, pa.array(pred, pa.string()), pa.array(score)],
                        [*names, f"{prefix}lang_pred", f"{prefix}score"],
                    )

        return docs.mapInArrow(tidy(run), schema)


def held_out(id_col: Column, folds: int = 5) -> Column:
    """Whether crc32 of the id as text leaves remainder 0; a null id counts as one to learn from."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string")), F.lit(folds)) == 0, F.lit(False))


def fit(
    docs: DataFrame, text_col: str = "text", label_col: str = "lang", learn: Column | None = None, options: Options = Options()
) -> LanguageModel:
    """Train on the rows where `learn` holds and the label is not null.

    Without such rows the model knows no language and calls every text `und`.
    """
    languages, windows, labels = training_sample(
        docs, text_col, label_col, F.lit(True) if learn is None else learn, options
    )
    weights = train(windows, labels, len(languages), options) if languages else init(0, options.hidden, options.seed)
    return LanguageModel(tuple(languages), weights, options.window)

"""Secrets in texts: fixed patterns, and formats that are inferred from what the patterns find.

The values found by the patterns are labelled credentials. For each kind a sample of them makes a
prefix tree with counts; states whose outcomes are statistically compatible (Hoeffding bounds on all
their continuations) are merged into a probabilistic automaton. One more automaton learns from other
long tokens. Every long token that no pattern covers is scored: the logarithm of how much likelier
its format is for a kind of credential than for another token. Above `min_score` it becomes a span.
"""

from __future__ import annotations

import math
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import takewhile

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.texts import bounded_sample, parts_of
from lexmill.session import materialize

# Kinds in order, their patterns and least lengths.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}

OTHER = "other"
NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
LETTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
TOKENS = bytes(c if c in LETTERS else 32 for c in range(256))
ALPHABET = len(LETTERS) + 3  # and '.', '=' and the end
SHORTEST = 16  # of a token that is scored
SPAN = "struct<kind: string, start: bigint, end: bigint, value: string, base: boolean, score: double>"


@dataclass(frozen=True)
class Options:
    """Bounds and thresholds of the inference.

    Each kind learns from at most `sample` distinct values of at most `longest` characters, those
    with the smallest hash, and from none if fewer than `fewest` are there. Longer values are scored,
    not learned from. `alpha` is the risk of the Hoeffding test, `smooth` the count of an unseen
    outcome, and `min_score` the log likelihood ratio of a span: that of one in a million by default.
    `rounds` limits how often the automaton of other tokens is cleaned of what looks like a credential.
    """

    sample: int = 1000
    longest: int = 256
    fewest: int = 20
    alpha: float = 0.05
    smooth: float = 0.1
    min_score: float = math.log(1e6)
    shortest: int = SHORTEST
    rounds: int = 5


class Inference:
    """A prefix tree whose compatible states are merged until none is left to be decided.

    States on the red list are settled. Of the states they lead to, the one with the most evidence
    is merged with the compatible red state that explains it best, or becomes red itself.
    """

    def __init__(self, values: list[str], alpha: float, smooth: float):
        self.to: list[dict[str, int]] = [{}]
        self.count: list[dict[str, int]] = [{}]  # outcome "" is the end
        self.smooth, self.limit = smooth, math.sqrt(0.5 * math.log(2 / alpha))
        for value in values:
            at = 0
            for c in [*value, ""]:
                self.count[at][c] = self.count[at].get(c, 0) + 1
                if c:
                    if c not in self.to[at]:
                        self.to[at][c] = len(self.to)
                        self.to.append({})
                        self.count.append({})
                    at = self.to[at][c]

    def differ(self, a: int, b: int) -> bool:
        """Whether the outcomes of two states alone are too far apart."""
        x, y = self.count[a], self.count[b]
        n, m = sum(x.values()), sum(y.values())
        bound = self.limit * (1 / math.sqrt(n) + 1 / math.sqrt(m))
        return bound < 1 and any(abs(x.get(c, 0) / n - y.get(c, 0) / m) > bound for c in x.keys() | y.keys())

    def compatible(self, a: int, b: int) -> bool:
        """Whether two states and all their common continuations agree."""
        todo, seen = [(a, b)], set()
        while todo:
            pair = todo.pop()
            if pair in seen:
                continue
            seen.add(pair)
            a, b = pair
            if self.differ(a, b):
                return False
            todo += [(self.to[a][c], t) for c, t in self.to[b].items() if c in self.to[a]]
        return True

    def fit(self, a: int, b: int) -> float:
        """Mean log probability of the outcomes of b under those of a."""
        x, y = self.count[a], self.count[b]
        n = sum(x.values()) + self.smooth * ALPHABET
        return sum(k * math.log((x.get(c, 0) + self.smooth) / n) for c, k in y.items()) / sum(y.values())

    def fold(self, a: int, b: int) -> None:
        """Add the tree below b to the states that a leads to."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            for c, k in self.count[b].items():
                self.count[a][c] = self.count[a].get(c, 0) + k
            for c, t in self.to[b].items():
                if c in self.to[a]:
                    todo.append((self.to[a][c], t))
                else:
                    self.to[a][c] = t

    def merge(self) -> Automaton:
        red = [0]
        while True:
            settled = set(red)
            blue = [(p, c, t) for p in red for c, t in self.to[p].items() if t not in settled]
            if not blue:
                break
            parent, c, state = max(blue, key=lambda x: sum(self.count[x[2]].values()))
            fitting = [r for r in red if self.compatible(r, state)]
            if fitting:
                best = max(fitting, key=lambda r: self.fit(r, state))
                self.to[parent][c] = best
                self.fold(best, state)
            else:
                red.append(state)
        number = {s: i for i, s in enumerate(red)}
        return Automaton(
            [{c: number[t] for c, t in self.to[s].items()} for s in red], [dict(self.count[s]) for s in red], self.smooth
        )


class Automaton:
    """States with a next state and a log probability per character.

    An outcome that a state has never had keeps its small probability and the state.
    """

    def __init__(self, to: list[dict[str, int]], count: list[dict[str, int]], smooth: float):
        totals = [sum(c.values()) + smooth * ALPHABET for c in count]
        self.steps = [
            {c: (to[s].get(c, s), math.log((k + smooth) / n)) for c, k in count[s].items()} for s, n in enumerate(totals)
        ]
        self.unseen = [math.log(smooth / n) for n in totals]

    def log_likelihood(self, value: str) -> float:
        at, total, steps = 0, 0.0, self.steps
        for c in value:
            step = steps[at].get(c)
            if step is None:
                total += self.unseen[at]
            else:
                at, p = step
                total += p
        end = steps[at].get("")
        return total + (end[1] if end else self.unseen[at])


def infer(values: list[str], alpha: float = 0.05, smooth: float = 0.1) -> Automaton:
    """The probabilistic automaton of some values; the same for any order of them."""
    return Inference(sorted(values), alpha, smooth).merge()


def base_spans(text: str) -> list[tuple[int, str, int, str]]:
    """(start, kind, end, credential) of the patterns' matches, by start and then kind as listed."""
    found = [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text)]
    found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text) if m.end() - m.start() >= LEAST["hex"]]
    return [(s, KINDS[k], e, v) for s, k, e, v in sorted(found) if len(v) >= LEAST[KINDS[k]]]


def may_hold(data: bytes, shortest: int) -> bool:
    """Whether a text has a name of the first pattern or a token that can be a credential."""
    low = data.lower()
    if any(name in low for name in NAMES):
        return True
    # The other two patterns match inside such tokens.
    least = min(shortest, LEAST["access"], LEAST["hex"])
    return any(max(map(len, part.split()), default=0) >= least for part in parts_of(data.translate(TOKENS)))


def spans_of(text: bytes | None, shortest: int, tokens: re.Pattern) -> list[dict]:
    """Base spans, and other tokens with the kind `other`."""
    if not text or not may_hold(text, shortest):
        return []
    whole = text.decode("utf-8", "replace")
    base = base_spans(whole)
    out = [{"kind": k, "start": s, "end": e, "value": v, "base": True, "score": None} for s, k, e, v in base]
    covered = deque(sorted((s, e) for s, _, e, _ in base))
    for m in tokens.finditer(whole):
        while covered and covered[0][1] <= m.start():
            covered.popleft()
        if all(e <= m.start() for _, e in takewhile(lambda x: x[0] < m.end(), covered)):
            out.append({"kind": OTHER, "start": m.start(), "end": m.end(), "value": m[0], "base": False, "score": None})
    return out


def candidates(docs: DataFrame, id_col: str, text_col: str, shortest: int) -> DataFrame:
    """(doc_id, spans) for every row."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{shortest},}}")
        for batch in batches:
            spans = [spans_of(t.as_py(), shortest, tokens) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _span_type())], ["doc_id", "spans"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary"))
    return rows.mapInArrow(run, f"doc_id {id_type}, spans array<{SPAN}>")


def _span_type() -> pa.DataType:
    fields = {"kind": pa.string(), "start": pa.int64(), "end": pa.int64(), "value": pa.string(), "base": pa.bool_(), "score": pa.float64()}
    return pa.list_(pa.struct(list(fields.items())))


def learn(found: DataFrame, options: Options) -> dict[str, Automaton]:
    """An automaton for each kind with enough distinct values, and for `other`.

    Some of the other tokens are credentials that no pattern names. Those that a kind explains better
    than the automaton of `other` are left out of it, and it is inferred again.
    """
    values = found.select(F.explode("spans").alias("s")).select("s.kind", "s.value")
    values = values.where(F.length("value") <= options.longest).distinct()
    models = {}
    for kind in (*KINDS, OTHER):
        sample = bounded_sample(values.where(F.col("kind") == kind).select("value"), F.col("value"), options.sample).collect()
        own = [r["value"] for r in sample]
        if len(own) >= (options.fewest if kind != OTHER else 1):
            models[kind] = infer(own, options.alpha, options.smooth)
    for _ in range(options.rounds if OTHER in models else 0):
        kinds = [models[k] for k in KINDS if k in models]
        clean = [v for v in own if all(m.log_likelihood(v) <= models[OTHER].log_likelihood(v) for m in kinds)]
        if not clean or len(clean) == len(own):
            break
        own = clean
        models[OTHER] = infer(own, options.alpha, options.smooth)
    return models


def scored(found: DataFrame, models: dict[str, Automaton], min_score: float) -> DataFrame:
    """`found` with scores; other tokens become spans of their likeliest kind, or go."""
    kinds = [k for k in KINDS if k in models]

    def ratio(span: dict, kind: str) -> float | None:
        if kind not in models or OTHER not in models:
            return None
        return models[kind].log_likelihood(span["value"]) - models[OTHER].log_likelihood(span["value"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for spans in batch.column(1).to_pylist():
                kept = []
                for span in spans:
                    if span["base"]:
                        kept.append({**span, "score": ratio(span, span["kind"])})
                    elif kinds:
                        best = max(kinds, key=lambda k: ratio(span, k))
                        if ratio(span, best) >= min_score:
                            kept.append({**span, "kind": best, "score": ratio(span, best)})
                out.append(sorted(kept, key=lambda s: (s["start"], KINDS.index(s["kind"]), s["end"])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, _span_type())], ["doc_id", "spans"])

    return found.mapInArrow(run, found.schema)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", options: Options = Options()) -> DataFrame:
    """One row per row of `docs`: doc_id, spans as an array of (kind, start, end, value, base, score).

    Starts and ends are code points, ends exclusive; spans are ordered by start, then kind. `base`
    says that a pattern found it, and those are always there. `value` is the credential alone. A null
    or empty text has no spans, repeated rows get a row each, other columns are not looked at. Without
    enough labelled credentials of any kind nothing is added and base spans have no score.
    """
    found = materialize(candidates(docs, id_col, text_col, options.shortest), "candidates")
    return scored(found, learn(found, options), options.min_score)


def written(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(rows: DataFrame) -> DataFrame:
    """Numbers of base spans per kind, their digest, and all spans as text."""
    base = F.filter("spans", lambda s: s["base"])

    def number(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")

    counts = [number(k).alias(f"n_{k}") for k in KINDS]
    return rows.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))

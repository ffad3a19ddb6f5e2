"""Very many correction rules or signatory patterns over texts.

All strings that are looked for form one automaton, so a text is read once whatever their number.
Long lists are cut into parts of bounded size, which follow each other in order.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from datetime import date

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import text as text_functions

# Lists up to this length are expressions of the plan.
EXPRESSIONS = 64
# Strings that a task holds at once, in characters, and the longest that enters the automaton.
PART_CHARS = 4 << 20
DEPTH = 500


def automaton(strings: Sequence[str]):
    """Finds the numbers of the strings, or None if all are too long for it; empty ones never occur."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for n, s in enumerate(strings):
        if 0 < len(s) <= DEPTH:
            found.add_word(s, (*found.get(s, ()), n))
    if not len(found):
        return None
    found.make_automaton()
    return found


class Corrector:
    """Literal replacements in rule order, later rules on the result of earlier ones.

    The rules that occur wait in a heap. Carrying one out can create occurrences of later rules only
    near the places it changed, so only these are searched again.
    """

    def __init__(self, rules: Sequence[tuple[str, str]]):
        self.rules = list(rules)
        self.automaton = automaton([w for w, _ in rules])
        self.reach = max((len(w) for w, _ in rules if len(w) <= DEPTH), default=1) - 1
        self.long = [n for n, (w, _) in enumerate(rules) if len(w) > DEPTH]

    def found(self, text: str) -> set[int]:
        return {n for _, ns in self.automaton.iter(text) for n in ns} if self.automaton else set()

    def __call__(self, text: str) -> str:
        waiting = [*self.long, *self.found(text)]
        heapq.heapify(waiting)
        last = -1
        while waiting:
            n = heapq.heappop(waiting)
            if n == last:
                continue
            last = n
            wrong, right = self.rules[n]
            pieces = text.split(wrong)
            if len(pieces) == 1:
                continue
            text, at = right.join(pieces), -len(right)
            end = -1  # of the stretch around changed places that is not searched yet
            begin = 0
            for piece in pieces[:-1]:
                at += len(right) + len(piece)
                if at - self.reach > end >= 0:
                    self.push(waiting, text[begin:end], n)
                    begin = max(at - self.reach, 0)
                elif end < 0:
                    begin = max(at - self.reach, 0)
                end = at + len(right) + self.reach
            self.push(waiting, text[begin:end], n)
        return text

    def push(self, waiting: list[int], part: str, after: int) -> None:
        for n in self.found(part):
            if n > after:
                heapq.heappush(waiting, n)


def _parts(items: Sequence, size) -> Iterator[list]:
    part, held = [], 0
    for item in items:
        if part and held + size(item) > PART_CHARS:
            yield part
            part, held = [], 0
        part.append(item)
        held += size(item)
    if part:
        yield part


def correct(texts: DataFrame, rules: Sequence[tuple[str, str]], text_col: str = "text", expressions: int = EXPRESSIONS) -> DataFrame:
    """`texts` with `text_col` corrected; any number of rules, the same result as one after another."""
    if len(rules) <= expressions:
        return texts.withColumn(text_col, text_functions.apply_corrections(F.col(text_col), list(rules)))
    at = texts.columns.index(text_col)
    for part in _parts(rules, lambda r: len(r[0]) + len(r[1])):
        shared = texts.sparkSession.sparkContext.broadcast(part)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            fix = Corrector(shared.value)
            for batch in batches:
                new = [None if t is None else fix(t) for t in (x.as_py() for x in batch.column(at))]
                columns = [pa.array(new, pa.string()) if i == at else c for i, c in enumerate(batch.columns)]
                yield pa.RecordBatch.from_arrays(columns, schema=batch.schema.set(at, pa.field(text_col, pa.string())))

        texts = texts.mapInArrow(run, texts.schema)
    return texts


def required_literal(pattern: str) -> str:
    """The longest string that every match of a regular expression contains; empty if none is certain.

    Only plain characters outside groups and classes count. Anything that could make them optional,
    fold their case or give them another meaning ends a run or the attempt.
    """
    if "(?" in pattern or "\\Q" in pattern:
        return ""
    best, run, depth, i = "", "", 0, 0
    while i < len(pattern):
        c = pattern[i]
        step, literal = 1, None
        if c == "\\":
            if i + 1 == len(pattern):
                return ""
            step = 2
            literal = pattern[i + 1] if not pattern[i + 1].isalnum() else None
            if pattern[i + 1].isalnum() and pattern[i + 1] not in "bBdDsSwWhHvVRAzZGntrf":
                return ""  # back references, code points and the like
        elif c == "[":
            j = i + 1 + (pattern[i + 1 : i + 2] == "^")
            j += pattern[j : j + 1] == "]"
            while j < len(pattern) and pattern[j] != "]":
                if pattern[j] == "[" or pattern[j : j + 2] == "&&":
                    return ""
                j += 2 if pattern[j] == "\\" else 1
            step = j + 1 - i
        elif c == "(":
            depth += 1
        elif c == ")":
            depth -= 1
        elif c == "|":
            if depth == 0:
                return ""
        elif c not in ".^$*+?{}":
            literal = c
        after = pattern[i + step : i + step + 1]
        if literal is not None and depth == 0 and after not in ("?", "*", "{"):
            run += literal
            best = max(best, run, key=len)
            if after == "+":
                run = ""
        else:
            run = ""
        if c == "{" and "}" in pattern[i:]:
            step = pattern.index("}", i) + 1 - i
        i += step
    return best if depth == 0 else ""


SIGNED = "array<struct<role: string, name: string, mandate_start: date, mandate_end: date, order: int>>"
PERSON = "struct<at: int, pattern: string, role: string, name: string, start: date, end: date>"


def _day(value) -> date | None:
    return date.fromisoformat(value) if isinstance(value, str) else value


def with_signatories(
    texts: DataFrame, people: Sequence[dict], promulgated: Column | None = None, text_col: str = "text", expressions: int = EXPRESSIONS
) -> DataFrame:
    """`texts` with `signatories`, as `functions.text.signatories` gives it, for any number of patterns.

    The automaton looks for a string that each pattern needs; the regular expression itself runs only
    for patterns whose string is there, and for those that have none.
    """
    if not people:
        return texts.withColumn("signatories", F.array().cast(SIGNED))
    if len(people) <= expressions:
        return texts.withColumn("signatories", text_functions.signatories(F.col(text_col), list(people), promulgated))
    at = texts.columns.index(text_col)
    names = texts.columns
    fields = [pa.field("at", pa.int32()), *[pa.field(k, pa.string()) for k in ("pattern", "role", "name")], *[pa.field(k, pa.date32()) for k in ("start", "end")]]
    rows = [
        {"at": n, "pattern": p["pattern"], "role": p["role"], "name": p["name"], "start": _day(p.get("start_date")), "end": _day(p.get("end_date"))}
        for n, p in enumerate(people)
    ]
    texts = texts.withColumn("__who", F.array().cast(f"array<{PERSON}>"))
    for part in _parts(rows, lambda r: sum(len(r[k] or "") for k in ("pattern", "role", "name"))):
        shared = texts.sparkSession.sparkContext.broadcast(part)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            part = shared.value
            needed = [required_literal(r["pattern"]) for r in part]
            always = {n for n, s in enumerate(needed) if not 0 < len(s) <= DEPTH}
            finder = automaton(needed)
            kind = pa.list_(pa.struct(fields))
            for batch in batches:
                new = []
                for text, before in zip(batch.column(at), batch.column(len(names)).to_pylist(), strict=True):
                    text = text.as_py()
                    hits = set(always) if text is not None else set()
                    if text is not None and finder:
                        hits.update(n for _, ns in finder.iter(text) for n in ns)
                    new.append([*(before or []), *[part[n] for n in sorted(hits)]])
                columns = [*batch.columns[:-1], pa.array(new, kind)]
                yield pa.RecordBatch.from_arrays(columns, [*names, "__who"])

        texts = texts.mapInArrow(run, texts.schema)
    body = F.col(text_col)
    texts = texts.withColumn("__day", promulgated if promulgated is not None else F.lit(None).cast("date"))

    def holds(p: Column) -> Column:
        hit = F.regexp_like(body, p["pattern"])
        if promulgated is None:
            return hit
        day = F.col("__day")
        return hit & (day >= F.coalesce(p["start"], day)) & (day <= F.coalesce(p["end"], day))

    found = F.filter("__who", lambda p: F.coalesce(holds(p), F.lit(False)))
    listed = F.transform(
        found,
        lambda p, i: F.struct(
            p["role"].alias("role"), p["name"].alias("name"), p["start"].alias("mandate_start"), p["end"].alias("mandate_end"), (i + 1).alias("order")
        ),
    )
    return texts.withColumn("signatories", listed).drop("__who", "__day")

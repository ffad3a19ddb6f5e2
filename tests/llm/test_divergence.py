import random
import re
from collections import Counter

import pytest

from lexmill.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, n int, value string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, min_docs, top=10):
    docs = [(r[2] or "", r[3] or "", TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or ""))) for r in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for d in own for t in set(d[2]))
        kept = [t for t, n in df.items() if n >= min_docs]
        sources = sorted({d[1] for d in own}, key=lambda s: s.encode())
        count = {s: Counter(t for d in own if d[1] == s for t in d[2] if df[t] >= min_docs) for s in sources}
        whole = sum(count.values(), Counter())

        def p(c):
            n = sum(c.values())
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        f = lambda x, y: (x - y) ** 2 // (x + y)
        ps, q = {s: p(c) for s, c in count.items()}, p(whole)
        for s in sources:
            pair = [(-sum(f(ps[s][t], ps[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            out += [(lang, s, "pair", o, -v, i) for i, (v, _, o) in enumerate(sorted(pair), 1)]
            best = sorted((-f(ps[s][t], q[t]), t.encode(), t) for t in kept if count[s][t] and ps[s][t] > q[t])[:top]
            out += [(lang, s, "term", t, -v, i) for i, (v, _, t) in enumerate(best, 1)]
    return sorted(out)


def corpus():
    r = random.Random(2)
    words = "the of and Straße é É naïve 日本 a b c don't x1y zz qq".split() + [f"w{chr(97 + i)}" for i in range(20)]
    rows = []
    for i in range(400):
        lang, source = r.choice(["en", "en", "de", None]), r.choice(["s1", "s1", "s2", "é", None, "Z"])
        some = words[: 12 + len(source or "") * 5]
        rows.append((i, " ".join(r.choice(some) for _ in range(r.randint(0, 40))), lang, source, "t", 1, "v"))
    odd = [
        (500, None, "xx", "s1", None, None, None), (501, "rare words", "xx", "s2", None, None, None), (502, "", "en", "only empty", None, None, None),
        (None, "the", None, None, None, None, None), (3, rows[3][1], rows[3][2], rows[3][3], None, None, None),
        (503, "the " * 50_000 + "of", "en", "s2", None, None, None), (504, "k" * 500_000, "en", "s2", None, None, None),
    ]
    return rows + odd


@pytest.mark.parametrize(
    ("entries", "per_task", "block", "min_docs"), [(400_000, 200_000, 512, 10), (25, 7, 2, 10), (25, 7, 1, 3)]
)
def test_against_a_plain_version(spark, monkeypatch, entries, per_task, block, min_docs):
    monkeypatch.setattr(divergence, "BLOCK", block)
    rows = corpus()
    got = divergence.audit(
        spark.createDataFrame(rows, SCHEMA).repartition(4), min_docs=min_docs, spill_entries=entries, entries_per_task=per_task
    )
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == plain(rows, min_docs)


def test_an_empty_table_and_a_language_without_terms(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, "once", "en", "a", "", 0, ""), (2, None, "en", "b", "", 0, "")]
    got = sorted(map(tuple, divergence.audit(spark.createDataFrame(rows, SCHEMA)).collect()))
    assert got == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_large_counts_stay_exact():
    import numpy as np

    count, total = 12_345_678_901_234_567, 98_765_432_109_876_543
    assert divergence.share(np.array([count]), np.array([total]))[0] == 1 + 10**9 * (count + 2) // total

import random

import numpy as np
import pytest

from lexmill.llm import licenses

SCHEMA = "doc_id long, text string, license string, start int, coverage string"
MIT = licenses.TEMPLATES["MIT"]


def plain_best(doc, template):
    """Matches of the best local alignment over the whole table, without a band."""
    best, before = (0, 0), [(0, 0)] * (len(doc) + 1)
    for word in template:
        row = [(0, 0)]
        for i, other in enumerate(doc, 1):
            s, m = before[i - 1]
            options = [(s + 2, m + 1) if other == word else (s - 1, m), (before[i][0] - 1, before[i][1]), (row[-1][0] - 1, row[-1][1])]
            top = max(options, key=lambda x: x[0])
            row.append(top if top[0] > 0 else (0, 0))
            best = max(best, row[-1], key=lambda x: x[0])
        before = row
    return best[1]


def longest_run(doc, template):
    """Most consecutive words that both have."""
    runs = {tuple(template[a:b]) for a in range(len(template)) for b in range(a + 1, min(a + 9, len(template)) + 1)}
    return max((n for n in range(1, 10) for i in range(len(doc) - n + 1) if tuple(doc[i : i + n]) in runs), default=0)


def damaged(r, text):
    words = text.split()
    for _ in range(r.randint(0, 4)):
        at = r.randrange(len(words))
        words[at : at + r.choice([0, 1])] = r.choice([[], ["other"], [words[at]]])
    return " ".join(words)


@pytest.mark.parametrize("seed", range(3))
def test_against_full_alignment(spark, seed):
    r = random.Random(seed)
    filler = ["the", "of", "éa", "and", "to", "is", "software", "license", "in", "x1"]
    rows = []
    for i in range(40):
        parts = [" ".join(r.choices(filler, k=r.randint(0, 60))) for _ in range(3)]
        for name in r.sample(sorted(licenses.TEMPLATES), r.choice([0, 1, 2])):
            parts.insert(r.randrange(len(parts)), damaged(r, licenses.TEMPLATES[name]))
        rows.append((i, "\n".join(parts)))
    df = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA)
    got = {}
    for row in licenses.scan(df).collect():
        got[row["doc_id"], row["license"]] = max(got.get((row["doc_id"], row["license"]), 0), row["matched_words"])
    for i, text in rows:
        doc = licenses.word_list(text)
        for name, template in licenses.TEMPLATES.items():
            words = licenses.word_list(template)
            best = plain_best(doc, words)
            if (i, name) in got:
                assert got[i, name] <= best and got[i, name] >= 0.8 * len(words)
            elif best >= 0.9 * len(words) and longest_run(doc, words) >= 5:
                raise AssertionError((i, name, best, len(words)))


def test_spans_and_repeats(spark):
    notice = licenses.TEMPLATES["MIT-notice"]
    text = f"é {notice} between words\n{notice.upper()} {MIT} Étude"
    rows = [(1, text), (1, text), (2, None), (3, ""), (None, notice), (4, "no licence here " * 40_000), (5, (notice + " ") * 500), (6, "Released under the MIT License version")]
    got = licenses.scan(spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA)).collect()
    first = sorted((r for r in got if r["doc_id"] == 1), key=lambda r: (r["license"], r["occurrence"]))
    assert [(r["license"], r["occurrence"]) for r in first] == [("MIT", 0), ("MIT", 0), ("MIT-notice", 0), ("MIT-notice", 0), ("MIT-notice", 1), ("MIT-notice", 1)]
    for r in first:
        span = text[r["start"] : r["end"]]
        assert licenses.word_list(span) == licenses.word_list(licenses.TEMPLATES[r["license"]]) and r["coverage"] == 1.0
    assert {r["doc_id"] for r in got} == {1, None, 5, 6}
    assert sum(r["doc_id"] == 5 for r in got) == 500
    assert [r["coverage"] for r in got if r["doc_id"] == 6] == [1.0]


def test_winnowing_keeps_a_run_in_every_window():
    index = licenses.TemplateIndex.of(licenses.TEMPLATES, gram=4, window=3)
    for t, words in enumerate(index.words):
        kept = sorted(p for places in index.places for name, p in places if name == t)
        n = len(words) - 3
        assert all(any(a <= p < a + 3 for p in kept) for a in range(max(n - 2, 1)))
        assert n < 3 or len(kept) < n


def test_empty(spark):
    assert licenses.scan(spark.createDataFrame([], SCHEMA)).count() == 0
    assert licenses.scan(spark.createDataFrame([(1, MIT, "x", 1, "y")], SCHEMA), templates={}).count() == 0


@pytest.mark.parametrize("size", [5, 7, 12, 20])
def test_inserted_and_missing_passages(size):
    index = licenses.TemplateIndex.of(licenses.TEMPLATES)
    for name in ["MIT", "GPL-3.0-header", "Apache-2.0-header"]:
        t, words = index.names.index(name), index.words[index.names.index(name)]
        n, noise = len(words), np.full(size, -1)
        for at in range(n // 4, n - n // 4 - size, 7):
            longer = np.concatenate((noise, words[:at], noise, words[at:], noise))
            got = [x for x in licenses.occurrences(index, longer, 4, 0.8) if x[0] == t]
            assert got == [(t, n, size, 2 * size + n)]
            shorter = np.concatenate((noise, words[:at], words[at + size :], noise, words))
            got = [x[1] for x in licenses.occurrences(index, shorter, 4, 0.8) if x[0] == t]
            assert got == ([n - size, n] if n - size >= 0.8 * n else [n])


def test_half_a_text_is_not_the_whole(spark):
    """The permission of the ISC license without its disclaimer of liability, and whole BSD texts."""
    isc = licenses.TEMPLATES["ISC"]
    texts = [isc, isc[: isc.index("IN NO EVENT")], licenses.TEMPLATES["BSD-3-Clause"], licenses.TEMPLATES["BSD-2-Clause"]]
    df = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in enumerate(texts)], SCHEMA)
    got = {}
    for r in licenses.scan(df).collect():
        total = len(licenses.word_list(licenses.TEMPLATES[r["license"]]))
        got[r["doc_id"], r["license"]] = r["matched_words"] == total
    assert got[0, "ISC"] and (1, "ISC") not in got
    assert got[2, "BSD-3-Clause"] and got[3, "BSD-2-Clause"] and not got.get((3, "BSD-3-Clause"), False)

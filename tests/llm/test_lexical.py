import math
import random
import re
from collections import Counter

import pytest

from lexmill.llm import lexical

SCHEMA = "doc_id long, text string, item_id long, score long, n int"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, k=10):
    found = [(i, terms(t)) for i, t, *_ in docs if terms(t)]
    if not found:
        return []
    n_docs, total = len(found), sum(len(t) for _, t in found)
    df = Counter(t for _, ts in found for t in set(ts))
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, own in asked.items():
        scores = []
        for doc, ts in found:
            tf, m = Counter(ts), 100 - 90 + (90 * len(ts) * n_docs) // total
            w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in own}
            score = sum(w[t] * ((1_000_000_000 * tf[t]) // (1000 * tf[t] + 8 * m)) for t in own if tf[t])
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, e[3], -e[0]) for rank, e in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def corpus():
    r = random.Random(1)
    words = "the The a b aa ab é É ß 12 3a x_y-z it's 日本 日本語 straße".split()
    rows = [(i, " ".join(r.choice(words) for _ in range(r.randint(1, 40))), None, 1, 2) for i in range(300)]
    copies = [(1000 + i, rows[3][1], 7, None, None) for i in range(60)]
    odd = [
        (2000, None, 1, 1, 1), (2001, "", 1, 1, 1), (2002, " ,.;", 1, 1, 1), (None, "the the ab", 1, 1, 1), (None, "the ab", 1, 1, 1),
        (3, rows[3][1], None, None, None), (2003, "ab " * 200_000, 1, 1, 1), (2004, "y" * 1_500_000 + " ab", 1, 1, 1),
    ]
    items = [
        (1, "The AB é!"), (2, "aa aa b-a"), (3, "unknown words"), (4, None), (5, ""), (None, "日本 x"), (1, "straße"), (6, "12 3A y" + "y" * 1_499_999),
    ]
    return rows + copies + odd, items


@pytest.mark.parametrize(("term_bytes", "pairs"), [(lexical.TERM_BYTES, lexical.PAIRS), (10, 3)])
def test_against_a_plain_version(spark, term_bytes, pairs):
    docs, items = corpus()
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id", "'x' AS score")
    got = lexical.search(spark.createDataFrame(docs, SCHEMA).repartition(5), table, term_bytes=term_bytes, max_pairs=pairs)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(docs, items)


def test_fewer_documents_than_k_and_text_ids(spark):
    docs = spark.createDataFrame([("b", "one two"), ("a", "one two"), ("c", "two")], "name string, body string")
    items = spark.createDataFrame([("q", "one")], "ask string, body string")
    got = lexical.search(docs, items, "name", "body", "ask", "body", k=5).collect()
    assert [(r["item_id"], r["rank"], r["doc_id"]) for r in sorted(got, key=lambda r: r["rank"])] == [("q", 1, "a"), ("q", 2, "b")]


@pytest.mark.parametrize(("docs", "items"), [([], [(1, "a")]), ([(1, "a", 1, 1, 1)], []), ([], [])])
def test_empty_tables(spark, docs, items):
    got = lexical.search(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string"))
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.count() == 0


def test_guards_and_windows():
    long = "z" * 2000
    matcher = lexical.Matcher(["ab", "b", "é", long, long + "a"])
    text = f"ab b abb É é xab é {long} {long}a {long}b x{long} {long[1:]}"
    assert matcher.count(text.encode()) == (12, Counter({0: 1, 1: 1, 2: 2, 3: 1, 4: 1}))
    data = b" " + b"ab b " * 1000 + b"x" * 500 + b" "
    parts = list(lexical.windows(data, 64))
    assert parts[0] + b"".join(p[1:] for p in parts[1:]) == data

"""Automata against one rule or pattern after another."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lexmill.functions import text
from lexmill.operators import patterns


def one_by_one(rules, t):
    for wrong, right in rules:
        t = t.replace(wrong, right)
    return t


@pytest.mark.parametrize("seed", range(40))
def test_rules_that_feed_each_other(seed):
    r = random.Random(seed)
    rules = [("".join(r.choices("abé", k=r.randint(1, 4))), "".join(r.choices("abé", k=r.randint(0, 5)))) for _ in range(60)]
    fix = patterns.Corrector(rules)
    for _ in range(30):
        t = "".join(r.choices("abé \n", k=r.randint(0, 40)))
        assert fix(t) == one_by_one(rules, t)


def test_chains_repeats_and_long_rules():
    rules = [("b", "c"), ("a", "b"), ("b", "d"), ("x" * 600, "long"), ("longd", "!"), ("a", "never")]
    for t in ("aab", "x" * 600 + "a", "", "x" * 1300):
        assert patterns.Corrector(rules)(t) == one_by_one(rules, t)


def test_a_hundred_thousand_rules(spark):
    r = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rules = [("".join(r.choices(letters, k=r.randint(4, 9))), "".join(r.choices(letters, k=5))) for _ in range(100_000)]
    rows = [(i, " ".join(r.choice(rules)[0] if r.random() < 0.2 else "".join(r.choices(letters, k=6)) for _ in range(60)), i) for i in range(40)]
    df = spark.createDataFrame([*rows, (99, None, 0), (100, "", 0)], "id long, body string, rank long")
    got = patterns.correct(df, rules, "body")
    assert got.columns == df.columns
    found = {x["id"]: x["body"] for x in got.collect()}
    assert found[99] is None and found[100] == ""
    assert all(found[i] == one_by_one(rules, t) for i, t, _ in rows[:12])


@pytest.mark.parametrize(
    ("pattern", "literal"),
    [
        ("Jean.*KOFFI", "KOFFI"), (r"Th\. KOFFI", "Th. KOFFI"), ("Garde?s", "Gard"), ("a|b", ""), ("(Le|La) Garde", " Garde"), ("(?i)jean", ""),
        ("[Jj]ean", "ean"), ("ab+c", "ab"), ("x{2}yz", "yz"), (r"\bJean\s+K", "Jean"), ("\\" + "u0041b", ""), ("[]a]bc", "bc"), ("a.b", "a"), ("", ""), ("ab{0,2}", "a"), ("[a[b]]cd", ""),
    ],
)
def test_required_literals(pattern, literal):
    assert patterns.required_literal(pattern) == literal
    sample = {"Jean.*KOFFI": "Jean B. KOFFI", "Garde?s": "Gards", "[Jj]ean": "Jean", "ab+c": "abbbc", "x{2}yz": "xxyz"}.get(pattern)
    assert sample is None or (re.search(pattern, sample) and literal in sample)


@pytest.mark.parametrize("within", [False, True])
def test_signatories_like_the_expressions(spark, within):
    r = random.Random(2)
    names = [f"Nom{chr(97 + i % 26)}{i}" for i in range(300)]
    people = [
        {"pattern": p, "role": "R", "name": n, "start_date": "2000-01-01" if i % 3 else None, "end_date": f"20{10 + i % 10}-01-01" if i % 2 else None}
        for i, n in enumerate(names) for p in [n if i % 4 else f"(?i){n.lower()}", f"[A-Z]\\. ?{n}\\b"][: 1 + (i % 5 == 0)]
    ]
    rows = [(i, " ".join(f"{r.choice('AB')}. {r.choice(names)}" for _ in range(r.randint(0, 6))) + " le texte", f"20{10 + i % 15}-06-01") for i in range(60)]
    df = spark.createDataFrame([*rows, (99, None, "2011-01-01"), (100, "", None)], "id long, text string, day string")
    day = F.col("day").cast("date") if within else None
    got = patterns.with_signatories(df, people, day)
    want = df.withColumn("signatories", text.signatories(F.col("text"), people, day))
    pick = lambda rows: sorted((x["id"], [tuple(s.asDict().values()) for s in x["signatories"] or []]) for x in rows)
    order = ["role", "name", "mandate_start", "mandate_end", "order"]
    shape = F.transform("signatories", lambda s: F.struct(*[s[k].alias(k) for k in order]))
    a = pick(got.withColumn("signatories", shape).collect())
    b = pick(want.withColumn("signatories", shape).collect())
    assert a == b and any(s for _, s in a)

import hashlib
import re

import pytest

from lexmill.llm import content_sort

SCHEMA = "doc_id long, text string, kept string, keep_id long, row int"
SPACE = re.compile(r"[\x20\x09-\x0D]")
ROWS = [
    (1, "a b c", "x", 9, 1), (2, "abc", "y", 9, 2), (3, " a\tb\nc ", None, 9, 3), (4, None, "z", 9, 4), (5, "", "z", 9, 5),
    (6, " \r\n", None, None, 6), (7, "x" * 300_000, "w", 1, 7), (8, "x" * 150_000 + "\v" + "x" * 150_000, "w", 1, 8),
    (9, "a bc", "nbsp stays", 1, 9), (None, "abc", "no id", 1, 10), (2, "abc", "repeated", 9, 11), (10, "ABC", None, 0, 12),
    (11, "é b", None, 0, 13), (12, "éb", None, 0, 14), (13, "longer than a prefix of the text 1", None, 0, 15),
    (14, "longer than a prefix of the text 2", None, 0, 16),
]


def expected(rows):
    groups = {}
    for r in rows:
        groups.setdefault(SPACE.sub("", r[1] or ""), []).append(r)
    out = []
    for norm, group in groups.items():
        best = min(group, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        out += [(r[0], best[0], len(group), hashlib.sha256(norm.encode()).hexdigest()) for r in group]
    return sorted(out, key=repr)


@pytest.mark.parametrize("per_task", [None, 1, 2, 1000])
def test_groups_against_a_plain_version(spark, per_task):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = content_sort.exact_groups(df, per_task=per_task).collect()
    assert sorted(((r[0], r[1], r[2], r[4]) for r in got), key=repr) == expected(ROWS)
    kept = {r["text_sha256"]: [] for r in got}
    for r in got:
        if r["kept"]:
            kept[r["text_sha256"]].append(r)
    assert all(len(v) == 1 and v[0]["doc_id"] == v[0]["keep_id"] for v in kept.values())


@pytest.mark.parametrize("per_task", [None, 2])
def test_many_copies(spark, per_task):
    rows = [(i, "same text" if i % 3 else "one" + " " * (i % 7), "k", i, i) for i in range(600)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    got = content_sort.exact_groups(df, per_task=per_task).collect()
    assert sorted(((r[0], r[1], r[2], r[4]) for r in got), key=repr) == expected(rows)
    assert sum(r["kept"] for r in got) == 2


def test_rows_that_stay_keep_their_columns(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    kept = content_sort.deduplicate(df)
    assert kept.schema == df.schema
    rows = sorted(map(tuple, kept.collect()), key=repr)
    assert set(rows) <= set(ROWS) and len(rows) == 8
    assert [r[0] for r in rows if r[1] and SPACE.sub("", r[1]) == "abc"] == [3]


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert content_sort.exact_groups(df).count() == 0 and content_sort.deduplicate(df).count() == 0


def test_main_path_is_native_and_shuffles_the_text_once(spark):
    plan = content_sort.exact_groups(spark.createDataFrame(ROWS, SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.count("rangepartitioning") == 1 and "hashpartitioning" not in plan

"""Enumeration, chunking, repair planning and merging."""

import random

import pytest
from pyspark.sql import functions as F

from lexmill.operators import audit, chunking, upsert, words
from lexmill.operators import enumerate as enum


def cursor_walk(cursors, missing, per_cursor, total, max_number, min_year):
    """The enumeration rule, one number at a time."""
    taken, moved = [], []
    for pos, type_, year, number in cursors:
        quota = min(per_cursor, total - len(taken))
        if quota <= 0:
            moved.append((type_, year, number))
            continue
        n, count, last = number, 0, number
        while n > 0 and count < quota:
            last = n
            if (type_, year, n) not in missing:
                taken.append((type_, year, n))
                count += 1
            n -= 1
        nxt = last - 1
        if nxt > 0:
            moved.append((type_, year, nxt))
        elif year - 1 < min_year:
            moved.append((type_, min_year, 0))
        else:
            moved.append((type_, year - 1, max_number))
    return taken, moved


@pytest.mark.parametrize("seed", range(4))
def test_candidates_match_the_walk(spark, seed):
    rng = random.Random(seed)
    cursors = [(0, "loi", 2020, rng.randrange(1, 120)), (1, "decret", 1960, rng.randrange(1, 120))]
    missing = {(t, y, n) for _, t, y, top in cursors for n in range(1, top + 1) if rng.random() < 0.4}
    per_cursor, total = rng.choice([5, 20, 200]), rng.choice([8, 30, 500])
    cur = spark.createDataFrame(cursors, "cursor_pos int, document_type string, year int, number int")
    nf = spark.createDataFrame(sorted(missing) or [("loi", 1, 1)], "document_type string, year int, number int")
    got = enum.candidates(cur, nf, per_cursor, total, block=16)
    taken, moved = cursor_walk(cursors, missing, per_cursor, total, 2000, 1960)
    assert {tuple(r)[1:] for r in got.collect()} == set(taken)
    back = enum.advance_cursors(cur, got, 2000, 1960, per_cursor, total)
    assert {tuple(r)[1:] for r in back.collect()} == set(moved)


def test_cursor_vectors(spark):
    cur = spark.createDataFrame([(0, "loi", 2024, 5), (1, "decret", 1960, 1)], "cursor_pos int, document_type string, year int, number int")
    none = spark.createDataFrame([], "document_type string, year int, number int")
    got = enum.candidates(cur, none, 2000, 8000)
    assert sorted(r["number"] for r in got.where("document_type = 'loi'").collect()) == [1, 2, 3, 4, 5]
    moved = {r["document_type"]: (r["current_year"], r["current_number"]) for r in enum.advance_cursors(cur, got, 2000).collect()}
    assert moved == {"loi": (2023, 2000), "decret": (1960, 0)}


def test_start_cursors_reset_on_a_new_year(spark):
    stored = spark.createDataFrame(
        [("fetch-current", "loi", 2024, 0), ("fetch-previous", "decret", 1999, 7)],
        "cursor_type string, document_type string, current_year int, current_number int",
    )
    now = {r["document_type"]: (r["year"], r["number"]) for r in enum.start_cursors(stored, spark, "fetch-current", 2025, 2000).collect()}
    assert now == {"loi": (2025, 2000), "decret": (2025, 2000)}
    back = {r["document_type"]: (r["year"], r["number"]) for r in enum.start_cursors(stored, spark, "fetch-previous", 2024, 2000).collect()}
    assert back == {"loi": (2024, 2000), "decret": (1999, 7)}


def test_window_chunks_of_empty_texts(spark):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "x" * 25)], "id int, text string")
    rows = chunking.window_chunks(df, "id", 10, 2).orderBy("id", "chunk_index").collect()
    assert [(r["id"], r["chunk_index"], r["chunk"]) for r in rows] == [(1, 1, ""), (2, 1, None), (3, 1, "x" * 10), (3, 2, "x" * 10), (3, 3, "x" * 9)]


def test_paragraph_chunks(spark):
    def chunks(body, size, overlap):
        df = spark.createDataFrame([(1, body)], "id int, text string")
        rows = chunking.paragraph_chunks(df, "id", size, overlap).orderBy("chunk_index").collect()
        assert {r["total_chunks"] for r in rows} <= {len(rows)}
        return [r["chunk"] for r in rows]

    assert chunks("short", 10, 2) == ["short"]
    assert chunks("aaaa\n\nbbbb\n\ncccc", 11, 0) == ["aaaa\n\nbbbb", "cccc"]
    assert chunks("aaaa\n\nbbbb\n\ncccc", 11, 3) == ["aaaa\n\nbbbb", "bbb\n\n\n\ncccc"]
    assert chunks("abcdefghij", 4, 1) == ["abcd", "defg", "ghij", "j"]
    assert chunks("x\n\n" + "l1\nl2\nl3longer", 6, 0) == ["x", "l1\nl2", "l3long", "er"]
    with pytest.raises(ValueError):
        chunking.paragraph_chunks(spark.createDataFrame([(1, "x")], "id int, text string"), "id", 5, 5)


def test_chunks_without_overlap_lose_nothing(spark):
    rng = random.Random(5)
    bodies = [(i, "".join(rng.choice("ab \n") for _ in range(rng.randrange(0, 300)))) for i in range(60)]
    df = spark.createDataFrame(bodies, "id int, text string")
    out = {}
    for r in chunking.paragraph_chunks(df, "id", 40, 0).orderBy("id", "chunk_index").collect():
        assert len(r["chunk"]) <= 40
        out.setdefault(r["id"], []).append(r["chunk"])
    for i, body in bodies:
        assert "".join(out.get(i, [])).replace("\n", "") == body.replace("\n", "")


def test_article_chunks(spark):
    arts = [(i, "x" * 10) for i in range(1, 6)]
    df = spark.createDataFrame([("d", arts)], "id string, articles array<struct<index:int,content:string>>")
    sizes = F.transform("articles", lambda a: F.length(a["content"]).cast("long"))
    rows = chunking.article_chunks(df, "id", "articles", F.lit(5), 27, sizes).orderBy("chunk_index").collect()
    assert [[a["index"] for a in r["articles"]] for r in rows] == [[1, 2], [3, 4], [5]]


def test_joined_parts_are_whole(spark):
    df = spark.createDataFrame([("d", i, f"t{i}") for i in range(10)], "id string, p int, t string")
    rows = chunking.join_parts(df, ["id"], "p", "t", "|", per_row=4).orderBy("row_no").collect()
    assert "|".join(r["text"] for r in rows) == "|".join(f"t{i}" for i in range(10))


def planned(spark, status, pdf, ocr, json, recorded=False, **options):
    row = spark.createDataFrame(
        [("d", status, pdf, ocr, json, recorded, 0.9, 0, 0.1, 3)],
        "document_id string, status string, has_pdf boolean, has_ocr boolean, has_json boolean, is_recorded boolean, "
        "confidence double, sequence_issues int, unknown_rate double, n_articles int",
    )
    detectors = audit.status_issues() + audit.file_issues() + audit.quality_issues()
    out = audit.plan_repairs(audit.detect(row, detectors), **options).first()
    return [(f["issue_type"], f["fix_status"], f["status_after"]) for f in out["fixes"]], out["final_status"]


def test_repair_fold(spark):
    fixes, final = planned(spark, "EXTRACTED", False, False, False)
    assert [f[0] for f in fixes] == ["STUCK_IN_EXTRACTED", "MISSING_OCR", "MISSING_PDF", "MISSING_JSON"]
    assert [f[2] for f in fixes] == ["DOWNLOADED", "DOWNLOADED", "FETCHED", "DOWNLOADED"]
    assert final == "DOWNLOADED" and {f[1] for f in fixes} == {"SUCCESS"}
    fixes, final = planned(spark, "EXTRACTED", False, False, False, critical_first=True)
    assert [f[2] for f in fixes] == ["FETCHED", "DOWNLOADED", "DOWNLOADED", "FETCHED"] and final == "FETCHED"


def test_inconsistent_status_is_routed_only_on_request(spark):
    assert planned(spark, "FETCHED", True, False, False, True) == ([("STATUS_INCONSISTENT", "SKIPPED", "FETCHED")], "FETCHED")
    assert planned(spark, "FETCHED", True, False, False, True, route_inconsistent=True)[1] == "DOWNLOADED"
    assert planned(spark, "PENDING", False, False, False) == ([("STUCK_IN_PENDING", "SUCCESS", "PENDING")], "PENDING")


def test_keep_better(spark):
    schema = "document_id string, json string, confidence double, source string"
    old = spark.createDataFrame([("a", "o", 0.5, "x"), ("b", "o", 0.5, "x"), ("c", "o", 0.5, "x")], schema)
    new = spark.createDataFrame([("a", "n", 0.5, "y"), ("b", "n", 0.6, "y"), ("d", "n", 0.1, "y")], schema)
    got = {r["document_id"]: (r["json"], r["change"]) for r in upsert.keep_better(old, new).collect()}
    assert got == {"a": ("o", "skipped"), "b": ("n", "updated"), "c": ("o", "kept"), "d": ("n", "new")}
    again = upsert.keep_better(upsert.keep_better(old, new).drop("change"), new)
    assert {r["change"] for r in again.collect()} == {"skipped", "kept"}


def test_fetch_upsert_refreshes_rate_limited_only(spark):
    schema = "document_id string, status string"
    old = spark.createDataFrame([("a", "FETCHED"), ("b", "RATE_LIMITED")], schema)
    new = spark.createDataFrame([("a", "FAILED"), ("b", "FETCHED"), ("c", "FAILED")], schema)
    got = {r["document_id"]: (r["status"], r["change"]) for r in upsert.upsert_fetch_results(old, new).collect()}
    assert got == {"a": ("FETCHED", "skipped"), "b": ("FETCHED", "updated"), "c": ("FAILED", "new")}
    forced = {r["document_id"]: r["status"] for r in upsert.upsert_fetch_results(old, new, force=True).collect()}
    assert forced["a"] == "FAILED"


def test_status_updates(spark):
    reg = spark.createDataFrame([("a", "PENDING"), ("b", "FETCHED")], "document_id string, status string")
    ids_ = spark.createDataFrame([("b",), ("zz",)], "document_id string")
    assert {tuple(r) for r in upsert.record_errors(reg, ids_).collect()} == {("a", "PENDING"), ("b", "FAILED")}
    with pytest.raises(ValueError):
        upsert.move_status(reg, "PENDING", "NOPE")


def test_empty_dictionary_means_rate_zero(spark):
    texts = spark.createDataFrame([("d", "des mots quelconques"), ("e", "")], "id string, text string")
    none = spark.createDataFrame([], "word string")
    got = {r["id"]: (r["n_tokens"], r["unknown_rate"]) for r in words.word_quality(texts, none, "id").collect()}
    assert got == {"d": (3, 0.0), "e": (0, 0.0)}
    some = spark.createDataFrame([("des",), ("mots",)], "word string")
    got = {r["id"]: r["unknown_rate"] for r in words.word_quality(texts, some, "id").collect()}
    assert got["d"] == pytest.approx(1 / 3)


def test_unknown_words_are_counted_without_their_list(spark):
    """The same numbers with and without the list; no list and no sets of words in the shuffle without it."""
    texts = spark.createDataFrame([(1, "les mots mots Mots inconnus les"), (2, None), (3, "a b !"), (4, "connu connu")], "id int, text string")
    some = spark.createDataFrame([("les",), ("connu",)], "word string")
    short = words.word_quality(texts, some, "id", with_words=False)
    assert "collect" not in short._jdf.queryExecution().executedPlan().toString()
    got = {r["id"]: (r["n_tokens"], r["n_unknown"], r["n_unknown_words"]) for r in short.collect()}
    assert got == {1: (6, 4, 2), 2: (0, 0, 0), 3: (0, 0, 0), 4: (2, 0, 0)}
    whole = {r["id"]: (r["n_unknown_words"], sorted(r["unknown_words"])) for r in words.word_quality(texts, some, "id").collect()}
    assert whole == {1: (2, ["inconnus", "mots"]), 2: (0, []), 3: (0, []), 4: (0, [])}


def test_words_are_sorted_without_a_lambda(spark):
    """A sort with a lambda took most of the time of counting."""
    rows = [(1, "budget Loi budget été"), (2, None), (3, ""), (4, "xy zz"), (5, "Zoé zoé école"), (6, "loi")]
    counted = words.counted_words(spark.createDataFrame(rows, "id int, text string"), "id")
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert "sort_array(" in plan and "array_sort(" not in plan
    got = {r["id"]: [tuple(c) for c in r["counts"]] for r in counted.collect()}
    assert got == {1: [("budget", 2), ("loi", 1), ("été", 1)], 2: [], 3: [], 4: [], 5: [("zoé", 2), ("école", 1)], 6: [("loi", 1)]}

"""Sources, jobs and the store."""

import os

from pyspark.sql import functions as F

from lexmill.plans import jobs
from lexmill.schemas import TABLES, empty
from lexmill.sources import files, lookups
from lexmill.sources.tables import Change, StateTables
from lexmill.streaming import cycle

AS_OF = "2025-01-01 00:00:00"
BODY = "Article 1er : le premier contenu\nArticle 2 : le second contenu\nFait à Cotonou, le 3 mars 2020"


def write(path, body):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(body)


def test_files(spark, tmp_path):
    root = str(tmp_path)
    write(f"{root}/ocr/loi/loi-2020-1.txt", "ligne 1\nligne 2")
    write(f"{root}/articles/loi/loi-2020-1.json", '{"_metadata": {"confidence": 0.4,\n "source": "OCR"}, "articles": [{"index": 1, "content": "c"}]}')
    write(f"{root}/articles/loi/loi-2020-2.json", "{broken")
    write(f"{root}/articles/decret/decret-2020-3.json", '{"articles": []}')
    write(f"{root}/pdfs/loi/loi-2020-1.pdf", "%PDF-1.4")
    for n, body in ((4, '{"_metadata": {}}'), (5, '{"_metadata": {"timestamp": "x"}}'), (6, "[1]"), (7, " ")):
        write(f"{root}/articles/loi/loi-2020-{n}.json", body)
    assert [tuple(r) for r in files.read_texts(spark, root).collect()] == [("loi-2020-1", "loi", "ligne 1\nligne 2")]
    assert [r["document_id"] for r in files.read_json(spark, root).collect()] == ["loi-2020-1"]
    assert {r["document_id"] for r in files.unreadable_json(spark, root).collect()} == {"loi-2020-2", "decret-2020-3", "loi-2020-4", "loi-2020-5", "loi-2020-6", "loi-2020-7"}
    kinds = {tuple(r) for r in files.read_inventory(spark, root).collect()}
    assert ("loi-2020-1", "pdf", 8) in kinds and len(kinds) == 9
    assert {tuple(r) for r in files.read_inventory(spark, root, empty_files=False).collect()} == kinds
    assert bytes(files.read_payloads(spark, root).first()["content"]) == b"%PDF-1.4"


def test_inventory_of_empty_files_and_folders(spark, tmp_path):
    assert files.read_inventory(spark, f"{tmp_path}/none").collect() == []
    root = f"{tmp_path}/with space"
    write(f"{root}/pdfs/loi/loi-2020-1.pdf", "")
    write(f"{root}/pdfs/loi/loi-2020-2.pdf", "%PDF")
    write(f"{root}/pdfs/loi/loi-2020-3.txt", "of another kind")
    write(f"{root}/pdfs/loi/.loi-2020-4.pdf", "unfinished")
    write(f"{root}/pdfs/outside.pdf", "in no type's folder")
    (tmp_path / "with space/ocr/decret").mkdir(parents=True)
    got = {tuple(r) for r in files.read_inventory(spark, root).collect()}
    assert got == {("loi-2020-1", "pdf", 0), ("loi-2020-2", "pdf", 4)}


def test_files_written_by_tasks(spark, tmp_path):
    root = str(tmp_path)
    rows = [("loi-2020-1", "loi", "é\n"), ("loi-2020-2", "loi", None), ("../loi-2020-3", "loi", "out"), ("x-1-1", "x", "type"), (None, "loi", "no id"), ("decret-2020-4", "decret", "d")]
    df = spark.createDataFrame(rows, "document_id string, type string, content string").repartition(3)
    assert files.write_files(df, root, "ocr") == 3
    assert files.write_files(df.where("document_id = 'loi-2020-1'").withColumn("content", F.lit("new")), root, "ocr") == 1
    assert {tuple(r) for r in files.read_inventory(spark, root).collect()} == {("loi-2020-1", "ocr", 3), ("loi-2020-2", "ocr", 0), ("decret-2020-4", "ocr", 1)}
    assert {tuple(r) for r in files.read_texts(spark, root).collect()} == {("loi-2020-1", "loi", "new"), ("decret-2020-4", "decret", "d")}
    assert files.write_files(df.limit(0), root, "pdf") == 0


def test_sinks(spark, tmp_path):
    docs = spark.createDataFrame(
        [("loi", "EXTRACTED", '{"a":1}'), ("loi", "FAILED", '{"b":1}'), ("decret", "EXTRACTED", " ")], "type string, status string, json string"
    )
    files.write_documents(docs, f"{tmp_path}/out")
    assert [r["value"] for r in spark.read.text(f"{tmp_path}/out").collect()] == ['{"a":1}']
    found, known = spark.createDataFrame([("b",), ("a",), ("k",)], "word string"), spark.createDataFrame([("k",)], "word string")
    files.append_words(found, known, f"{tmp_path}/words")
    assert {r["word"] for r in spark.read.parquet(f"{tmp_path}/words").collect()} == {"a", "b"}
    files.write_word_counts(spark.createDataFrame([("a", 2), ("b", 3)], "word string, n long"), f"{tmp_path}/csv")
    assert [tuple(r) for r in spark.read.csv(f"{tmp_path}/csv", header=True).collect()] == [("b", "3"), ("a", "2")]


def test_lookups(spark, tmp_path):
    write(f"{tmp_path}/c.csv", "# rules\n\nwrong,right\nb , c,d\nx,\nwrong,last\n")
    assert lookups.correction_rules(spark, f"{tmp_path}/c.csv") == [("wrong", "last"), ("b", "c,d")]
    write(f"{tmp_path}/s.csv", "pattern,role,name,start,end\nJean.*K,P,Jean K,2016-04-06,\n([,P,bad\ntoo,short\nX,R,N,nope,2020-01-01\n")
    people = lookups.signatory_patterns(spark, f"{tmp_path}/s.csv")
    assert [(p["name"], p["start_date"], p["end_date"]) for p in people] == [("Jean K", "2016-04-06", None), ("N", None, "2020-01-01")]
    write(f"{tmp_path}/d.txt", "Mot\n mot \n\nautre\n")
    assert {r["word"] for r in lookups.words(spark, f"{tmp_path}/d.txt").collect()} == {"mot", "autre"}
    assert lookups.words(spark, None).count() == 0


def test_steps_of_a_batch_share_a_table_and_a_repeat_loses_nothing(spark, tmp_path):
    store = StateTables(spark, str(tmp_path))

    def add(word):
        row = spark.createDataFrame([(word,)], "word string")
        return lambda s: {"unrecognized_words": Change(row, append=True)}

    def words():
        return sorted(r["word"] for r in store.read("unrecognized_words").collect())

    assert set(cycle.run_cycle(store, [("one", add("a")), ("two", add("b"))], version=5).values()) == {"ok"}
    assert words() == ["a", "b"]
    cycle.run_cycle(store, [("one", add("c")), ("two", add("d"))], version=6)
    cycle.run_cycle(store, [("one", add("c")), ("two", add("d"))], version=6)
    assert words() == ["a", "b", "c", "d"]


def test_daily_steps_run_once_a_day(spark, tmp_path):
    store, runs = StateTables(spark, str(tmp_path)), []
    steps = [("daily-x", lambda s: runs.append(1) or {}), ("always", lambda s: {})]
    for version, today in enumerate(["2025-01-01", "2025-01-01", "2025-01-02"]):
        outcome = cycle.run_cycle(store, steps, version, today)
    assert len(runs) == 2 and outcome == {"daily-x": "ok", "always": "ok"}


def test_started_cycle_drives_the_steps(spark, tmp_path):
    store = StateTables(spark, f"{tmp_path}/store")
    spark.createDataFrame([("n1",), ("n2",)], "word string").coalesce(1).write.parquet(f"{tmp_path}/in")
    arrivals = spark.readStream.schema("word string").parquet(f"{tmp_path}/in")

    def on_batch(batch, n):
        step = lambda s: {"unrecognized_words": Change(batch, append=True)}
        assert cycle.run_cycle(store, [("words", step)], n + 1) == {"words": "ok"}

    cycle.start_cycle(arrivals, on_batch, f"{tmp_path}/cp", availableNow=True).awaitTermination()
    assert store.read("unrecognized_words").count() == 2


def test_cursor_waits_for_ids_without_a_probe(spark):
    fetch = jobs.FetchOptions(year=2025, max_number=3, base_url="http://x", max_per_run=None)
    probes = spark.createDataFrame([("loi-2024-3", 1, 200, False), ("loi-2024-1", 1, 200, False)], "document_id string, attempt int, code int, padded boolean")
    state = {t: empty(spark, t) for t in ("registry", "fetch_results", "cursors", "not_found")}
    out = jobs.run_fetch(*state.values(), probes, AS_OF, fetch)
    assert {r["document_id"] for r in out["fetch_results"].collect()} == {"loi-2024-3", "loi-2024-1"}
    at = {r["document_type"]: (r["current_year"], r["current_number"]) for r in out["cursors"].collect()}
    assert at == {"loi": (2024, 2), "decret": (2024, 3)}


def test_cursor_above_a_million(spark):
    cursors = spark.createDataFrame([("fetch-previous", "loi", 2024, 1_500_000, None)], TABLES["cursors"])
    found, moved = jobs.plan_fetch(cursors, empty(spark, "not_found"), jobs.FetchOptions(year=2025, max_number=2, max_per_run=None))
    top = found.where("type = 'loi'").agg(F.min("number"), F.max("number"), F.count("*")).first()
    assert tuple(top) == (1, 1_500_000, 1_500_000)
    assert {(r["document_type"], r["current_year"], r["current_number"]) for r in moved.collect()} == {("loi", 2023, 2), ("decret", 2023, 2)}


def feeds(spark):
    ids_ = ["loi-2024-1", "loi-2024-2", "decret-2024-1", "decret-2024-2"]
    probes = [("loi-2024-1", 1, 429), ("loi-2024-1", 2, 200), ("loi-2024-2", 1, 404), ("decret-2024-1", 1, 200), ("decret-2024-2", 1, 429)]
    dictionary = "article premier second contenu fait mars cotonou"
    return {
        "probe_results": spark.createDataFrame([(d, a, c, False) for d, a, c in probes], "document_id string, attempt int, code int, padded boolean"),
        "payloads": spark.createDataFrame([(d, bytearray(b"%PDF")) for d in ids_], "document_id string, content binary"),
        "texts": spark.createDataFrame([("loi-2024-1", "loi", BODY), ("decret-2024-1", "decret", "rien")], TABLES["texts"]),
        "inventory": spark.createDataFrame([], TABLES["inventory"]),
        "dictionary": spark.createDataFrame([(w,) for w in dictionary.split()], "word string"),
    }


def test_cycle_end_to_end(spark, tmp_path):
    store = StateTables(spark, str(tmp_path))
    fetch = jobs.FetchOptions(year=2025, max_number=2, base_url="http://x")
    steps = cycle.default_steps(feeds(spark), AS_OF, fetch, fetch_current=False)
    outcome = cycle.run_cycle(store, steps[:4])
    assert set(outcome.values()) == {"ok"}, outcome
    status = {r["document_id"]: r["status"] for r in jobs.with_ids(store.read("registry")).collect()}
    assert status == {"loi-2024-1": "CONSOLIDATED", "loi-2024-2": "FAILED", "decret-2024-1": "FAILED", "decret-2024-2": "RATE_LIMITED"}
    gone = {(r["document_type"], r["number"]) for r in store.read("not_found").collect()}
    assert gone == {("loi", 2)}  # a rate-limited id is not missing
    arts = {(r["document_id"], r["article_index"]) for r in store.read("consolidated_articles").collect()}
    assert arts == {("loi-2024-1", 1), ("loi-2024-1", 2)}
    meta = store.read("consolidated_metadata").first()
    assert meta["promulgation_city"] == "Cotonou" and meta["promulgation_date"] == "2020-03-03"
    cursors = {r["document_type"]: (r["current_year"], r["current_number"]) for r in store.read("cursors").collect()}
    assert cursors == {"loi": (2023, 2), "decret": (2023, 2)}

    before = {t: sorted(map(repr, store.read(t).collect())) for t in ("consolidated_articles", "extractions", "download_results")}
    assert set(cycle.run_cycle(store, steps[1:4]).values()) == {"ok"}
    after = {t: sorted(map(repr, store.read(t).collect())) for t in before}
    assert before == after


def test_failing_step_does_not_stop_the_rest(spark, tmp_path):
    store = StateTables(spark, str(tmp_path))

    def broken(_):
        raise RuntimeError("boom")

    words = spark.createDataFrame([("a",)], "word string")
    outcome = cycle.run_cycle(store, [("bad", broken), ("good", lambda s: {"unrecognized_words": words})])
    assert outcome["bad"].startswith("RuntimeError") and outcome["good"] == "ok"
    assert cycle.due_today(spark.createDataFrame([("fetch", "2025-01-01")], "job string, day string"), "fetch", "2025-01-02")


def test_full_run_for_named_documents(spark):
    tables = {t: empty(spark, t) for t in TABLES} | feeds(spark)
    wanted = spark.createDataFrame([("loi-2024-1",), ("bad id",)], "document_id string")
    out = jobs.run_full(tables, wanted, AS_OF)
    assert [(r["number"], r["status"]) for r in out["registry"].collect()] == [(1, "CONSOLIDATED")]
    assert out["consolidated_articles"].count() == 2


def test_fix_run(spark):
    reg = spark.createDataFrame([("loi", 2020, 1, None, None, None, None, True, "DOWNLOADED"), ("loi", 2020, 2, None, None, None, None, True, "FAILED")], TABLES["registry"])
    args = [empty(spark, t) for t in ("inventory", "download_results", "extractions")]
    out = jobs.run_fix(reg, *args)
    assert {(r["number"], r["status"]) for r in out["registry"].collect()} == {(1, "FETCHED"), (2, "FAILED")}
    kept = jobs.run_fix(reg, *args, stuck=F.lit(False))["fix_results"]
    assert [r["issue_type"] for r in kept.collect()] == ["MISSING_PDF"]


def test_consolidation_parses_the_json_once(spark, monkeypatch):
    from lexmill.catalog.job_queries import consolidate_run
    from lexmill.operators import consolidate

    calls, plain = [], consolidate.parse
    monkeypatch.setattr(consolidate, "parse", lambda *a: calls.append(1) or plain(*a))
    assert consolidate_run(spark, "/root/testdata/sf0.001").count() > 0
    assert len(calls) == 1


def test_quality_figures_parse_each_level_once(spark):
    json = ['{"_metadata": {"confidence": 0.5, "sequenceIssues": {"gaps": 1, "duplicates": 2, "outOfOrder": 3}}, "articles": [{"index": 1}]}',
            '{"_metadata": {"unrecognizedWordsRate": "0.25"}, "articles": [{"index": 1}, {"index": 4}, {"index": 4}, {"index": 2}]}', "{broken", None]
    df = jobs.quality_figures(spark.createDataFrame([(str(i), j) for i, j in enumerate(json)], "document_id string, json string"))
    rows = {r["document_id"]: tuple(r)[1:] for r in df.collect()}
    assert rows == {"0": (0.5, 6, None, 1), "1": (None, 4, 0.25, 4), "2": (None, None, None, 0), "3": (None, None, None, 0)}
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") <= 4

"""Stored tables: only the partitions of a batch are read and written."""

import os

import pytest
from pyspark.sql import functions as F

from lexmill.operators import upsert
from lexmill.plans import batches
from lexmill.schemas import TABLES
from lexmill.sources.tables import Change, StateTables, parts_by_id, parts_of


def extractions(spark, rows):
    return spark.createDataFrame([(i, "{}", float(c), s) for i, c, s in rows], TABLES["extractions"])


@pytest.fixture
def store(spark, tmp_path):
    store = StateTables(spark, str(tmp_path))
    rows = [(f"{t}-{y}-{n}", 0.5, "old") for t in ("loi", "decret") for y in (2000, 2001, 2002) for n in range(3)]
    store.write("extractions", extractions(spark, [*rows, ("odd", 0.5, "old"), ("loi-x-1", 0.5, "old")]))
    return store


def files(store, name):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(f"{store.root}/{name}") for f in names if f.endswith(".parquet")
    }


def confidences(store):
    return {r["document_id"]: r["confidence"] for r in store.read("extractions").collect()}


def test_a_merge_reads_and_replaces_its_partitions_only(spark, store):
    incoming = extractions(spark, [("loi-2001-1", 0.9, "new"), ("loi-2001-2", 0.1, "new"), ("decret-2005-1", 0.7, "new")])
    before = files(store, "extractions")
    change = batches.merge(store, "extractions", incoming, ["document_id"], upsert.better_by_confidence())
    assert change.parts == {("loi", 2001), ("decret", 2005)}
    names = store.read("extractions", change.parts).select(F.input_file_name().alias("f")).distinct().collect()
    read = {r["f"].split("extractions/")[1].rsplit("/", 1)[0] for r in names}
    assert read == {"type=loi/year=2001"}
    plan = change.rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((" in plan and "2001" in plan.split("PartitionFilters")[1]
    store.apply({"extractions": change})
    after = files(store, "extractions")
    changed = {f.split("extractions/")[1].rsplit("/", 1)[0] for f in before.keys() ^ after.keys()}
    assert changed == {"type=loi/year=2001", "type=decret/year=2005"} and all(after[f] == before[f] for f in before.keys() & after.keys())
    found = confidences(store)
    assert (found["loi-2001-1"], found["loi-2001-2"], found["decret-2005-1"], len(found)) == (0.9, 0.5, 0.7, 21)
    store.apply({"extractions": batches.merge(store, "extractions", incoming, ["document_id"], upsert.better_by_confidence())})
    assert confidences(store) == found  # the same batch again


def test_ids_that_cannot_be_parsed_have_a_partition(spark, store):
    incoming = extractions(spark, [("odd", 0.8, "new"), ("loi-x-1", 0.8, "new"), ("strange id", 0.3, "new")])
    assert parts_by_id(incoming) == {(None, None), ("loi", None)}
    store.apply({"extractions": batches.merge(store, "extractions", incoming, ["document_id"], upsert.always)})
    found = confidences(store)
    assert (found["odd"], found["loi-x-1"], found["strange id"], len(found)) == (0.8, 0.8, 0.3, 21)


def test_a_partition_can_lose_all_its_rows(spark, store):
    gone = spark.createDataFrame([("loi-2000-0",), ("loi-2000-1",), ("loi-2000-2",), ("decret-2000-1",), ("odd",)], "document_id string")
    store.apply(batches.delete(store, gone, ("extractions",)))
    assert len(confidences(store)) == 15 and ("loi", 2000) not in parts_of(store.placed("extractions", store.read("extractions")))
    store.apply(batches.delete(store, gone, ("extractions",)))
    assert len(confidences(store)) == 15


def test_a_failed_step_changes_no_table(spark, store):
    before = files(store, "extractions")
    bad = store.read("extractions").withColumn("json", F.raise_error(F.lit("bad row")))
    with pytest.raises(Exception, match="bad row"):
        store.apply({"extractions": Change(extractions(spark, [("loi-2000-0", 1, "new")])), "fetch_results": store.read("fetch_results"), "download_results": Change(bad.select(
            "document_id", *[F.col("json").cast(k).alias(c) for c, k in (x.split() for x in TABLES["download_results"].split(", ")[1:])]))})
    assert files(store, "extractions") == before
    with pytest.raises(ValueError, match="outside"):
        store.apply({"extractions": Change(extractions(spark, [("loi-2001-0", 1, "new")]), frozenset({("loi", 2000)}))})
    assert files(store, "extractions") == before


def test_tables_without_partitions_and_absent_ones(spark, store):
    assert store.read("registry").count() == 0 and store.parts("registry") == frozenset()
    row = spark.createDataFrame([("a",)], "word string")
    store.append("unrecognized_words", row)
    store.write("unrecognized_words", store.read("unrecognized_words").unionByName(row))  # reads what it replaces
    assert store.read("unrecognized_words").count() == 2


def test_consolidation_reads_the_years_that_wait(spark, store):
    rows = [("loi", y, n, "u", None, None, None, True, s) for y, n, s in ((2000, 0, "CONSOLIDATED"), (2001, 1, "EXTRACTED"), (2001, 2, "FAILED"))]
    store.write("registry", spark.createDataFrame(rows, TABLES["registry"]))
    json = '{"_metadata": {"confidence": 0.8, "source": "OCR", "timestamp": "t"}, "articles": [{"index": 1, "content": "c"}]}'
    store.write("extractions", spark.createDataFrame([(f"loi-{y}-{n}", json, 0.8, "OCR") for y in (2000, 2001) for n in range(3)], TABLES["extractions"]))
    before = files(store, "registry")
    changes = batches.consolidate(store, "2025-01-01 00:00:00")
    assert all(c.parts == {("loi", 2001)} for c in changes.values())
    store.apply(changes)
    assert {(r["year"], r["number"]): r["status"] for r in store.read("registry").collect()} == {(2000, 0): "CONSOLIDATED", (2001, 1): "CONSOLIDATED", (2001, 2): "FAILED"}
    assert [r["document_id"] for r in store.read("consolidated_articles").collect()] == ["loi-2001-1"]
    assert {f for f in files(store, "registry") if "year=2000" in f} == {f for f in before if "year=2000" in f}

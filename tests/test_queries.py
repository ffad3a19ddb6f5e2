"""Every query with a SQL counterpart must give the same rows on the small tables."""

import importlib.util
import os
import re

import pytest

import __spark_entry__ as entry
from lexmill import catalog

SF_DIR = "/root/testdata/sf0.001"
_path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools", "compare.py")
_spec = importlib.util.spec_from_file_location("compare", _path)
compare = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(compare)


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


catalog.load()


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are absent")
@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, name):
    ok, info = compare.compare(spark, con, SF_DIR, name)
    assert ok, info


def test_catalogue():
    names, oracles = set(entry.queries()), set(entry.oracle_sql())
    assert oracles <= names
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert all(re.fullmatch(r"[a-z0-9_]+", n) for n in names)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "document_id" and df.count() > 0

"""Queries with SQL against that SQL on the smallest tables."""

import importlib.util
import os

import pytest

from lexmill.llm import queries

SMALL = "/root/testdata/sf0.001"
_root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
_spec = importlib.util.spec_from_file_location("compare", os.path.join(_root, "tools", "compare.py"))
compare = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(compare)


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver tables are absent")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, name):
    ok, info = compare.compare(spark, compare.connect(SMALL), SMALL, name)
    assert ok, info


def test_sql_is_given_where_it_can_be():
    assert set(queries.QUERIES) - set(queries.ORACLES) == {
        "op1_lattice_scores", "op3_language_id", "op5_pack_best_fit", "op6_license_scan", "op7_simhash_groups", "op11_secret_scan",
    }

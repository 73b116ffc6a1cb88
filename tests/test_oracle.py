"""Every registered query against DuckDB over the same tables."""

import pytest

import __spark_entry__ as entry_module
import compare
from conftest import SMALL


@pytest.fixture(scope="module")
def duck():
    con = compare.connect(SMALL)
    yield con
    con.close()


@pytest.mark.parametrize("name", list(entry_module.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    expected = compare.duck_rows(duck, entry_module.oracle_sql()[name])
    got = compare.spark_rows(entry_module.queries()[name](spark, SMALL))
    assert got[0] == expected[0]
    assert got[1] == expected[1]


def test_entry_has_rows(spark):
    assert not entry_module.entry(spark).isEmpty()


def test_every_report_query_has_sql():
    queries = entry_module.queries()
    reports = {n for n, run in queries.items() if run.__module__.startswith("reportloom.queries")}
    assert reports <= entry_module.oracle_sql().keys() <= queries.keys()

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
import verify
from funnelmart import registry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con() -> duckdb.DuckDBPyConnection:
    return verify.database(FOLDER)


def test_every_query_has_a_statement():
    assert set(registry.queries()) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", entry.oracle_sql())
def test_query_agrees_with_its_statement(spark, con, name):
    same, note = verify.compare(spark, con, FOLDER, name)
    assert same, note


def test_flagship(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["funnel_stage", "leads_count"]
    assert rows.count() > 5

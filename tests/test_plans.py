"""Physical plans: what is read, shuffled and broadcast."""

from __future__ import annotations

import re

import pytest

from funnelmart import registry
from funnelmart.plans import facts
from funnelmart.plans.kpis import KPIS
from funnelmart.plans.warehouse import EXPORTS

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def wh(spark):
    return registry.warehouse(spark, FOLDER)


def plan(df, capsys) -> str:
    df.explain("formatted")
    return capsys.readouterr().out


def test_latest_version_reduces_before_its_only_shuffle(wh, capsys):
    text = plan(wh.plan("latest_lead"), capsys)
    tree = text.split("\n\n\n")[0]
    assert len(re.findall(r"Exchange \(", tree)) == 1
    before = tree[tree.index("Exchange ("):]
    assert "SortAggregate" in before, "one row per lead and map task is shuffled"
    assert "Arguments: hashpartitioning(lead_id" in text
    assert re.search(r"Arguments: \[lead_id#\w+ ASC NULLS FIRST\], false", text), "sorted by lead only"


def test_dimension_reads_one_column_and_hashes_it(wh, capsys):
    from funnelmart.plans.dimensions import MEMBERS

    members = MEMBERS["dim_lead_status"][0](wh.table("stg_leads"), wh.table("stg_sales"))
    text = plan(members, capsys)
    assert "ReadSchema: struct<status_name:string>" in text
    assert "IsNotNull(status_name)" in text
    assert "HashAggregate" in text and "SortAggregate" not in text


def test_lead_fact_shuffles_once_when_dimensions_are_small(wh, capsys):
    text = plan(wh.plan("fact_lead"), capsys)
    tree = text.split("\n\n\n")[0]
    assert tree.count("BroadcastHashJoin LeftOuter") == 13
    assert "SortMergeJoin" not in text
    assert len(re.findall(r"Arguments: hashpartitioning\(lead_id", text)) == 1


def test_large_dimensions_are_not_broadcast_whole(spark, wh, capsys):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = facts.fact_lead(wh.table("stg_leads"), wh.table, broadcast_bytes=1000)
        text = plan(rows, capsys)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))
    assert "SortMergeJoin LeftOuter" in text
    assert "_bucket" in text


@pytest.mark.parametrize("name", KPIS)
def test_kpis_read_few_columns_and_join_no_cross(wh, name, capsys):
    text = plan(KPIS[name](wh.table), capsys)
    assert "Cartesian" not in text and "NestedLoop" not in text
    fact_scans = re.findall(r"Location: .*fact_\w+\]\n(?:.*\n)*?ReadSchema: struct<(.*)>", text)
    assert fact_scans
    assert all(scan.count(":") <= 5 for scan in fact_scans)


def test_no_python_in_any_plan(spark, wh, capsys):
    for name, query in registry.queries().items():
        text = plan(query(spark, FOLDER), capsys)
        assert "Python" not in text and "InPandas" not in text, name
        assert "Cartesian" not in text and "NestedLoop" not in text, name


def test_exports_are_stored_once_per_application(spark, wh):
    assert registry.warehouse(spark, FOLDER + "/") is wh
    assert set(EXPORTS) <= set(wh._stored)


def test_latest_leads_are_found_once_however_large_the_dimensions(spark, wh, capsys):
    """With no broadcasts, hot values and all thirteen joins read the same stored latest leads."""
    stored = []

    def store(rows):
        stored.append(plan(rows, capsys))
        path = wh.store.scratch("test-latest")
        rows.write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = facts.fact_lead(wh.table("stg_leads"), wh.table, broadcast_bytes=0, store=store)
        text = plan(rows, capsys)
        small = sorted(map(tuple, wh.plan("fact_lead").collect()), key=repr)
        assert sorted(map(tuple, rows.collect()), key=repr) == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))
    tree = stored[0].split("\n\n\n")[0]
    assert len(stored) == 1 and len(re.findall(r"Exchange \(", tree)) == 1, "one aggregate, stored"
    assert not re.search(r"Arguments: hashpartitioning\(lead_id", text) and "budget" in text
    joins = [part for part in text.split("\n\n") if re.match(r"\(\d+\) Exchange", part) and "budget" in part]
    assert len(joins) == 1, "whole rows travel once, their match values alone before"


def test_sale_fact_agrees_without_broadcasts(spark, wh):
    def store(rows):
        path = wh.store.scratch("test-sales")
        rows.write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    rows = facts.fact_sale(wh.table("stg_sales"), wh.table, broadcast_bytes=0, store=store)
    assert sorted(map(tuple, rows.collect()), key=repr) == sorted(map(tuple, wh.plan("fact_sale").collect()), key=repr)

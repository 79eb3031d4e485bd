from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from conftest import at
from funnelmart.functions.numbers import average, percentage
from funnelmart.operators.calendar import calendar
from funnelmart.operators.dense_key import with_dense_key
from funnelmart.operators.latest import latest_versions
from funnelmart.operators.lookup import HOT_SHARE, Lookup, attach_keys, hot_values

VERSIONS = "id int, updated timestamp_ntz, created timestamp_ntz, note string"
TIMES = ["updated", "created"]


def test_latest_version(spark):
    rows = [
        (1, at("2020-01-01"), at("2019-01-01"), "old"), (1, at("2021-01-01"), None, "new"),
        (2, None, at("2020-05-05"), "created later"), (2, at("2020-05-04"), at("2019-01-01"), "updated"),
        (3, None, None, "undated"), (3, None, at("2010-01-01"), "dated"),
        (4, None, None, "b"), (4, None, None, "a"),
        (5, at("2020-01-01"), None, "z"), (5, at("2020-01-01"), None, None),
    ]
    for order in (rows, rows[::-1]):
        latest = latest_versions(spark.createDataFrame(order, VERSIONS), "id", TIMES)
        assert {r.id: r.note for r in latest.collect()} == {
            1: "new", 2: "created later", 3: "dated", 4: "a", 5: None,
        }


def test_latest_version_with_one_entity_holding_a_third_of_the_rows(spark):
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("int").alias("id"),
        F.lit(None).cast("timestamp_ntz").alias("updated"),
        F.expr("timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(0, 0, 0, id)").alias("created"),
        F.col("id").cast("string").alias("note"),
    )
    latest = latest_versions(rows, "id", TIMES).collect()
    assert len(latest) == 20001
    assert {r.note for r in latest if r.id == 0} == {"29997"}


def test_calendar(spark):
    days = {r.full_date: r for r in calendar(spark, "2010-01-01", "2040-12-31").collect()}
    assert len(days) == 11323
    first = days[datetime.date(2010, 1, 1)]
    assert tuple(first)[0] == 20100101 and tuple(first)[2:] == (
        2010, 1, 1, "January", 1, 6, "Friday", 53, 1,
    )
    assert days[datetime.date(2024, 2, 29)].day_name == "Thursday"
    assert days[datetime.date(2024, 2, 29)].is_weekend == 0
    assert days[datetime.date(2040, 12, 31)].date_key == 20401231
    sunday = days[datetime.date(2024, 3, 3)]
    assert (sunday.day_of_week, sunday.week_of_year, sunday.is_weekend) == (1, 9, 0)


@pytest.mark.parametrize("members", [0, 1, 5000])
def test_dense_key_counts_in_natural_order(spark, tmp_path, members):
    values = [f"m{i:05d}" for i in range(members)] + ([None] if members else [])
    random.Random(1).shuffle(values)
    rows = spark.createDataFrame([(v,) for v in values], "name string").repartition(7)
    keyed = with_dense_key(rows, "k", ["name"], str(tmp_path / "m")).collect()
    ordered = sorted(values, key=lambda v: (v is not None, v or ""))
    assert {r.k: r.name for r in keyed} == {i + 1: v for i, v in enumerate(ordered)}


def test_dense_key_over_many_partitions(spark, tmp_path):
    """Without coalescing, keys still run through all range partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(20000).select((F.col("id") * 7919 % 20011).alias("v"))
        keyed = with_dense_key(rows, "k", ["v"], str(tmp_path / "m"))
        assert spark.read.parquet(str(tmp_path / "m")).select(F.shiftright("_place", 33)).distinct().count() > 4
        pairs = sorted((r.k, r.v) for r in keyed.collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [k for k, _ in pairs] == list(range(1, 20001))
    assert [v for _, v in pairs] == sorted(v for _, v in pairs)


@pytest.fixture
def skewed(spark):
    """A third of the rows has key 7, a third has none, the rest is spread; 5,000 has no member."""
    rows = spark.range(30000).select(
        F.col("id").alias("row"),
        F.expr("case id % 3 when 0 then 7 when 1 then null else id % 6000 end").alias("v"),
        F.expr("case id % 3 when 0 then 'Hot' when 1 then null else concat('n', id % 900) end").alias("t"),
    )
    members = spark.range(5000).select((F.col("id") + 100).alias("k"), F.col("id").alias("v"))
    names = members.select("k", F.concat(F.lit("N"), "v").alias("name")).unionAll(
        spark.sql("select 1L as k, 'HOT' as name")
    )
    return rows, [
        Lookup("vk", members, "k", "v", "v"),
        Lookup("tk", names, "k", "lower(name)", "lower(t)"),
    ]


def test_lookup_gives_the_same_by_broadcast_and_by_shuffle(skewed):
    rows, lookups = skewed
    small = attach_keys(rows, lookups, "row")
    large = attach_keys(rows, lookups, "row", broadcast_bytes=0)
    assert sorted(small.columns) == sorted(large.columns) == ["row", "t", "tk", "v", "vk"]
    as_rows = lambda df: sorted(tuple(r) for r in df.select("row", "vk", "tk").collect())
    found = as_rows(large)
    assert found == as_rows(small)
    assert len(found) == 30000
    for row, vk, tk in found:
        v = {0: 7, 1: None}.get(row % 3, row % 6000)
        assert vk == (v + 100 if v is not None and v < 5000 else None)
        assert tk == {0: 1, 1: None}.get(row % 3, row % 900 + 100)


def test_hot_values_are_few_and_complete(skewed):
    rows, lookups = skewed
    hot = hot_values(rows, lookups)
    assert 7 in hot["vk"] and "hot" in hot["tk"]
    assert all(len(values) <= 1 / HOT_SHARE + 1 for values in hot.values())


def test_shuffled_lookup_spreads_hot_and_null_rows(spark, skewed):
    """No task of the shuffle join holds much more than its share of the rows."""
    rows, lookups = skewed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = attach_keys(rows, lookups[:1], "row", broadcast_bytes=0)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(r["count"] for r in sizes) < 30000 / 8 * 1.5


def test_lookup_of_several_keys_per_value_takes_the_smallest(spark):
    source = spark.createDataFrame([(3, 1), (2, 1), (5, 2)], "k bigint, id int")
    rows = spark.createDataFrame([(1, 1), (2, 2), (3, 9)], "row int, id int")
    lookup = Lookup("key", source, "k", "id", "id", unique=False)
    for limit in (0, 1 << 20):
        found = attach_keys(rows, [lookup], "row", broadcast_bytes=limit)
        assert sorted(tuple(r) for r in found.select("row", "key").collect()) == [
            (1, 2), (2, 5), (3, None)
        ]


@pytest.mark.parametrize("part, whole, expected", [
    (1, 3, "33.33"), (2, 3, "66.67"), (1, 8, "12.50"), (12345, 100000, "12.35"), (0, 5, "0.00"),
    (5, 0, None), (7, 2, "350.00"), (10**9 * 2 - 1, 10**9 * 2 * 100, "1.00"), (None, 4, None),
    (12344999999, 10**11, "12.34"),
])
def test_percentage(spark, part, whole, expected):
    row = spark.createDataFrame([(part, whole)], "p bigint, w bigint").select(
        percentage(F.col("p"), F.col("w")).alias("pct")
    ).first()
    assert (None if row.pct is None else str(row.pct)) == expected


def test_average(spark):
    row = spark.sql("select cast(10 as decimal(28,2)) t, 3L n, 0L z").select(
        average(F.col("t"), F.col("n")).alias("a"), average(F.col("t"), F.col("z")).alias("b")
    ).first()
    assert str(row.a) == "3.333333" and row.b is None

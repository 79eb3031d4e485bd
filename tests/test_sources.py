from __future__ import annotations

import datetime
from decimal import Decimal

import pytest

from funnelmart.schemas import DIMENSIONS, RAW_LEADS, RAW_SALES
from funnelmart.session import shared_folder
from funnelmart.sources.exports import MALFORMED, conform, read_export
from funnelmart.sources.tables import TableStore, reconcile


def test_csv_export_is_read_by_name_and_leniently(spark, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text(
        "lead_id,id,unit_value,property_type,extra,date_of_reservation,area_id,sale_category\n"
        '12.0,1,"1000.555",Villa,x,2024-02-29 10:30:00,7,"Resale, ""Buyer"""\n'
        "abc,2,n/a,,y,not a date,,  padded  \n"
    )
    rows = read_export(spark, str(path), RAW_SALES, "csv", fill_missing=True).orderBy("id").collect()
    first, second = rows
    assert list(first.asDict()) == [*RAW_SALES.names, MALFORMED]
    assert (first.id, first.lead_id, first.area_id) == (1, 12, 7)
    assert first.unit_value == Decimal("1000.56")
    assert first.date_of_reservation == datetime.datetime(2024, 2, 29, 10, 30)
    assert first.sale_category == 'Resale, "Buyer"'
    assert (second.lead_id, second.unit_value, second.property_type) == (None, None, None)
    assert second.date_of_reservation is None


def test_parquet_export_with_floating_ids(spark, tmp_path):
    path = str(tmp_path / "leads")
    spark.sql("select 5 as id, 17.0D as user_id, cast('NaN' as double) as area_id, 'x' as campaign").write.parquet(path)
    row = read_export(spark, path, RAW_LEADS, fill_missing=True).first()
    assert (row.id, row.user_id, row.area_id, row.campaign) == (5, 17, None, "x")


def test_conform_defaults_and_required_columns(spark):
    table = DIMENSIONS["dim_lead_status"]
    rows = spark.sql(
        "select 1 as lead_status_key, 's' as raw_status_name, 'n' as normalized_status, "
        "'f' as funnel_stage, cast(null as int) as is_won"
    )
    row = conform(rows, table).first()
    assert (row.is_won, row.is_lost, row.is_active) == (0, 0, 1)
    assert conform(rows, table).schema.simpleString() == table.struct.simpleString()
    with pytest.raises(ValueError, match="raw_status_name"):
        conform(rows.drop("raw_status_name"), table)


def test_replace_overwrites_and_reconcile_reports(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.replace("t", spark.range(5))
    stored = store.replace("t", spark.range(3))
    assert sorted(r.id for r in store.read("t").collect()) == [0, 1, 2]
    report = reconcile({"a": (spark.range(3), stored), "b": (spark.range(4), stored)})
    found = {(r.table_name, r.source_rows, r.target_rows, r.null_ids, r.complete) for r in report.collect()}
    assert found == {("a", 3, 3, 0, 1), ("b", 4, 3, 0, 0)}


def test_empty_table_keeps_its_columns(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    stored = store.replace("t", spark.range(5).where("id > 9"))
    assert stored.columns == ["id"] and stored.count() == 0


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))

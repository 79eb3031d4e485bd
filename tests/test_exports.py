"""Exports that don't look as expected fail loudly or are counted."""

from __future__ import annotations

import json

import pytest

from funnelmart.functions.numbers import lenient_cast
from funnelmart.plans.warehouse import Warehouse
from funnelmart.schemas import RAW_LEADS, RAW_SALES
from funnelmart.sources.exports import MALFORMED, read_export
from pyspark.sql import types as T

HEAD = ",".join(RAW_SALES.names)
EMPTY = "," * (len(RAW_SALES.names) - 1)


def sales_csv(path, lines, head=HEAD):
    path.write_text("\n".join([head, *lines]) + "\n")
    return str(path)


def test_names_match_in_any_case(spark, tmp_path):
    head = ",".join(n.title() if i % 2 else n.upper() for i, n in enumerate(RAW_SALES.names))
    row = read_export(spark, sales_csv(tmp_path / "s.csv", ["7,12" + EMPTY[1:]], head), RAW_SALES, "csv").first()
    assert (row.id, row[RAW_SALES.names[1]], row[MALFORMED]) == (7, 12, 0)
    spark.range(3).selectExpr("id as ID", *[f"cast(null as string) as {n.upper()}" for n in RAW_LEADS.names[1:]]) \
        .write.parquet(str(tmp_path / "leads"))
    assert sorted(r.id for r in read_export(spark, str(tmp_path / "leads"), RAW_LEADS).collect()) == [0, 1, 2]


@pytest.mark.parametrize("format", ["csv", "parquet", "json"])
def test_absent_columns_raise(spark, tmp_path, format):
    rows = spark.sql("select 1 as id, 2 as lead_id")
    path = str(tmp_path / "sales")
    rows.write.options(header=True).format(format).save(path)
    with pytest.raises(ValueError, match="unit_value"):
        read_export(spark, path, RAW_SALES, format)
    row = read_export(spark, path, RAW_SALES, format, fill_missing=True).first()
    assert (row.id, row.lead_id, row.unit_value) == (1, 2, None)


def test_broken_records_are_counted_and_stop_a_refresh(spark, leads, tmp_path):
    lines = ["1,5" + EMPTY[1:], '2,"6\n7"' + EMPTY[1:], "x" + EMPTY, "4,5" + EMPTY[1:]]
    path = sales_csv(tmp_path / "s.csv", lines)
    sales = read_export(spark, path, RAW_SALES, "csv")
    wh = Warehouse(spark, str(tmp_path / "wh"), leads([{"id": 1}]), sales)
    counts = {r.table_name: r.asDict() for r in wh.reconciliation().collect()}["raw_sales"]
    assert counts["malformed_rows"] >= 1 and counts["null_ids"] >= 1 and counts["complete"] == 1
    with pytest.raises(ValueError, match="raw_sales"):
        wh.refresh()
    wh.refresh(allow_rejected=True)
    assert wh.table("raw_sales").columns == RAW_SALES.names
    whole = read_export(spark, path, RAW_SALES, "csv", multi_line=True).collect()
    assert [(r.id, r[MALFORMED]) for r in whole] == [(1, 0), (2, 0), (None, 0), (4, 0)]


def test_json_is_read_by_name_without_inference(spark, tmp_path):
    records = [{"ID": 1, "unit_value": 10.555, "lead_id": "12.0"}, {n: None for n in RAW_SALES.names} | {"ID": 2, "id": 2}]
    (tmp_path / "s.json").write_text("\n".join(map(json.dumps, records)) + "\n{broken\n")
    rows = read_export(spark, str(tmp_path / "s.json"), RAW_SALES, "json", fill_missing=True).collect()
    assert [r[MALFORMED] for r in rows] == [0, 0, 1]
    assert (float(rows[0].unit_value), rows[0].lead_id) == (10.56, 12)


def test_json_names_of_late_records_and_other_files_are_found(spark, tmp_path):
    folder = tmp_path / "sales"
    folder.mkdir()
    first = [json.dumps({"id": i, "lead_id": i}) for i in range(300)] + [json.dumps({"Id": 300, "UNIT_VALUE": 5.25, "other": {"id": 1}})]
    (folder / "a.json").write_text("\n".join(first) + "\n\n")
    (folder / "b.json").write_text('{"ID": 301, "unit_value": 7.5, "Lead_ID": "9"}\n{"id": 302, "lead_id":\n')
    rows = {r.id: r for r in read_export(spark, str(folder), RAW_SALES, "json", fill_missing=True).collect()}
    assert len(rows) == 303 and sum(r[MALFORMED] for r in rows.values()) == 1
    assert (float(rows[300].unit_value), rows[300].lead_id, rows[299].unit_value) == (5.25, None, None)
    assert (float(rows[301].unit_value), rows[301].lead_id) == (7.5, 9)


@pytest.mark.parametrize("text, whole", [("12.7", 13), ("-12.5", -13), ("12.5", 13), ("12.4", 12), ("12", 12), ("-0.4", 0), ("x", None), ("", None)])
def test_fractions_round_half_away_from_zero(spark, text, whole):
    for kind, value in ((T.StringType(), f"'{text}'"), (T.DoubleType(), f"try_cast('{text}' as double)")):
        for target in ("int", "bigint"):
            assert spark.sql(f"select {lenient_cast(value, kind, target)} as n").first().n == whole


def test_no_scratch_is_left_after_a_refresh(build, tmp_path):
    wh = build([{"id": i, "customer_id": i, "campaign": f"c{i}"} for i in range(5)])
    wh.refresh()
    scratch = tmp_path / "wh" / "_scratch"
    assert not scratch.exists() or not list(scratch.iterdir())


def test_a_replaced_input_is_read_again(spark, tmp_path):
    from funnelmart import registry

    for name in ("lineitem", "orders", "customer"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    first = registry.warehouse(spark, str(tmp_path))
    assert registry.warehouse(spark, f"{tmp_path}/") is first
    spark.read.parquet("/root/testdata/sf0.001/orders.parquet").limit(10).write.mode("overwrite").parquet(str(tmp_path / "orders.parquet"))
    assert registry.warehouse(spark, str(tmp_path)) is not first

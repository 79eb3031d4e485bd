"""Exports whose files are larger than a task reads: same rows, many tasks, one pass."""

from __future__ import annotations

import json
import random
import re

import pytest

from funnelmart.schemas import RAW_SALES
from funnelmart.sources import csv_records as cr
from funnelmart.sources.exports import MALFORMED, RAW, as_text, read_export

NAMES = ["id", "Text", "other"]
SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get(SPLIT)
    yield lambda size: spark.conf.set(SPLIT, str(size))
    spark.conf.set(SPLIT, before)


def made(rng, n, end):
    """CSV lines with quoted breaks, doubled quotes, empty fields, blank lines and records of a wrong length."""
    texts = ["plain", "", '"a{0}b"', '"two{0}{0}breaks"', '"say ""hi"""', '"""{0}"""', '""', '"x, y"', '"{0}"', " padded ", 'é"', "a\"b\""]
    texts.remove('é"')
    out = []
    for i in range(n):
        fields = [str(i), rng.choice(texts).format(end), rng.choice(texts).format(end)]
        if rng.random() < 0.02:
            fields = fields[: rng.choice([1, 2])] if rng.random() < 0.5 else [*fields, "more"]
        out.append(",".join(fields))
        if rng.random() < 0.02:
            out.append("")
    return out


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("split", [64, 1000, 20_000])
def test_agrees_with_reading_each_file_whole(spark, tmp_path, small_splits, end, split):
    rng = random.Random(split)
    for name, n in (("a", 300), ("b", 40), ("c", 0)):
        text = end.join(["id,Text,other", *made(rng, n, end)]) + (end if name != "b" else "")
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
    (tmp_path / "d.csv").write_bytes(f'id,Text,other{end}7,"{"long " * 3000}{end * 900}end",x{end}8,y,z{end}'.encode())
    options = {"header": True, "multiLine": True, "escape": '"', "enforceSchema": False, "columnPruning": False}
    whole = spark.read.schema(as_text(NAMES)).options(**options).option("columnNameOfCorruptRecord", RAW).csv(str(tmp_path))
    wanted = sorted(map(tuple, whole.collect()), key=repr)
    small_splits(split)
    assert cr.lines_of(spark, str(tmp_path / "a.csv")).where("length(value) >= 0").rdd.getNumPartitions() >= 1
    read = spark.read.option("lineSep", "\n").text(str(tmp_path / "a.csv"))
    assert read.rdd.getNumPartitions() > 1 or split > 10_000
    found = sorted(map(tuple, cr.csv_records(spark, str(tmp_path), NAMES, RAW).collect()), key=repr)

    def bare(rows):  # a malformed record's own text may keep its carriage returns, or end in the break that stood after it
        return [(*r[:-1], None if r[-1] is None else r[-1].replace("\r", "").rstrip("\n")) for r in rows]

    assert bare(found) == bare(wanted)


def test_large_files_take_this_way_and_small_ones_do_not(spark, tmp_path, small_splits):
    head = ",".join(RAW_SALES.names)
    rest = "," * (len(RAW_SALES.names) - 2)
    (tmp_path / "s.csv").write_text(head + "\n" + "".join(f'{i},"{i}\n"{rest}\n' for i in range(500)))
    small = read_export(spark, str(tmp_path / "s.csv"), RAW_SALES, "csv", multi_line=True)
    small_splits(700)
    large = read_export(spark, str(tmp_path / "s.csv"), RAW_SALES, "csv", multi_line=True)
    assert sorted(map(tuple, large.collect()), key=repr) == sorted(map(tuple, small.collect()), key=repr)
    assert [sum(r[MALFORMED] for r in rows.collect()) for rows in (small, large)] == [0, 0]


def test_quotes_that_do_not_balance_are_refused(spark, tmp_path, small_splits):
    small_splits(64)
    (tmp_path / "s.csv").write_text("id,Text,other\n" + '1,a,b\n2,"open,c\n' * 1 + "3,a,b\n" * 40)
    with pytest.raises(ValueError, match="s.csv: quotes don't balance"):
        cr.csv_records(spark, str(tmp_path), NAMES, RAW)


def test_another_header_is_refused(spark, tmp_path, small_splits):
    small_splits(64)
    (tmp_path / "a.csv").write_text("id,Text,other\n1,a,b\n")
    (tmp_path / "b.csv").write_text("id,other,Text\n1,a,b\n")
    with pytest.raises(Exception, match="another header"):
        cr.csv_records(spark, str(tmp_path), NAMES, RAW).collect()


def test_json_is_read_in_one_pass(spark, tmp_path, capsys):
    records = [{name: i for name in RAW_SALES.names} for i in range(3)] + [{"ID": 9, "LEAD_id": 4, "lead_ID": 5}]
    (tmp_path / "s.json").write_text("\n".join(map(json.dumps, records)))
    rows = read_export(spark, str(tmp_path / "s.json"), RAW_SALES, "json")
    rows.explain("formatted")
    plan = capsys.readouterr().out.split("\n\n\n")[0]
    assert len(re.findall(r"Scan text", plan)) == 1 and "Exchange" not in plan and "Generate" not in plan
    assert {r.id: r.lead_id for r in rows.collect()} == {0: 0, 1: 1, 2: 2, 9: 4}


def test_json_columns_named_late_are_found(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("funnelmart.sources.exports.FIRST_RECORDS", 5)
    lines = [json.dumps({"id": i}) for i in range(50)] + [json.dumps({n.upper(): 7 for n in RAW_SALES.names})]
    (tmp_path / "s.json").write_text("\n".join(lines))
    assert {r.id for r in read_export(spark, str(tmp_path / "s.json"), RAW_SALES, "json").collect()} == {*range(50), 7}
    (tmp_path / "t.json").write_text("\n".join(lines[:-1]))
    with pytest.raises(ValueError, match="unit_value"):
        read_export(spark, str(tmp_path / "t.json"), RAW_SALES, "json")


@pytest.mark.parametrize("text", ['[{"id": 1},\n {"id": 2}]', '{\n "id": 1\n}\n'])
def test_json_over_several_lines_is_refused(spark, tmp_path, text):
    (tmp_path / "s.json").write_text(text)
    with pytest.raises(ValueError, match="over several lines"):
        read_export(spark, str(tmp_path / "s.json"), RAW_SALES, "json", fill_missing=True)

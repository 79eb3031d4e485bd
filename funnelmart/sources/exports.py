"""Reading lead and sale exports, and bringing rows into a declared table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from funnelmart.functions.numbers import lenient_cast
from funnelmart.functions.text import literal
from funnelmart.schemas import Table
from funnelmart.sources.csv_records import csv_records, largest_file

MALFORMED = "_malformed"  # 1 for a record that does not have the shape of its file
RAW = "_raw_record"
FIRST_RECORDS = 1_000  # of a JSON export, which usually name every column; if they don't, all are looked at


def read_export(spark: SparkSession, path: str, table: Table, format: str = "parquet",
                multi_line: bool = False, fill_missing: bool = False) -> DataFrame:
    """Rows of an export file or folder, in the declared columns and types, and a column ``_malformed``.

    Columns are found by name, whatever their case, so their order and extra columns do not matter. A
    declared column that the export lacks is an error, unless ``fill_missing`` asks for NULLs. JSON
    records may leave out empty values and spell names each in its own way, so there a column is lacking only if
    no record of any file names it. Values that do not fit a column's type become NULL. CSV has a header line;
    ``multi_line`` allows line breaks within quotes; a file larger than a task reads is then read by many, which
    needs quotes that balance. Without it such a record is broken into pieces, which ``_malformed`` marks. JSON has
    one record a line; records over several lines are refused.
    """
    if format == "csv":
        # without column pruning, which would let records of a wrong length pass
        options = {
            "header": True, "multiLine": multi_line, "escape": '"', "enforceSchema": False, "columnPruning": False,
        }
        names = header(spark, path, options)
        if multi_line and largest_file(spark, path) > split_bytes(spark):
            rows = csv_records(spark, path, names, RAW)
        else:
            rows = spark.read.schema(as_text(names)).options(**options)
            rows = rows.option("columnNameOfCorruptRecord", RAW).csv(path)
        known = set(spelled(rows, table))
    elif format == "json":
        rows, known = json_records(spark, path, table, fill_missing)
    else:
        rows = spark.read.format(format).load(path)
        known = set(spelled(rows, table))
    absent = set(table.names) - known
    if absent and not fill_missing:
        raise ValueError(f"{table.name}: {path} has no column {', '.join(sorted(absent))}")
    broken = F.col(RAW).isNotNull().cast("int") if RAW in rows.columns else F.lit(0)
    marked = rows.withColumn(MALFORMED, broken)
    return conform(marked, table, MALFORMED)


def split_bytes(spark: SparkSession) -> int:
    """Most bytes of a file that one task reads."""
    return int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())


def as_text(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in [*names, RAW]])


def header(spark: SparkSession, path: str, options: dict) -> list[str]:
    """Column names of a CSV export; reads its first line only."""
    return spark.read.options(**options).csv(path).columns


def json_records(spark: SparkSession, path: str, table: Table, fill_missing: bool) -> tuple[DataFrame, set[str]]:
    """The declared columns of a JSON export as text, with its malformed records, and which of them any record names.

    Names are matched record by record, regardless of case, in the same pass that parses: the declared spelling goes
    first if it has a value, then others in order. The first records tell which columns are named; only if they lack one that must
    not be absent are all records asked.
    """
    lines = spark.read.text(path).where("trim(value) <> ''")
    record = F.col("record")
    parsed = lines.select("value", F.from_json("value", "map<string,string>").alias("record"))
    columns = []
    for declared in table.names:
        columns.append(F.coalesce(record.getItem(declared), value_like(record, declared)).alias(declared))
    rows = parsed.select(*columns, F.when(record.isNull(), F.col("value")).alias(RAW))

    wanted = {column.name.lower(): column for column in table.columns}
    must = {name for name, column in wanted.items() if column.required or not fill_missing}
    first = parsed.select("value", F.map_keys(record).alias("names")).take(FIRST_RECORDS)
    if first and first[0]["names"] is None and (first[0]["value"].strip()[:1] == "[" or first[0]["value"].strip() == "{"):
        raise ValueError(f"{table.name}: {path} has JSON records over several lines; one record a line is read")
    named = {name.lower() for row in first for name in row["names"] or ()} & set(wanted)
    if must - named and len(first) == FIRST_RECORDS:
        found = lines.select(F.explode(F.json_object_keys("value")).alias("name")).select(F.lower("name").alias("name"))
        named |= {row["name"] for row in found.where(F.col("name").isin(list(wanted))).distinct().collect()}
    known = {wanted[name].name for name in named}
    absent = [name for name in table.names if name not in known]
    return rows if not must - named else rows.drop(*absent), known


def value_like(record: Column, name: str) -> Column:
    """The first value in a map whose key is ``name`` in any case."""
    like = F.filter(F.map_entries(record), lambda e: (F.lower(e["key"]) == name.lower()) & e["value"].isNotNull())
    return F.array_min(like)["value"]


def spelled(rows: DataFrame, table: Table) -> dict[str, str]:
    """How ``rows`` spells each declared column that it has; an exact match goes before one in another case."""
    found: dict[str, str] = {}
    for name in rows.columns:
        for declared in table.names:
            if name == declared or (name.lower() == declared.lower() and found.get(declared) != declared):
                found[declared] = name
    return found


def conform(rows: DataFrame, table: Table, *more: str) -> DataFrame:
    """The declared columns in declared order, leniently cast, with defaults in place of NULLs.

    Declared columns that ``rows`` lacks get their default or NULL, unless they are required. Columns
    named in ``more`` follow as they are.
    """
    columns = []
    types = {field.name: field.dataType for field in rows.schema}
    names = spelled(rows, table)
    for column in table.columns:
        if column.name in names:
            value = f"`{names[column.name]}`"
            source = types[names[column.name]]
            if source.simpleString() != column.type:
                value = lenient_cast(value, source, column.type)
            if column.default is not None:
                value = f"coalesce({value}, cast({literal(column.default)} as {column.type}))"
        elif column.default is not None:
            value = f"cast({literal(column.default)} as {column.type})"
        elif column.required:
            raise ValueError(f"{table.name}: no column {column.name}")
        else:
            value = f"cast(null as {column.type})"
        columns.append(f"{value} as `{column.name}`")
    return rows.selectExpr(*columns, *more)

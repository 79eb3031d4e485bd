"""Refresh a warehouse from two exports, or give a report from a stored one.

    python -m funnelmart refresh ROOT --leads PATH --sales PATH [--format csv] [--multi-line]
        [--fill-missing] [--allow-rejected]
    python -m funnelmart report ROOT NAME [--output PATH] [--format csv]

A report without an output folder is printed whole as CSV, row by row.
"""

from __future__ import annotations

import argparse
import csv
import sys

from pyspark.sql import SparkSession

from funnelmart.plans.audits import AUDITS
from funnelmart.plans.checks import CHECKS
from funnelmart.plans.kpis import KPIS
from funnelmart.plans.warehouse import Warehouse, open_tables
from funnelmart.schemas import RAW_LEADS, RAW_SALES
from funnelmart.sources.exports import read_export

REPORTS = {**KPIS, **AUDITS, **CHECKS}


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="funnelmart")
    commands = parser.add_subparsers(dest="command", required=True)
    refresh = commands.add_parser("refresh", help="rebuild every table from the exports")
    refresh.add_argument("root")
    refresh.add_argument("--leads", required=True)
    refresh.add_argument("--sales", required=True)
    refresh.add_argument("--format", default="parquet", choices=["parquet", "csv", "orc", "json"])
    refresh.add_argument("--multi-line", action="store_true", help="CSV texts may hold line breaks")
    refresh.add_argument("--fill-missing", action="store_true", help="absent columns are NULL")
    refresh.add_argument("--allow-rejected", action="store_true", help="go on with malformed records")
    report = commands.add_parser("report", help="give a KPI, audit or check")
    report.add_argument("root")
    report.add_argument("name", choices=sorted(REPORTS))
    report.add_argument("--output", help="folder to write the report to")
    report.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    given = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("funnelmart").getOrCreate()
    if given.command == "refresh":
        leads, sales = (
            read_export(spark, path, table, given.format, given.multi_line, given.fill_missing)
            for path, table in ((given.leads, RAW_LEADS), (given.sales, RAW_SALES))
        )
        built = Warehouse(spark, given.root, leads, sales)
        built.refresh(given.allow_rejected)
        built.reconciliation().show(truncate=False)
        return
    rows = REPORTS[given.name](open_tables(spark, given.root))
    if given.output:
        rows.write.mode("overwrite").options(header=True).format(given.format).save(given.output)
    else:
        lines = csv.writer(sys.stdout, lineterminator="\n")
        lines.writerow(rows.columns)
        for row in rows.toLocalIterator():
            lines.writerow(row)


if __name__ == "__main__":
    main()

"""Every query by name, over a folder of order tables."""

from __future__ import annotations

import hashlib
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from funnelmart.plans import staging
from funnelmart.plans.audits import AUDITS, calendar_use, leap_days
from funnelmart.plans.checks import CHECKS
from funnelmart.plans.kpis import KPIS
from funnelmart.plans.warehouse import Warehouse
from funnelmart.schemas import STAR
from funnelmart.session import shared_folder
from funnelmart.sources import trade

Query = Callable[[SparkSession, str], DataFrame]

_warehouses: dict[tuple[str, str], Warehouse] = {}
_lock = threading.Lock()


def version(spark: SparkSession, folder: str) -> str:
    """A label that changes when a file of the order tables is replaced."""
    found = []
    for name in trade.TABLES:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.parquet")
        files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).listFiles(path, True)
        while files.hasNext():
            file = files.next()
            found.append((file.getPath().toString(), file.getLen(), file.getModificationTime()))
    return hashlib.sha256(repr(sorted(found)).encode()).hexdigest()[:16]


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The application's warehouse over ``folder``; each of its tables is written on first use.

    It is built anew when an input file has been replaced. Threads may ask for it at the same time.
    """
    folder = folder.rstrip("/")
    label = version(spark, folder)
    place = (spark.sparkContext.applicationId, label)
    with _lock:
        if place not in _warehouses:
            _warehouses[place] = Warehouse(
                spark, f"{shared_folder(spark)}/{label}",
                trade.raw_leads(spark, folder), trade.raw_sales(spark, folder),
            )
        return _warehouses[place]


def comparable(rows: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as ISO text, so that results read the same in any engine.

    A double holds whole hundredths exactly up to 2**53 of them; larger sums of money lose their last
    digits here, in registered results only. The operators keep decimals.
    """
    columns = []
    for field in rows.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double").alias(field.name)
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd").alias(field.name)
        columns.append(column)
    return rows.select(*columns)


def table_query(name: str) -> Query:
    """Computes a table from the stored layers below it."""
    return lambda spark, folder: comparable(warehouse(spark, folder).plan(name))


def with_use(query: Callable) -> Callable:
    """``query`` over the calendar with the number of references to each day."""

    def over_calendar(table):
        return query(lambda name: calendar_use(table) if name == "dim_date" else table(name))

    return over_calendar


STAR_QUERIES: dict[str, Callable] = {
    **KPIS,
    **AUDITS,
    **CHECKS,
    "dim_date": calendar_use,
    "audit_leap_days": with_use(leap_days),
}


def star_query(query: Callable) -> Query:
    """Answers a query from stored tables."""
    return lambda spark, folder: comparable(query(warehouse(spark, folder).table))


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {
        "stg_leads": lambda spark, folder: comparable(
            staging.stage_leads(trade.raw_leads(spark, folder))
        ),
        "stg_sales": lambda spark, folder: comparable(
            staging.stage_sales(trade.raw_sales(spark, folder))
        ),
        "latest_lead": table_query("latest_lead"),
        "recon_row_counts": lambda spark, folder: warehouse(spark, folder).reconciliation(),
    }
    out |= {name: table_query(name) for name in STAR}
    out |= {name: star_query(query) for name, query in STAR_QUERIES.items()}
    return out

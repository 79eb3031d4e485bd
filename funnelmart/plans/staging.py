"""Staging: the exports under their warehouse names.

Staging only renames and orders columns, so it stays a projection over the stored exports; writing it
out would copy every byte without changing one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelmart.schemas import RAW_LEADS, RAW_SALES, Table

LEAD_VERSION_TIMES = ["updated_at", "created_at"]


def stage(export: DataFrame, table: Table, entity: str) -> DataFrame:
    return export.select(F.col("id").alias(entity), *[c for c in table.names if c != "id"])


def stage_leads(export: DataFrame) -> DataFrame:
    return stage(export, RAW_LEADS, "lead_id")


def stage_sales(export: DataFrame) -> DataFrame:
    return stage(export, RAW_SALES, "sale_id")

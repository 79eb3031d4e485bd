"""Audit queries over staging and the stored star schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelmart.functions.numbers import count_where, percentage
from funnelmart.operators.latest import latest_versions
from funnelmart.plans.staging import LEAD_VERSION_TIMES
from funnelmart.schemas import FACT_LEAD, FACTS

Tables = Callable[[str], DataFrame]

TOP_DUPLICATES = 20


def leap_days(table: Tables) -> DataFrame:
    leap = F.date_format("full_date", "MM-dd") == "02-29"
    return table("dim_date").where(leap).orderBy("full_date")


def calendar_use(table: Tables) -> DataFrame:
    """All calendar days, with how often leads (``lead_dates``) and sales (``sale_dates``) refer to each.

    Every date role of a fact counts. References are counted per day before the join.
    """
    days = table("dim_date")
    for name, alias in (("fact_lead", "lead_dates"), ("fact_sale", "sale_dates")):
        roles = [c.name for c in FACTS[name].references if c.refers_to == "dim_date"]
        used = table(name).select(*roles).unpivot([], roles, "role", "date_key")
        counts = used.where("date_key is not null").groupBy("date_key").agg(F.count("*").alias(alias))
        days = days.join(counts, "date_key", "left").withColumn(alias, F.coalesce(alias, F.lit(0).cast("bigint")))
    return days


def staged_counts(table: Tables) -> DataFrame:
    return table("stg_leads").agg(
        F.count("*").alias("total_rows"), F.countDistinct("lead_id").alias("distinct_leads")
    )


def duplicate_leads(table: Tables) -> DataFrame:
    """The 20 leads with the most versions; smaller ids first among equals."""
    return (
        table("stg_leads")
        .groupBy("lead_id")
        .agg(F.count("*").alias("cnt"))
        .where("cnt > 1")
        .orderBy(F.desc("cnt"), "lead_id")
        .limit(TOP_DUPLICATES)
    )


def missing_keys(table: Tables) -> DataFrame:
    """NULL dimension keys of the lead fact, one column per dimension other than the calendar."""
    keys = [c.name for c in FACT_LEAD.references if c.refers_to != "dim_date"]
    return table("fact_lead").agg(
        F.count("*").alias("total_rows"),
        *[count_where(F.col(k).isNull()).alias(f"missing_{k.removesuffix('_key')}") for k in keys],
    )


def null_area(table: Tables) -> DataFrame:
    return table("stg_leads").where("area_id is null").agg(F.count("*").alias("leads_without_area"))


def latest_unique(table: Tables) -> DataFrame:
    """Leads that the latest-version selection returns more than once; there should be none."""
    versions = table("stg_leads").select("lead_id", *LEAD_VERSION_TIMES)
    return (
        latest_versions(versions, "lead_id", LEAD_VERSION_TIMES)
        .groupBy("lead_id")
        .agg(F.count("*").alias("cnt"))
        .where("cnt > 1")
    )


def sales_lead_coverage(table: Tables) -> DataFrame:
    """Sales with and without a lead. Sales are counted per lead before the join, NULL included."""
    sales = table("fact_sale").groupBy("lead_id").agg(F.count("*").alias("n"))
    leads = table("fact_lead").select(F.col("lead_id").alias("found"))
    rows = sales.join(leads, F.col("lead_id") == F.col("found"), "left")
    found, lost = F.col("found").isNotNull(), F.col("found").isNull()
    return rows.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_sales"),
        count_where(found, F.col("n")).alias("sales_with_lead"),
        count_where(lost, F.col("n")).alias("sales_without_lead"),
        percentage(count_where(found, F.col("n")), F.sum("n")).alias("pct_with_lead"),
    )


def distinct_campaigns(table: Tables) -> DataFrame:
    return table("dim_campaign").agg(
        F.countDistinct(F.lower("campaign_clean")).alias("distinct_campaigns")
    )


AUDITS: dict[str, Callable[[Tables], DataFrame]] = {
    "audit_leap_days": leap_days,
    "audit_stg_counts": staged_counts,
    "audit_duplicate_leads": duplicate_leads,
    "audit_missing_keys": missing_keys,
    "audit_null_area": null_area,
    "audit_latest_unique": latest_unique,
    "audit_sales_lead_coverage": sales_lead_coverage,
    "audit_distinct_campaigns": distinct_campaigns,
}

"""KPI queries over the stored star schema.

Facts are aggregated on their integer keys before any dimension is joined: the map-side aggregate
shrinks each task's rows to one per key combination, so a key that holds a large share of the fact
travels as one row per task, and the joins see combinations instead of fact rows. Labels are grouped
regardless of case. Rows whose key is NULL have no dimension row and drop out, as in an inner join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelmart.functions.numbers import average, count_where, percentage
from funnelmart.operators.lookup import BROADCAST_BYTES, Lookup, attach_keys

Tables = Callable[[str], DataFrame]

# fixed values: output column and the funnel stage it counts
STAGE_COLUMNS = {
    "to_contact": "TO_CONTACT",
    "contacted": "CONTACT_ATTEMPT",
    "meeting_booked": "MEETING_BOOKED",
    "meeting_held": "MEETING_HELD",
    "reservation": "RESERVATION",
    "contract_stage": "CONTRACT",
    "sales": "WON",
}
RATE_COLUMNS = {
    "final_conversion_rate_pct": "WON",
    "meeting_conversion_pct": "MEETING_HELD",
    "reservation_conversion_pct": "RESERVATION",
}


def leads_by(table: Tables, *keys: str) -> DataFrame:
    """Leads per combination of fact keys, as ``n``, with the status dimension attached."""
    combos = table("fact_lead").groupBy(*keys, "lead_status_key").agg(F.count("*").alias("n"))
    return combos.join(table("dim_lead_status"), "lead_status_key")


def stage_count(stage: str) -> Column:
    return count_where(F.col("funnel_stage") == stage, F.col("n"))


def won() -> Column:
    return F.sum(F.col("n") * F.col("is_won"))


def group_labels(rows: DataFrame, labels: list[str], *measures: Column) -> DataFrame:
    """Group by text regardless of case, showing the smallest spelling."""
    grouped = rows.groupBy(*[F.lower(label).alias(f"_{label}") for label in labels])
    out = grouped.agg(*[F.min(label).alias(label) for label in labels], *measures)
    return out.drop(*[f"_{label}" for label in labels])


def funnel_distribution(table: Tables) -> DataFrame:
    return (
        leads_by(table)
        .groupBy("funnel_stage")
        .agg(F.sum("n").alias("leads_count"))
        .orderBy(F.desc("leads_count"), "funnel_stage")
    )


def funnel_counts(table: Tables) -> DataFrame:
    return leads_by(table).agg(*[stage_count(s).alias(c) for c, s in STAGE_COLUMNS.items()])


def conversion_rates(table: Tables) -> DataFrame:
    return leads_by(table).agg(
        *[percentage(stage_count(s), F.sum("n")).alias(c) for c, s in RATE_COLUMNS.items()]
    )


def agent_performance(table: Tables) -> DataFrame:
    return (
        leads_by(table, "agent_key")
        .join(table("dim_agent"), "agent_key")
        .groupBy("user_id")
        .agg(
            F.sum("n").alias("total_leads"),
            won().alias("sales"),
            stage_count("MEETING_HELD").alias("meetings"),
            percentage(won(), F.sum("n")).alias("win_rate_pct"),
        )
        .orderBy(F.desc("win_rate_pct"), "user_id")
    )


def source_performance(table: Tables) -> DataFrame:
    rows = leads_by(table, "lead_source_key").join(table("dim_lead_source"), "lead_source_key")
    return group_labels(
        rows.withColumnRenamed("lead_source_clean", "lead_source"),
        ["lead_source", "source_group"],
        F.sum("n").alias("total_leads"),
        won().alias("sales"),
        percentage(won(), F.sum("n")).alias("win_rate_pct"),
    ).orderBy(F.desc("sales"), "lead_source", "source_group")


def lead_mix(table: Tables) -> DataFrame:
    return table("fact_lead").agg(
        F.sum("is_buyer").alias("buyer_leads"),
        F.sum("is_seller").alias("seller_leads"),
        F.sum("is_commercial").alias("commercial_leads"),
    )


def funnel_by_month(table: Tables) -> DataFrame:
    return (
        leads_by(table, "created_date_key")
        .join(table("dim_date"), F.col("date_key") == F.col("created_date_key"))
        .groupBy("year", "month", "funnel_stage")
        .agg(F.sum("n").alias("leads_count"))
        .orderBy("year", "month", F.desc("leads_count"), "funnel_stage")
    )


def agent_lead_to_sale(table: Tables, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Leads, distinct sales and sales per lead row of each agent.

    The percentage counts the rows of leads left-joined to sales: a lead with several sales appears
    that often, one without a sale once. Those rows are counted, not made: unsold leads need no join at
    all, and sales meet their leads once.
    """
    leads = table("fact_lead").groupBy("agent_key").agg(F.count("lead_id").alias("total_leads"))
    agent = Lookup("agent_key", table("fact_lead").where("agent_key is not null"),
                   "agent_key", "lead_id", "lead_id")
    sales = attach_keys(
        table("fact_sale").select("sale_id", "lead_id"), [agent], "sale_id",
        broadcast_bytes=broadcast_bytes,
    ).where("agent_key is not null")
    sold = sales.groupBy("agent_key").agg(
        F.count("*").alias("sold_rows"),
        F.count("sale_id").alias("matched_sales"),
        F.countDistinct("lead_id").alias("sold_leads"),
        F.countDistinct("sale_id").alias("total_sales"),
    )
    zero = F.lit(0).cast("bigint")
    joined = leads.join(sold, "agent_key", "left").join(table("dim_agent"), "agent_key")
    rows = F.col("total_leads") - F.coalesce("sold_leads", zero) + F.coalesce("sold_rows", zero)
    return joined.select(
        F.col("user_id").alias("agent"),
        "total_leads",
        F.coalesce("total_sales", zero).alias("total_sales"),
        percentage(F.coalesce("matched_sales", zero), rows).alias("lead_to_sale_pct"),
    )


def sales_totals(table: Tables) -> DataFrame:
    values = ["actual_value", "expected_value", "unit_value"]
    return table("fact_sale").agg(
        F.count("*").alias("total_sales"),
        *[F.sum(v).alias(f"total_{v}") for v in values],
        *[average(F.sum(v), F.count(v)).alias(f"avg_{v}") for v in [*values, "years_of_payment"]],
    )


def sales_by(table: Tables, key: str) -> DataFrame:
    """Sums and counts of the sale measures per fact key."""
    return table("fact_sale").groupBy(key).agg(
        F.count("*").alias("n"),
        F.sum("actual_value").alias("value"),
        F.count("actual_value").alias("valued"),
        F.sum("years_of_payment").alias("years"),
        F.count("years_of_payment").alias("termed"),
    )


def sales_by_property(table: Tables) -> DataFrame:
    rows = sales_by(table, "property_type_key").join(table("dim_property_type"), "property_type_key")
    return group_labels(
        rows,
        ["property_type_group", "property_type_name"],
        F.sum("n").alias("sales_count"),
        F.sum("value").alias("total_actual_value"),
        average(F.sum("value"), F.sum("valued")).alias("avg_actual_value"),
        average(F.sum("years"), F.sum("termed")).alias("avg_years_of_payment"),
    ).orderBy(F.desc("total_actual_value"), "property_type_name")


def sales_by_category(table: Tables) -> DataFrame:
    rows = sales_by(table, "sale_category_key").join(table("dim_sale_category"), "sale_category_key")
    return group_labels(
        rows,
        ["sale_category_group", "sale_category_clean"],
        F.sum("n").alias("sales_count"),
        F.sum("value").alias("total_actual_value"),
        average(F.sum("value"), F.sum("valued")).alias("avg_actual_value"),
    ).orderBy(F.desc("total_actual_value"), "sale_category_clean")


KPIS: dict[str, Callable[[Tables], DataFrame]] = {
    "kpi_funnel_distribution": funnel_distribution,
    "kpi_funnel_counts": funnel_counts,
    "kpi_conversion_rates": conversion_rates,
    "kpi_agent_performance": agent_performance,
    "kpi_source_performance": source_performance,
    "kpi_lead_mix": lead_mix,
    "kpi_funnel_by_month": funnel_by_month,
    "kpi_agent_lead_to_sale": agent_lead_to_sale,
    "kpi_sales_totals": sales_totals,
    "kpi_sales_by_property": sales_by_property,
    "kpi_sales_by_category": sales_by_category,
}

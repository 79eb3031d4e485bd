"""Facts: one row per lead (latest version) and one per sale, with dimension keys in place of values."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelmart.operators.latest import latest_versions
from funnelmart.operators.lookup import BROADCAST_BYTES, Lookup, attach_keys
from funnelmart.plans.staging import LEAD_VERSION_TIMES
from funnelmart.schemas import FACT_LEAD, FACT_SALE
from funnelmart.sources.exports import conform

# alias, dimension, key, match in the dimension, value in the staged row, whether match is unique
LEAD_LOOKUPS = (
    ("customer_key", "dim_customer", "customer_key", "customer_id", "customer_id", True),
    ("agent_key", "dim_agent", "agent_key", "user_id", "user_id", True),
    ("lead_status_key", "dim_lead_status", "lead_status_key",
     "lower(raw_status_name)", "lower(status_name)", True),
    ("lead_type_key", "dim_lead_type", "lead_type_key", "lead_type_id", "lead_type_id", False),
    ("contact_method_key", "dim_contact_method", "contact_method_key",
     "lower(raw_contact_method)", "lower(trim(method_of_contact))", True),
    ("lead_source_key", "dim_lead_source", "lead_source_key",
     "lower(raw_lead_source)", "lower(trim(lead_source))", True),
    ("campaign_key", "dim_campaign", "campaign_key",
     "lower(raw_campaign)", "lower(trim(campaign))", True),
    ("area_key", "dim_area", "area_key", "area_id", "area_id", True),
    ("compound_key", "dim_compound", "compound_key", "compound_id", "compound_id", True),
    ("developer_key", "dim_developer", "developer_key", "developer_id", "developer_id", True),
    ("created_date_key", "dim_date", "date_key", "full_date", "to_date(created_at)", True),
    ("last_request_date_key", "dim_date", "date_key",
     "full_date", "to_date(date_of_last_request)", True),
    ("last_contact_date_key", "dim_date", "date_key",
     "full_date", "to_date(date_of_last_contact)", True),
)
SALE_LOOKUPS = (
    ("property_type_key", "dim_property_type", "property_type_key",
     "property_type_id", "property_type_id", False),
    ("sale_category_key", "dim_sale_category", "sale_category_key",
     "lower(raw_sale_category)", "lower(sale_category)", True),
    ("area_key", "dim_area", "area_key", "area_id", "area_id", True),
    ("compound_key", "dim_compound", "compound_key", "compound_id", "compound_id", True),
    ("known_lead_id", "fact_lead", "lead_id", "lead_id", "lead_id", True),
    ("reservation_date_key", "dim_date", "date_key",
     "full_date", "to_date(date_of_reservation)", True),
    ("contract_date_key", "dim_date", "date_key",
     "full_date", "to_date(date_of_contraction)", True),
)

Tables = Callable[[str], DataFrame]
Store = Callable[[DataFrame], DataFrame]


def lookups(declared, table: Tables) -> list[Lookup]:
    return [
        Lookup(alias, table(source), key, match, on, unique)
        for alias, source, key, match, on, unique in declared
    ]


def latest_leads(leads: DataFrame) -> DataFrame:
    return latest_versions(leads, "lead_id", LEAD_VERSION_TIMES)


def fact_lead(leads: DataFrame, table: Tables, broadcast_bytes: int = BROADCAST_BYTES,
              store: Store | None = None) -> DataFrame:
    """``table`` gives stored dimensions by name.

    Hot values are sought among the latest leads, the rows that are joined: a customer may hold many
    leads of one version each, and so be rare among versions. ``store`` keeps the latest leads where a
    dimension is too large to broadcast, so they are found once.
    """
    rows = attach_keys(
        latest_leads(leads), lookups(LEAD_LOOKUPS, table), "lead_id", broadcast_bytes=broadcast_bytes, store=store
    )
    for name, source in (("is_buyer", "buyer"), ("is_seller", "seller"), ("is_commercial", "commercial")):
        rows = rows.withColumn(name, F.when(F.col(source) == 1, 1).otherwise(0))
    rows = rows.withColumn("meeting_flag", F.coalesce("meeting_flag", F.lit(0))).withColumn(
        "do_not_call_flag", F.coalesce("do_not_call", F.lit(0))
    )
    return conform(rows, FACT_LEAD)


def fact_sale(sales: DataFrame, table: Tables, broadcast_bytes: int = BROADCAST_BYTES,
              store: Store | None = None) -> DataFrame:
    """``table`` gives stored dimensions and the lead fact by name. An unknown lead becomes NULL."""
    rows = attach_keys(
        sales, lookups(SALE_LOOKUPS, table), "sale_id", broadcast_bytes=broadcast_bytes, store=store
    )
    return conform(rows.drop("lead_id").withColumnRenamed("known_lead_id", "lead_id"), FACT_SALE)

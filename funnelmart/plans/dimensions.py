"""Dimensions: distinct members of the staged tables, classified and numbered.

Every plan reduces its staged column to distinct values first, so classification and numbering work on
members, not rows. Raw labels are made distinct before spellings that differ only in case are merged:
that first step is a plain hash aggregate, whatever share of the rows one label holds. Merging by
``min`` per group would undo it, since Spark drops a ``distinct`` below a ``min`` and would then sort
all rows for an aggregate over text; the smallest spelling is therefore taken by rank.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelmart.functions import vocabulary as v
from funnelmart.functions.text import family_value, first_match, flag, match_key, matches
from funnelmart.operators.calendar import calendar
from funnelmart.operators.dense_key import with_dense_key
from funnelmart.operators.latest import first_per_group
from funnelmart.schemas import DIMENSIONS
from funnelmart.sources.exports import conform


def labels(staged: DataFrame, column: str, trim: bool = True, keep_blank: bool = False,
           identity: list[str] | None = None) -> DataFrame:
    """Distinct labels of a text column, one per spelling regardless of case, as ``label``.

    ``identity`` names columns that are part of the member besides the label. Blank and NULL labels are
    members only with ``keep_blank``.
    """
    identity = identity or []
    label = F.trim(column) if trim else F.col(column)
    distinct = staged.select(*identity, label.alias("label"))
    if not keep_blank:
        distinct = distinct.where("label is not null" + (" and label <> ''" if trim else ""))
    group = [*[F.col(c) for c in identity], F.lower("label")]
    return first_per_group(distinct.distinct(), group, [F.asc("label")])


def picker(index: int, *path: int) -> Callable:
    """Takes attribute ``index`` of a word family, or a flag within it."""
    def pick(attributes):
        value = attributes[index]
        for step in path:
            value = value[step]
        return value
    return pick


def family_flags(key: str, families, other, index: int, names: list[str]) -> list[Column]:
    return [
        family_value(key, families, other, picker(index, i)).alias(name)
        for i, name in enumerate(names)
    ]


def lead_status(leads: DataFrame) -> DataFrame:
    key = match_key("label", trim=False)
    known = (key, v.LEAD_STATUS, v.LEAD_STATUS_OTHER)
    return labels(leads, "status_name", trim=False).select(
        F.col("label").alias("raw_status_name"),
        family_value(*known, picker(0)).alias("normalized_status"),
        family_value(*known, picker(1)).alias("funnel_stage"),
        *family_flags(*known, 2, ["is_won", "is_lost", "is_active"]),
    )


def lead_type(leads: DataFrame) -> DataFrame:
    known = (match_key("label"), v.LEAD_TYPE, v.LEAD_TYPE_OTHER)
    return labels(leads, "lead_type", identity=["lead_type_id"]).select(
        "lead_type_id",
        F.col("label").alias("lead_type_name"),
        family_value(*known, picker(0)).alias("lead_type_group"),
        family_value(*known, picker(1)).alias("is_commercial"),
    )


def contact_method(leads: DataFrame) -> DataFrame:
    known = (match_key("label"), v.CONTACT_METHOD, v.CONTACT_METHOD_OTHER)
    return labels(leads, "method_of_contact").select(
        F.col("label").alias("raw_contact_method"),
        family_value(*known, picker(0)).alias("contact_method_clean"),
        family_value(*known, picker(1)).alias("method_group"),
        *family_flags(
            *known, 2, ["is_digital", "is_social", "is_call_center", "is_offline", "is_referral"]
        ),
    )


def lead_source(leads: DataFrame) -> DataFrame:
    key = match_key("label")
    return labels(leads, "lead_source").select(
        F.col("label").alias("raw_lead_source"),
        first_match(key, v.LEAD_SOURCE_CLEAN, "label").alias("lead_source_clean"),
        first_match(key, v.LEAD_SOURCE_GROUP, "'OTHER'").alias("source_group"),
        *[flag(key, *rule).alias(name) for name, rule in v.LEAD_SOURCE_FLAGS.items()],
    )


def campaign(leads: DataFrame) -> DataFrame:
    key = match_key("label")
    clean = F.col("label")
    for old, new in v.CAMPAIGN_REPLACEMENTS:
        clean = F.replace(clean, F.lit(old), F.lit(new))
    junk = F.expr(f"label is null or {matches(key, v.CAMPAIGN_JUNK)}")
    return labels(leads, "campaign", keep_blank=True).select(
        F.col("label").alias("raw_campaign"),
        F.when(junk, F.lit(v.CAMPAIGN_UNKNOWN)).otherwise(F.trim(clean)).alias("campaign_clean"),
        first_match(key, v.CAMPAIGN_TYPE, "'OTHER'").alias("campaign_type"),
        *[flag(key, *rule).alias(name) for name, rule in v.CAMPAIGN_FLAGS.items()],
    )


def property_type(sales: DataFrame) -> DataFrame:
    known = (match_key("label"), v.PROPERTY_TYPE, v.PROPERTY_TYPE_OTHER)
    return labels(sales, "property_type", identity=["property_type_id"]).select(
        "property_type_id",
        F.col("label").alias("property_type_name"),
        family_value(*known, picker(0)).alias("property_type_group"),
        *family_flags(*known, 1, ["is_residential", "is_commercial", "is_vacation"]),
    )


def sale_category(sales: DataFrame) -> DataFrame:
    known = (match_key("label", trim=False), v.SALE_CATEGORY, v.SALE_CATEGORY_OTHER)
    blank = F.col("label").isNull() | (F.trim("label") == "")
    return labels(sales, "sale_category", trim=False, keep_blank=True).select(
        F.col("label").alias("raw_sale_category"),
        F.when(blank, F.lit(v.SALE_CATEGORY_UNKNOWN))
        .otherwise(F.trim("label"))
        .alias("sale_category_clean"),
        family_value(*known, picker(0)).alias("sale_category_group"),
        *family_flags(
            *known, 1, ["is_primary", "is_resale", "is_developer", "is_instant_buy"]
        ),
    )


def members(column: str, *staged: DataFrame) -> DataFrame:
    """Distinct non-null values of ``column`` over one or more staged tables."""
    values = staged[0].select(column)
    for other in staged[1:]:
        values = values.unionAll(other.select(column))
    return values.where(F.col(column).isNotNull()).distinct()


# dimension -> (members from (leads, sales), natural key in key order)
MEMBERS: dict[str, tuple[Callable, list[str]]] = {
    "dim_lead_status": (lambda leads, sales: lead_status(leads), ["raw_status_name"]),
    "dim_lead_type": (lambda leads, sales: lead_type(leads), ["lead_type_id", "lead_type_name"]),
    "dim_contact_method": (lambda leads, sales: contact_method(leads), ["raw_contact_method"]),
    "dim_lead_source": (lambda leads, sales: lead_source(leads), ["raw_lead_source"]),
    "dim_campaign": (lambda leads, sales: campaign(leads), ["raw_campaign"]),
    "dim_customer": (lambda leads, sales: members("customer_id", leads), ["customer_id"]),
    "dim_agent": (lambda leads, sales: members("user_id", leads), ["user_id"]),
    "dim_area": (lambda leads, sales: members("area_id", leads, sales), ["area_id"]),
    "dim_compound": (lambda leads, sales: members("compound_id", leads, sales), ["compound_id"]),
    "dim_developer": (lambda leads, sales: members("developer_id", leads), ["developer_id"]),
    "dim_property_type": (
        lambda leads, sales: property_type(sales), ["property_type_id", "property_type_name"],
    ),
    "dim_sale_category": (lambda leads, sales: sale_category(sales), ["raw_sale_category"]),
}


def dimension(name: str, leads: DataFrame, sales: DataFrame, folder: str) -> DataFrame:
    """The named dimension; ``folder`` is a new folder for its numbered members."""
    table = DIMENSIONS[name]
    if name == "dim_date":
        return conform(calendar(leads.sparkSession, v.CALENDAR_START, v.CALENDAR_END), table)
    build, natural_key = MEMBERS[name]
    return conform(with_dense_key(build(leads, sales), table.key, natural_key, folder), table)

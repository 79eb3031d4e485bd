"""Declared tables: exports, dimensions and facts, with their keys, references and limits.

Surrogate keys are 64-bit so that a member dimension may hold more than two billion rows. Date-times
carry no zone. Flags are plain integers, so they can be summed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    required: bool = False
    length: int | None = None
    default: object = None
    refers_to: str | None = None


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]

    @property
    def key(self) -> str:
        return self.columns[0].name

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def struct(self) -> T.StructType:
        ddl = ", ".join(f"`{c.name}` {c.type}" for c in self.columns)
        return T.StructType.fromDDL(ddl)

    @property
    def references(self) -> list[Column]:
        return [c for c in self.columns if c.refers_to]


def key(name: str, type: str = "bigint") -> Column:
    return Column(name, type, required=True)


def text(name: str, length: int | None = None, required: bool = False) -> Column:
    return Column(name, "string", required, length)


def flag(name: str, default: int = 0) -> Column:
    return Column(name, "int", True, default=default)


def number(name: str, type: str = "bigint", required: bool = False) -> Column:
    return Column(name, type, required)


def money(name: str, type: str = "decimal(18,2)") -> Column:
    return Column(name, type)


def moment(name: str) -> Column:
    return Column(name, "timestamp_ntz")


def ref(name: str, table: str, type: str = "bigint") -> Column:
    return Column(name, type, refers_to=table)


RAW_LEADS = Table(
    "raw_leads",
    (
        key("id"),
        moment("date_of_last_request"),
        number("buyer", "int"),
        number("seller", "int"),
        text("best_time_to_call"),
        money("budget"),
        moment("created_at"),
        moment("updated_at"),
        number("user_id"),
        text("location"),
        moment("date_of_last_contact"),
        text("status_name"),
        number("commercial", "int"),
        number("merged", "int"),
        number("area_id"),
        number("compound_id"),
        number("developer_id"),
        number("meeting_flag", "int"),
        number("do_not_call", "int"),
        number("lead_type_id", "int"),
        number("customer_id"),
        text("method_of_contact"),
        text("lead_source"),
        text("campaign"),
        text("lead_type"),
    ),
)

RAW_SALES = Table(
    "raw_sales",
    (
        key("id"),
        number("lead_id"),
        money("unit_value"),
        text("unit_location"),
        money("expected_value"),
        money("actual_value"),
        moment("date_of_reservation"),
        moment("reservation_update_date"),
        moment("date_of_contraction"),
        number("property_type_id", "int"),
        number("area_id"),
        number("compound_id"),
        text("sale_category"),
        money("years_of_payment", "decimal(10,2)"),
        text("property_type"),
    ),
)

DIMENSIONS = {
    table.name: table
    for table in (
        Table(
            "dim_lead_status",
            (
                key("lead_status_key"),
                text("raw_status_name", 255, True),
                text("normalized_status", 100, True),
                text("funnel_stage", 50, True),
                flag("is_won"),
                flag("is_lost"),
                flag("is_active", 1),
            ),
        ),
        Table(
            "dim_lead_type",
            (
                key("lead_type_key"),
                number("lead_type_id", "int"),
                text("lead_type_name", 100, True),
                text("lead_type_group", 50),
                flag("is_commercial"),
            ),
        ),
        Table(
            "dim_contact_method",
            (
                key("contact_method_key"),
                text("raw_contact_method", 255, True),
                text("contact_method_clean", 255, True),
                text("method_group", 50),
                flag("is_digital"),
                flag("is_social"),
                flag("is_call_center"),
                flag("is_offline"),
                flag("is_referral"),
            ),
        ),
        Table(
            "dim_lead_source",
            (
                key("lead_source_key"),
                text("raw_lead_source", 255),
                text("lead_source_clean", 255, True),
                text("source_group", 50),
                flag("is_social"),
                flag("is_partner"),
                flag("is_offline"),
                flag("is_organic"),
                flag("is_paid"),
            ),
        ),
        Table(
            "dim_campaign",
            (
                key("campaign_key"),
                text("raw_campaign", 255),
                text("campaign_clean", 255),
                text("campaign_type", 50),
                flag("is_brand"),
                flag("is_remarketing"),
            ),
        ),
        Table(
            "dim_date",
            (
                key("date_key", "int"),
                number("full_date", "date", True),
                number("year", "int", True),
                number("quarter", "int", True),
                number("month", "int", True),
                text("month_name", 20, True),
                number("day_of_month", "int", True),
                number("day_of_week", "int", True),
                text("day_name", 20, True),
                number("week_of_year", "int", True),
                number("is_weekend", "int", True),
            ),
        ),
        Table(
            "dim_customer",
            (
                key("customer_key"),
                number("customer_id", required=True),
                text("customer_name", 255),
                text("customer_email", 255),
            ),
        ),
        Table(
            "dim_agent",
            (
                key("agent_key"),
                number("user_id", required=True),
                text("agent_name", 255),
                text("team_name", 255),
            ),
        ),
        Table(
            "dim_area",
            (
                key("area_key"),
                number("area_id", required=True),
                text("area_name", 255),
                text("city", 255),
                text("region", 255),
            ),
        ),
        Table(
            "dim_compound",
            (
                key("compound_key"),
                number("compound_id", required=True),
                text("compound_name", 255),
            ),
        ),
        Table(
            "dim_developer",
            (
                key("developer_key"),
                number("developer_id", required=True),
                text("developer_name", 255),
                text("developer_group", 100),
            ),
        ),
        Table(
            "dim_property_type",
            (
                key("property_type_key"),
                number("property_type_id", "int"),
                text("property_type_name", 100, True),
                text("property_type_group", 50),
                flag("is_residential"),
                flag("is_commercial"),
                flag("is_vacation"),
            ),
        ),
        Table(
            "dim_sale_category",
            (
                key("sale_category_key"),
                text("raw_sale_category", 255),
                text("sale_category_clean", 100, True),
                text("sale_category_group", 50),
                flag("is_primary"),
                flag("is_resale"),
                flag("is_developer"),
                flag("is_instant_buy"),
            ),
        ),
    )
}

FACT_LEAD = Table(
    "fact_lead",
    (
        key("lead_id"),
        ref("customer_key", "dim_customer"),
        ref("agent_key", "dim_agent"),
        ref("lead_status_key", "dim_lead_status"),
        ref("lead_type_key", "dim_lead_type"),
        ref("contact_method_key", "dim_contact_method"),
        ref("lead_source_key", "dim_lead_source"),
        ref("campaign_key", "dim_campaign"),
        ref("area_key", "dim_area"),
        ref("compound_key", "dim_compound"),
        ref("developer_key", "dim_developer"),
        ref("created_date_key", "dim_date", "int"),
        ref("last_request_date_key", "dim_date", "int"),
        ref("last_contact_date_key", "dim_date", "int"),
        money("budget"),
        number("is_buyer", "int"),
        number("is_seller", "int"),
        number("is_commercial", "int"),
        number("meeting_flag", "int"),
        number("do_not_call_flag", "int"),
        text("location", 255),
    ),
)

FACT_SALE = Table(
    "fact_sale",
    (
        key("sale_id"),
        ref("lead_id", "fact_lead"),
        ref("property_type_key", "dim_property_type"),
        ref("sale_category_key", "dim_sale_category"),
        ref("area_key", "dim_area"),
        ref("compound_key", "dim_compound"),
        ref("reservation_date_key", "dim_date", "int"),
        ref("contract_date_key", "dim_date", "int"),
        money("unit_value"),
        money("expected_value"),
        money("actual_value"),
        money("years_of_payment", "decimal(10,2)"),
        text("unit_location", 255),
    ),
)

FACTS = {FACT_LEAD.name: FACT_LEAD, FACT_SALE.name: FACT_SALE}
STAR = {**DIMENSIONS, **FACTS}

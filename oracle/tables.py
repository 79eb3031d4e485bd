"""Common table expressions for exports, staging, dimensions and facts.

Each entry of ``CTES`` is (tables it reads, SQL). The classifiers' words and patterns and the exports'
column expressions are the only things shared with the package.
"""

from __future__ import annotations

from funnelmart.functions import vocabulary as v
from funnelmart.schemas import RAW_LEADS, RAW_SALES, STAR
from funnelmart.sources import trade

SQL_TYPES = {"string": "varchar", "timestamp_ntz": "timestamp"}


def sql_type(type_: str) -> str:
    return SQL_TYPES.get(type_, type_)


def quoted(value) -> str:
    return str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"


def test(key: str, words=(), patterns=()) -> str:
    tests = []
    if words:
        tests.append(f"{key} in ({', '.join(quoted(w.lower()) for w in words)})")
    tests += [f"{key} like {quoted(p)}" for p in patterns]
    return " or ".join(tests)


def rules(key: str, listed, default: str) -> str:
    cases = " ".join(f"when {test(key, w, p)} then {quoted(a)}" for a, w, p in listed)
    return f"case {cases} else {default} end"


def family(key: str, families, other, *path: int) -> str:
    """One branch per word family, in declared order."""

    def attribute(values):
        for step in path:
            values = values[step]
        return values

    cases = " ".join(
        f"when {test(key, words)} then {quoted(attribute(rest))}" for words, *rest in families
    )
    return f"case {cases} else {quoted(attribute(other))} end"


def flags(key: str, families, other, index: int, names: list[str]) -> str:
    return ", ".join(f"{family(key, families, other, index, i)} as {n}" for i, n in enumerate(names))


def flag_rules(key: str, listed: dict) -> str:
    return ", ".join(
        f"case when {test(key, *rule)} then 1 else 0 end as {name}" for name, rule in listed.items()
    )


def export(table, columns: dict, texts: dict, source: str) -> str:
    chosen = []
    for column in table.columns:
        if column.name in texts:
            words, index = texts[column.name]
            value = f"([{', '.join(quoted(w) for w in words)}])[({index}) + 1]"
        else:
            value = columns[column.name]
        chosen.append(f"cast({value} as {sql_type(column.type)}) as {column.name}")
    return f"select {', '.join(chosen)} from {source}"


def staged(table, entity: str) -> str:
    names = ", ".join(c for c in table.names if c != "id")
    return f"select id as {entity}, {names} from {table.name}"


def latest() -> str:
    others = ", ".join(f"{c} asc nulls first" for c in RAW_LEADS.names if c != "id")
    names = ", ".join("lead_id" if c == "id" else c for c in RAW_LEADS.names)
    return (
        f"select {names} from (select *, row_number() over (partition by lead_id order by "
        f"coalesce(updated_at, created_at) desc nulls last, {others}) as rn from stg_leads) where rn = 1"
    )


def labels(source: str, column: str, trim: bool, keep_blank: bool, identity: str = "") -> str:
    label = f"trim({column})" if trim else column
    keep = "" if keep_blank else f"where {column} is not null" + (
        f" and trim({column}) <> ''" if trim else ""
    )
    first = f"{identity}, " if identity else ""
    return (
        f"(select {first}min({label}) as label from {source} {keep} group by {first}lower({label}))"
    )


def numbered(name: str, order: str, columns: str, source: str) -> str:
    """Dimension columns over a member query, with the dense key and empty placeholders."""
    table = STAR[name]
    given = {c.split(" as ")[-1].strip() for c in columns.split("\n")}
    listed = [line for line in columns.split("\n") if line.strip()]
    rest = [
        f"cast(null as {sql_type(c.type)}) as {c.name}"
        for c in table.columns[1:]
        if c.name not in given and f"as {c.name}" not in columns
    ]
    keys = ", ".join(f"{o} asc nulls first" for o in order.split(","))
    body = ", ".join([*listed, *rest])
    return f"select row_number() over (order by {keys}) as {table.key}, {body} from {source}"


def member(name: str, column: str, *sources: str) -> tuple[list[str], str]:
    values = " union ".join(f"select {column} from {s}" for s in sources)
    members = f"(select distinct {column} from ({values}) where {column} is not null)"
    return list(sources), numbered(name, column, f"{column} as {column}", members)


LOW = "lower(label)"
LOW_TRIM = "lower(trim(label))"

DIM_DATE = f"""
select cast(strftime(d, '%Y%m%d') as int) as date_key, cast(d as date) as full_date,
  cast(year(d) as int) as year, cast(quarter(d) as int) as quarter, cast(month(d) as int) as month,
  monthname(d) as month_name, cast(day(d) as int) as day_of_month,
  cast(dayofweek(d) + 1 as int) as day_of_week, dayname(d) as day_name,
  cast(weekofyear(d) as int) as week_of_year, case when dayofweek(d) in (5, 6) then 1 else 0 end as is_weekend
from (select unnest(generate_series(timestamp '{v.CALENDAR_START}', timestamp '{v.CALENDAR_END}',
  interval 1 day)) as d)
"""

FACT_LEAD = """
select s.lead_id, dc.customer_key, da.agent_key, ds.lead_status_key, dt.lead_type_key,
  dm.contact_method_key, dl.lead_source_key, dp.campaign_key, dr.area_key, dco.compound_key,
  dv.developer_key, d1.date_key as created_date_key, d2.date_key as last_request_date_key,
  d3.date_key as last_contact_date_key, s.budget,
  case when s.buyer = 1 then 1 else 0 end as is_buyer,
  case when s.seller = 1 then 1 else 0 end as is_seller,
  case when s.commercial = 1 then 1 else 0 end as is_commercial,
  coalesce(s.meeting_flag, 0) as meeting_flag, coalesce(s.do_not_call, 0) as do_not_call_flag,
  s.location
from latest_lead s
left join dim_customer dc on dc.customer_id = s.customer_id
left join dim_agent da on da.user_id = s.user_id
left join dim_lead_status ds on lower(ds.raw_status_name) = lower(s.status_name)
left join (select lead_type_id, min_by(lead_type_key, lead_type_name) as lead_type_key
  from dim_lead_type group by 1) dt on dt.lead_type_id = s.lead_type_id
left join dim_contact_method dm on lower(dm.raw_contact_method) = lower(trim(s.method_of_contact))
left join dim_lead_source dl on lower(dl.raw_lead_source) = lower(trim(s.lead_source))
left join dim_campaign dp on lower(dp.raw_campaign) = lower(trim(s.campaign))
left join dim_area dr on dr.area_id = s.area_id
left join dim_compound dco on dco.compound_id = s.compound_id
left join dim_developer dv on dv.developer_id = s.developer_id
left join dim_date d1 on d1.full_date = cast(s.created_at as date)
left join dim_date d2 on d2.full_date = cast(s.date_of_last_request as date)
left join dim_date d3 on d3.full_date = cast(s.date_of_last_contact as date)
"""

FACT_SALE = """
select s.sale_id, fl.lead_id, dt.property_type_key, dg.sale_category_key, dr.area_key,
  dco.compound_key, d1.date_key as reservation_date_key, d2.date_key as contract_date_key,
  s.unit_value, s.expected_value, s.actual_value, s.years_of_payment, s.unit_location
from stg_sales s
left join (select property_type_id, min_by(property_type_key, property_type_name) as property_type_key
  from dim_property_type group by 1) dt on dt.property_type_id = s.property_type_id
left join dim_sale_category dg on lower(dg.raw_sale_category) = lower(s.sale_category)
left join dim_area dr on dr.area_id = s.area_id
left join dim_compound dco on dco.compound_id = s.compound_id
left join fact_lead fl on fl.lead_id = s.lead_id
left join dim_date d1 on d1.full_date = cast(s.date_of_reservation as date)
left join dim_date d2 on d2.full_date = cast(s.date_of_contraction as date)
"""

LEAD_DIMS = [
    "dim_customer", "dim_agent", "dim_lead_status", "dim_lead_type", "dim_contact_method",
    "dim_lead_source", "dim_campaign", "dim_area", "dim_compound", "dim_developer", "dim_date",
]
SALE_DIMS = ["dim_property_type", "dim_sale_category", "dim_area", "dim_compound", "dim_date"]

CTES: dict[str, tuple[list[str], str]] = {
    "raw_leads": ([], export(
        RAW_LEADS, trade.LEAD_COLUMNS, trade.LEAD_TEXTS,
        "lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey",
    )),
    "raw_sales": ([], export(
        RAW_SALES, trade.SALE_COLUMNS, trade.SALE_TEXTS,
        "orders join customer on o_custkey = c_custkey where o_orderstatus = 'F'",
    )),
    "stg_leads": (["raw_leads"], staged(RAW_LEADS, "lead_id")),
    "stg_sales": (["raw_sales"], staged(RAW_SALES, "sale_id")),
    "latest_lead": (["stg_leads"], latest()),
    "dim_lead_status": (["stg_leads"], numbered(
        "dim_lead_status", "label",
        "\n".join([
            "label as raw_status_name",
            f"{family(LOW, v.LEAD_STATUS, v.LEAD_STATUS_OTHER, 0)} as normalized_status",
            f"{family(LOW, v.LEAD_STATUS, v.LEAD_STATUS_OTHER, 1)} as funnel_stage",
            flags(LOW, v.LEAD_STATUS, v.LEAD_STATUS_OTHER, 2, ["is_won", "is_lost", "is_active"]),
        ]),
        labels("stg_leads", "status_name", False, False),
    )),
    "dim_lead_type": (["stg_leads"], numbered(
        "dim_lead_type", "lead_type_id,label",
        "\n".join([
            "lead_type_id as lead_type_id",
            "label as lead_type_name",
            f"{family(LOW_TRIM, v.LEAD_TYPE, v.LEAD_TYPE_OTHER, 0)} as lead_type_group",
            f"{family(LOW_TRIM, v.LEAD_TYPE, v.LEAD_TYPE_OTHER, 1)} as is_commercial",
        ]),
        labels("stg_leads", "lead_type", True, False, "lead_type_id"),
    )),
    "dim_contact_method": (["stg_leads"], numbered(
        "dim_contact_method", "label",
        "\n".join([
            "label as raw_contact_method",
            f"{family(LOW_TRIM, v.CONTACT_METHOD, v.CONTACT_METHOD_OTHER, 0)} as contact_method_clean",
            f"{family(LOW_TRIM, v.CONTACT_METHOD, v.CONTACT_METHOD_OTHER, 1)} as method_group",
            flags(LOW_TRIM, v.CONTACT_METHOD, v.CONTACT_METHOD_OTHER, 2,
                  ["is_digital", "is_social", "is_call_center", "is_offline", "is_referral"]),
        ]),
        labels("stg_leads", "method_of_contact", True, False),
    )),
    "dim_lead_source": (["stg_leads"], numbered(
        "dim_lead_source", "label",
        "\n".join([
            "label as raw_lead_source",
            f"{rules(LOW_TRIM, v.LEAD_SOURCE_CLEAN, 'trim(label)')} as lead_source_clean",
            f"{rules(LOW_TRIM, v.LEAD_SOURCE_GROUP, quoted('OTHER'))} as source_group",
            flag_rules(LOW_TRIM, v.LEAD_SOURCE_FLAGS),
        ]),
        labels("stg_leads", "lead_source", True, False),
    )),
    "dim_campaign": (["stg_leads"], numbered(
        "dim_campaign", "label",
        "\n".join([
            "label as raw_campaign",
            f"case when label is null or {test(LOW_TRIM, v.CAMPAIGN_JUNK)} then 'Unknown' "
            "else trim(replace(replace(label, '%20', ' '), '  ', ' ')) end as campaign_clean",
            f"{rules(LOW_TRIM, v.CAMPAIGN_TYPE, quoted('OTHER'))} as campaign_type",
            flag_rules(LOW_TRIM, v.CAMPAIGN_FLAGS),
        ]),
        labels("stg_leads", "campaign", True, True),
    )),
    "dim_date": ([], DIM_DATE),
    "dim_customer": member("dim_customer", "customer_id", "stg_leads"),
    "dim_agent": member("dim_agent", "user_id", "stg_leads"),
    "dim_area": member("dim_area", "area_id", "stg_leads", "stg_sales"),
    "dim_compound": member("dim_compound", "compound_id", "stg_leads", "stg_sales"),
    "dim_developer": member("dim_developer", "developer_id", "stg_leads"),
    "dim_property_type": (["stg_sales"], numbered(
        "dim_property_type", "property_type_id,label",
        "\n".join([
            "property_type_id as property_type_id",
            "label as property_type_name",
            f"{family(LOW_TRIM, v.PROPERTY_TYPE, v.PROPERTY_TYPE_OTHER, 0)} as property_type_group",
            flags(LOW_TRIM, v.PROPERTY_TYPE, v.PROPERTY_TYPE_OTHER, 1,
                  ["is_residential", "is_commercial", "is_vacation"]),
        ]),
        labels("stg_sales", "property_type", True, False, "property_type_id"),
    )),
    "dim_sale_category": (["stg_sales"], numbered(
        "dim_sale_category", "label",
        "\n".join([
            "label as raw_sale_category",
            "case when label is null or trim(label) = '' then 'Unknown' else trim(label) end "
            "as sale_category_clean",
            f"{family(LOW, v.SALE_CATEGORY, v.SALE_CATEGORY_OTHER, 0)} as sale_category_group",
            flags(LOW, v.SALE_CATEGORY, v.SALE_CATEGORY_OTHER, 1,
                  ["is_primary", "is_resale", "is_developer", "is_instant_buy"]),
        ]),
        labels("stg_sales", "sale_category", False, True),
    )),
    "fact_lead": (["latest_lead", *LEAD_DIMS], FACT_LEAD),
    "fact_sale": (["stg_sales", "fact_lead", *SALE_DIMS], FACT_SALE),
}


def with_tables(needed: list[str], query: str) -> str:
    """``query`` preceded by the tables it needs, each stated once and before its first use."""
    order: list[str] = []

    def visit(name: str) -> None:
        for source in CTES[name][0]:
            visit(source)
        if name not in order:
            order.append(name)

    for name in needed:
        visit(name)
    stated = ",\n".join(f"{name} as materialized ({CTES[name][1].strip()})" for name in order)
    return f"with {stated}\n{query.strip()}" if order else query.strip()

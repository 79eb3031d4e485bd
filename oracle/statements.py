"""One SQL statement per registered query."""

from __future__ import annotations

from funnelmart.schemas import DIMENSIONS, FACTS, RAW_LEADS, RAW_SALES, STAR, Table
from oracle.tables import with_tables


def plain(name: str, type_: str, source: str | None = None) -> str:
    """Column in the form results are compared in: decimals as doubles, dates as ISO text."""
    source = source or name
    if type_.startswith("decimal"):
        return f"cast({source} as double) as {name}"
    if type_ == "date":
        return f"strftime({source}, '%Y-%m-%d') as {name}"
    return f"{source} as {name}"


def whole(table: Table, name: str, entity: str | None = None) -> str:
    columns = [plain(entity if entity and c.name == "id" else c.name, c.type) for c in table.columns]
    return with_tables([name], f"select {', '.join(columns)} from {name}")


def share(part: str, total: str) -> str:
    """Percentage to two places, halves up, in whole numbers."""
    return f"(20000 * {part} + {total}) // nullif(2 * {total}, 0) / 100.0"


def mean(column: str) -> str:
    """Mean to six places, halves up, in whole numbers of hundredths."""
    hundredths = f"sum(cast({column} * 100 as hugeint))"
    return (
        f"cast((2 * 10000 * {hundredths} + count({column})) // nullif(2 * count({column}), 0) as double)"
        " / 1000000"
    )


def total(column: str) -> str:
    return f"cast(sum({column}) as double)"


def count_if(condition: str) -> str:
    return f"cast(sum(case when {condition} then 1 else 0 end) as bigint)"


LEADS = "from fact_lead f join dim_lead_status s on s.lead_status_key = f.lead_status_key"

STAGES = {
    "to_contact": "TO_CONTACT", "contacted": "CONTACT_ATTEMPT", "meeting_booked": "MEETING_BOOKED",
    "meeting_held": "MEETING_HELD", "reservation": "RESERVATION", "contract_stage": "CONTRACT",
    "sales": "WON",
}


def days_with_use(columns: str) -> str:
    """The calendar, with the number of references to each day from either fact."""
    counts = []
    for name, alias in (("fact_lead", "lead_dates"), ("fact_sale", "sale_dates")):
        roles = [c.name for c in FACTS[name].references if c.refers_to == "dim_date"]
        used = " union all ".join(f"select {r} as day from {name}" for r in roles)
        counts.append(f"left join (select day, count(*) as n from ({used}) group by day) {alias} on {alias}.day = d.date_key")
    return (f"select {columns}, coalesce(lead_dates.n, 0) as lead_dates, coalesce(sale_dates.n, 0) as sale_dates "
            f"from dim_date d {' '.join(counts)}")


def stage(name: str) -> str:
    return count_if(f"s.funnel_stage = '{name}'")


def kpis() -> dict[str, tuple[list[str], str]]:
    lead = ["fact_lead", "dim_lead_status"]
    won = "cast(sum(s.is_won) as bigint)"
    missing = [c.name for c in FACTS["fact_lead"].references if c.refers_to != "dim_date"]
    date_columns = ", ".join(plain(c.name, c.type) for c in DIMENSIONS["dim_date"].columns)
    return {
        "kpi_funnel_distribution": (lead, f"""
            select s.funnel_stage, count(*) as leads_count {LEADS} group by s.funnel_stage"""),
        "kpi_funnel_counts": (lead, f"""
            select {', '.join(f'{stage(v)} as {k}' for k, v in STAGES.items())} {LEADS}"""),
        "kpi_conversion_rates": (lead, f"""
            select {share(stage('WON'), 'count(*)')} as final_conversion_rate_pct,
              {share(stage('MEETING_HELD'), 'count(*)')} as meeting_conversion_pct,
              {share(stage('RESERVATION'), 'count(*)')} as reservation_conversion_pct {LEADS}"""),
        "kpi_agent_performance": ([*lead, "dim_agent"], f"""
            select a.user_id, count(*) as total_leads, {won} as sales,
              {stage('MEETING_HELD')} as meetings, {share(won, 'count(*)')} as win_rate_pct
            {LEADS} join dim_agent a on a.agent_key = f.agent_key group by a.user_id"""),
        "kpi_source_performance": ([*lead, "dim_lead_source"], f"""
            select min(d.lead_source_clean) as lead_source, min(d.source_group) as source_group,
              count(*) as total_leads, {won} as sales, {share(won, 'count(*)')} as win_rate_pct
            {LEADS} join dim_lead_source d on d.lead_source_key = f.lead_source_key
            group by lower(d.lead_source_clean), lower(d.source_group)"""),
        "kpi_lead_mix": (["fact_lead"], """
            select cast(sum(is_buyer) as bigint) as buyer_leads,
              cast(sum(is_seller) as bigint) as seller_leads,
              cast(sum(is_commercial) as bigint) as commercial_leads from fact_lead"""),
        "kpi_funnel_by_month": ([*lead, "dim_date"], f"""
            select d.year, d.month, s.funnel_stage, count(*) as leads_count
            {LEADS} join dim_date d on d.date_key = f.created_date_key
            group by d.year, d.month, s.funnel_stage"""),
        "kpi_agent_lead_to_sale": (["fact_lead", "fact_sale", "dim_agent"], f"""
            select a.user_id as agent, count(distinct l.lead_id) as total_leads,
              count(distinct x.sale_id) as total_sales,
              {share('count(x.sale_id)', 'count(l.lead_id)')} as lead_to_sale_pct
            from fact_lead l left join fact_sale x on x.lead_id = l.lead_id
            join dim_agent a on a.agent_key = l.agent_key group by a.user_id"""),
        "kpi_sales_totals": (["fact_sale"], f"""
            select count(*) as total_sales, {total('actual_value')} as total_actual_value,
              {mean('actual_value')} as avg_actual_value,
              {total('expected_value')} as total_expected_value,
              {mean('expected_value')} as avg_expected_value,
              {total('unit_value')} as total_unit_value, {mean('unit_value')} as avg_unit_value,
              {mean('years_of_payment')} as avg_years_of_payment from fact_sale"""),
        "kpi_sales_by_property": (["fact_sale", "dim_property_type"], f"""
            select min(d.property_type_group) as property_type_group,
              min(d.property_type_name) as property_type_name, count(*) as sales_count,
              {total('x.actual_value')} as total_actual_value,
              {mean('x.actual_value')} as avg_actual_value,
              {mean('x.years_of_payment')} as avg_years_of_payment
            from fact_sale x join dim_property_type d on d.property_type_key = x.property_type_key
            group by lower(d.property_type_group), lower(d.property_type_name)"""),
        "kpi_sales_by_category": (["fact_sale", "dim_sale_category"], f"""
            select min(d.sale_category_group) as sale_category_group,
              min(d.sale_category_clean) as sale_category_clean, count(*) as sales_count,
              {total('x.actual_value')} as total_actual_value,
              {mean('x.actual_value')} as avg_actual_value
            from fact_sale x join dim_sale_category d on d.sale_category_key = x.sale_category_key
            group by lower(d.sale_category_group), lower(d.sale_category_clean)"""),
        "dim_date": (["dim_date", "fact_lead", "fact_sale"], days_with_use(date_columns)),
        "audit_leap_days": (["dim_date", "fact_lead", "fact_sale"], f"""
            {days_with_use(date_columns)} where month = 2 and day_of_month = 29"""),
        "audit_stg_counts": (["stg_leads"], """
            select count(*) as total_rows, count(distinct lead_id) as distinct_leads from stg_leads"""),
        "audit_duplicate_leads": (["stg_leads"], """
            select lead_id, count(*) as cnt from stg_leads group by lead_id having count(*) > 1
            order by cnt desc, lead_id limit 20"""),
        "audit_missing_keys": (["fact_lead"], f"""
            select count(*) as total_rows,
              {', '.join(f"{count_if(k + ' is null')} as missing_{k.removesuffix('_key')}" for k in missing)}
            from fact_lead"""),
        "audit_null_area": (["stg_leads"], """
            select count(*) as leads_without_area from stg_leads where area_id is null"""),
        "audit_latest_unique": (["latest_lead"], """
            select lead_id, count(*) as cnt from latest_lead group by lead_id having count(*) > 1"""),
        "audit_sales_lead_coverage": (["fact_lead", "fact_sale"], f"""
            select count(*) as total_sales, {count_if('l.lead_id is not null')} as sales_with_lead,
              {count_if('l.lead_id is null')} as sales_without_lead,
              {share(count_if('l.lead_id is not null'), 'count(*)')} as pct_with_lead
            from fact_sale x left join fact_lead l on l.lead_id = x.lead_id"""),
        "audit_distinct_campaigns": (["dim_campaign"], """
            select count(distinct lower(campaign_clean)) as distinct_campaigns from dim_campaign"""),
    }


def checks() -> dict[str, tuple[list[str], str]]:
    everything = list(STAR)
    pk = [
        f"select '{t.name}' as table_name, '{t.key}' as key_column, count(*) as row_count, "
        f"count(*) - count({t.key}) as null_keys, (select count(*) from (select {t.key} from {t.name} "
        f"group by {t.key} having count(*) > 1)) as duplicate_keys from {t.name}"
        for t in STAR.values()
    ]
    fk = [
        f"select '{f.name}' as fact, '{c.name}' as column_name, '{c.refers_to}' as refers_to, "
        f"{count_if(f'f.{c.name} is not null and d.{STAR[c.refers_to].key} is null')} as orphan_rows "
        f"from {f.name} f left join {c.refers_to} d on d.{STAR[c.refers_to].key} = f.{c.name}"
        for f in FACTS.values()
        for c in f.references
    ]
    lookup = [
        f"select '{t}' as table_name, count(*) as ids, count(case when names > 1 then 1 end) as "
        f"ambiguous_ids from (select {i}, count(distinct lower({n})) as names from {t} "
        f"where {i} is not null group by {i})"
        for t, i, n in (
            ("dim_lead_type", "lead_type_id", "lead_type_name"),
            ("dim_property_type", "property_type_id", "property_type_name"),
        )
    ]
    nulls = [
        f"select '{t.name}' as table_name, '{c.name}' as column_name, "
        f"count(*) - count({c.name}) as null_rows from {t.name}"
        for t in STAR.values()
        for c in t.columns
        if c.required
    ]
    lengths = [
        f"select '{t.name}' as table_name, '{c.name}' as column_name, {c.length} as declared_length, "
        f"cast(max(length({c.name})) as int) as longest, count(case when length({c.name}) > {c.length} then 1 end) "
        f"as too_long from {t.name}"
        for t in STAR.values()
        for c in t.columns
        if c.length
    ]
    return {
        "check_pk": (everything, " union all ".join(pk)),
        "check_fk": (everything, " union all ".join(fk)),
        "check_lookup_unique": (["dim_lead_type", "dim_property_type"], " union all ".join(lookup)),
        "check_not_null": (everything, " union all ".join(nulls)),
        "check_varchar_len": (everything, " union all ".join(lengths)),
    }


def statements() -> dict[str, str]:
    out = {
        "stg_leads": whole(RAW_LEADS, "stg_leads", "lead_id"),
        "stg_sales": whole(RAW_SALES, "stg_sales", "sale_id"),
        "latest_lead": whole(RAW_LEADS, "latest_lead", "lead_id"),
        "recon_row_counts": with_tables(["raw_leads", "raw_sales"], " union all ".join(
            f"select '{t}' as table_name, count(*) as source_rows, count(*) as target_rows, "
            f"1 as complete, 0 as malformed_rows, cast(count(*) filter (id is null) as bigint) as null_ids from {t}"
            for t in ("raw_leads", "raw_sales"))),
    }
    out |= {name: whole(table, name) for name, table in STAR.items()}
    out |= {k: with_tables(needed, sql) for k, (needed, sql) in {**kpis(), **checks()}.items()}
    return out

"""Reports come in a stated order, with ties and NULLs in it; large ones come whole."""

from __future__ import annotations

from decimal import Decimal

import pytest

from conftest import at
from funnelmart.__main__ import main
from funnelmart.plans.audits import AUDITS
from funnelmart.plans.facts import latest_leads
from funnelmart.plans.kpis import KPIS
from funnelmart.operators import lookup
from funnelmart.schemas import FACT_LEAD

WON, HELD = "Congrats... It's a sale!", "Meeting"


@pytest.fixture
def wh(build):
    leads = []

    def lead(n, **values):
        for _ in range(n):
            leads.append({"id": len(leads) + 1, "created_at": at("2024-03-05"), **values})

    lead(3, status_name=WON, user_id=2, lead_source="hotline", customer_id=1)
    lead(1, status_name="EOI", user_id=2, lead_source="hotline")
    lead(3, status_name=WON, user_id=1, lead_source="Billboard", created_at=at("2024-02-29"))
    lead(1, status_name=HELD, user_id=1, lead_source="google")
    lead(2, status_name="Low budget", user_id=None, lead_source=None, created_at=at("2023-12-31"))
    lead(2, status_name="EOI", user_id=3, lead_source="google", created_at=at("2023-12-31"))
    leads += [{"id": i, "created_at": at("2020-01-01")} for i in (7, 7, 5, 5, 9)]
    sales = [
        {"id": 1, "lead_id": 1, "property_type_id": 1, "property_type": "Villa", "actual_value": Decimal(10), "sale_category": "Primary"},
        {"id": 2, "lead_id": 1, "property_type_id": 2, "property_type": "Cabin", "actual_value": Decimal(10), "sale_category": "Auction"},
        {"id": 3, "lead_id": 2, "property_type_id": 3, "property_type": "Office", "actual_value": Decimal(90), "sale_category": "Resale Buyer"},
        {"id": 4, "lead_id": 3, "property_type_id": 4, "property_type": "Garage", "actual_value": None, "sale_category": None},
    ]
    return build(leads, sales)


def rows(wh, name, *columns):
    queries = {**KPIS, **AUDITS}
    return [tuple(r[c] for c in columns) for r in queries[name](wh.table).collect()]


def test_funnel_distribution_by_count_then_stage(wh):
    found = rows(wh, "kpi_funnel_distribution", "leads_count", "funnel_stage")
    assert found == sorted(found, key=lambda r: (-r[0], r[1])) and len(found) > 3


def test_agents_by_sales_then_id(wh):
    assert rows(wh, "kpi_agent_performance", "user_id", "sales") == [(1, 3), (2, 3), (3, 0)]


def test_sources_by_sales_then_name(wh):
    assert rows(wh, "kpi_source_performance", "lead_source", "sales") == [("Billboard", 3), ("offline", 3), ("google/search", 0)]


def test_months_by_time_count_and_stage(wh):
    found = rows(wh, "kpi_funnel_by_month", "year", "month", "leads_count", "funnel_stage")
    assert found == sorted(found, key=lambda r: (r[0], r[1], -r[2], r[3]))
    assert found[-1][:2] == (2024, 3) and (2023, 12, 2, "DISQUALIFIED") in found


def test_sales_by_value_then_name_and_nulls_last(wh):
    found = rows(wh, "kpi_sales_by_property", "property_type_name", "total_actual_value")
    assert [r[0] for r in found] == ["Office", "Cabin", "Villa", "Garage"] and found[-1][1] is None
    found = rows(wh, "kpi_sales_by_category", "sale_category_clean", "total_actual_value")
    assert [r[0] for r in found][:3] == ["Resale Buyer", "Auction", "Primary"]


def test_duplicates_by_count_then_id(wh):
    assert rows(wh, "audit_duplicate_leads", "lead_id", "cnt") == [(5, 3), (7, 3), (9, 2)]


def test_leap_days_by_date(wh):
    days = [r[0] for r in rows(wh, "audit_leap_days", "full_date")]
    assert days == sorted(days) and len(days) == 8


def test_a_report_is_given_whole(build, spark, tmp_path, capsys):
    wh = build([{"id": i, "user_id": i, "status_name": "EOI"} for i in range(1500)])
    wh.refresh()
    root = str(tmp_path / "wh")
    main(["report", root, "kpi_agent_performance"])
    assert len(capsys.readouterr().out.splitlines()) == 1501
    main(["report", root, "kpi_agent_performance", "--output", str(tmp_path / "out"), "--format", "csv"])
    assert spark.read.csv(str(tmp_path / "out"), header=True).count() == 1500


def test_hot_values_are_sought_among_the_rows_that_are_joined(build, monkeypatch):
    leads = [{"id": i, "customer_id": 77, "created_at": at("2024-01-01")} for i in range(100)]
    for i in range(100, 1000):
        leads += [{"id": i, "customer_id": i, "created_at": at("2024-01-01"), "budget": Decimal(v)} for v in range(12)]
    wh = build(leads)
    seen = {}
    real = lookup.hot_values

    def spy(profile, lookups):
        seen.update(real(profile, lookups))
        return seen

    monkeypatch.setattr(lookup, "hot_values", spy)
    from funnelmart.plans import facts

    found = facts.fact_lead(wh.table("stg_leads"), wh.table, broadcast_bytes=0)
    assert 77 in seen["customer_key"]
    assert found.columns == FACT_LEAD.names
    assert found.groupBy("customer_key").count().orderBy("count", ascending=False).first()["count"] == 100
    assert latest_leads(wh.table("stg_leads")).count() == 1000


def test_broadcasts_are_bounded_together():
    names = [lookup.Lookup(a, None, "k", "m", "o") for a in "abcd"]
    large = lookup.beyond(names, {"a": 40, "b": 10, "c": 30, "d": 25}, 64)
    assert sorted(x.alias for x in large) == ["a", "c"]


@pytest.mark.parametrize("broadcast_bytes", [None, 0])
def test_sales_meet_their_leads_once(wh, broadcast_bytes):
    options = {} if broadcast_bytes is None else {"broadcast_bytes": broadcast_bytes}
    plan = KPIS["kpi_agent_lead_to_sale"](wh.table, **options)._jdf.queryExecution().optimizedPlan().toString()
    sales = str(wh.store.path("fact_sale"))
    assert sum("sale_id" in line and "Relation" in line for line in plan.splitlines()) == 1, (sales, plan)

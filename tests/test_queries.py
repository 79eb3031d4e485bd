"""Every table, KPI, audit and check against SQL on the same messy rows."""

from __future__ import annotations

import datetime
import random
from decimal import Decimal

import duckdb
import pytest

import verify
from funnelmart.plans.audits import AUDITS, calendar_use
from funnelmart.plans.checks import CHECKS
from funnelmart.plans.kpis import KPIS, agent_lead_to_sale
from funnelmart.plans import facts
from funnelmart.plans.warehouse import Warehouse, open_tables
from funnelmart.registry import STAR_QUERIES, comparable
from funnelmart.schemas import STAR
from funnelmart.sources import trade
from oracle import tables
from oracle.statements import statements, whole

QUERIES = STAR_QUERIES


def messy_exports(seed: int):
    """Exports where one lead, agent, customer, status and sold lead hold a third of the rows each."""
    rng = random.Random(seed)

    def hot(usual, common):
        return common if rng.random() < 0.33 else usual()

    def moment():
        if rng.random() < 0.2:
            return None
        return datetime.datetime(2009, 11, 1) + datetime.timedelta(days=rng.randrange(400), hours=rng.randrange(24))

    def word(words):
        value = rng.choice([*words, None, "", "  ", "odd one"])
        style = rng.choice([str, str.upper, str.title, lambda v: f" {v}", lambda v: f"{v} "])
        return None if value is None else style(value)

    def pick(n):
        return rng.choice([None, *range(n)])

    leads = [
        {
            "id": hot(lambda: rng.randrange(1, 400), 7), "created_at": moment(), "updated_at": moment(),
            "date_of_last_request": moment(), "date_of_last_contact": moment(),
            "buyer": pick(3), "seller": pick(3), "commercial": pick(3), "meeting_flag": pick(3),
            "do_not_call": pick(3), "merged": pick(2),
            "budget": rng.choice([None, Decimal(rng.randrange(10**9)) / 100]),
            "user_id": hot(lambda: pick(15), 3), "customer_id": hot(lambda: pick(200), None),
            "area_id": pick(9), "compound_id": hot(lambda: pick(30), 5), "developer_id": pick(6),
            "location": word(["north"]), "best_time_to_call": word(["noon"]),
            "status_name": hot(lambda: word(trade.STATUSES), "Meeting"),
            "lead_type_id": pick(5), "lead_type": word(trade.LEAD_TYPES),
            "method_of_contact": word(trade.CONTACT_METHODS), "lead_source": word(trade.LEAD_SOURCES),
            "campaign": word(trade.CAMPAIGNS),
        }
        for _ in range(1500)
    ]
    money = lambda: rng.choice([None, Decimal(rng.randrange(10**10)) / 100])
    sales = [
        {
            "id": i if i % 50 else 1, "lead_id": hot(lambda: rng.choice([None, rng.randrange(500)]), 7),
            "unit_value": money(), "expected_value": money(), "actual_value": money(),
            "years_of_payment": rng.choice([None, Decimal(rng.randrange(1000)) / 100]),
            "unit_location": word(["east"]), "date_of_reservation": moment(),
            "date_of_contraction": moment(), "property_type_id": pick(4), "area_id": pick(12),
            "compound_id": pick(40), "property_type": word(trade.PROPERTY_TYPES),
            "sale_category": word(trade.SALE_CATEGORIES),
        }
        for i in range(400)
    ]
    return leads, sales


@pytest.fixture(scope="module")
def messy(spark, leads, sales, tmp_path_factory):
    lead_rows, sale_rows = messy_exports(11)
    wh = Warehouse(spark, str(tmp_path_factory.mktemp("messy")), leads(lead_rows), sales(sale_rows))
    wh.refresh()
    con = duckdb.connect()
    con.register("lead_rows", wh.table("raw_leads").toArrow())
    con.register("sale_rows", wh.table("raw_sales").toArrow())
    return wh, con


@pytest.fixture(autouse=True)
def rows_in_place_of_order_tables(monkeypatch):
    monkeypatch.setitem(tables.CTES, "raw_leads", ([], "select * from lead_rows"))
    monkeypatch.setitem(tables.CTES, "raw_sales", ([], "select * from sale_rows"))


def agree(con, name, ours):
    cursor = con.execute(statements()[name])
    columns = [d[0] for d in cursor.description]
    ours = comparable(ours)
    assert sorted(columns) == sorted(ours.columns)
    expected = verify.normal(columns, cursor.fetchall())
    assert verify.normal(ours.columns, ours.collect()) == expected
    return expected


@pytest.mark.parametrize("name", ["latest_lead", *[t for t in STAR if t != "dim_date"]])
def test_table(messy, name):
    wh, con = messy
    assert agree(con, name, wh.table(name))


def test_whole_calendar(messy, monkeypatch):
    wh, con = messy
    assert len(agree(con, "dim_date", calendar_use(wh.table))) == 11323
    whole_calendar = {"dim_date": whole(STAR["dim_date"], "dim_date")}
    monkeypatch.setattr(f"{__name__}.statements", lambda: whole_calendar)
    assert len(agree(con, "dim_date", wh.table("dim_date"))) == 11323
    assert [r.full_date.year for r in AUDITS["audit_leap_days"](wh.table).collect()] == list(range(2012, 2041, 4))


@pytest.mark.parametrize("name", QUERIES)
def test_query(messy, name):
    wh, con = messy
    rows = agree(con, name, QUERIES[name](wh.table))
    assert rows or name in ("audit_latest_unique", "audit_leap_days")


def test_facts_by_shuffle_lookup(messy):
    wh, con = messy
    agree(con, "fact_lead", facts.fact_lead(wh.table("stg_leads"), wh.table, broadcast_bytes=0))
    agree(con, "fact_sale", facts.fact_sale(wh.table("stg_sales"), wh.table, broadcast_bytes=0))
    agree(con, "kpi_agent_lead_to_sale", agent_lead_to_sale(wh.table, broadcast_bytes=0))


def test_rebuild_gives_the_same_tables(spark, messy, tmp_path):
    wh, _ = messy
    shuffled = {name: export.repartition(5).orderBy("area_id") for name, export in wh.exports.items()}
    again = Warehouse(spark, str(tmp_path), shuffled["raw_leads"], shuffled["raw_sales"])
    again.refresh()
    for name in STAR:
        assert sorted(map(repr, again.table(name).collect())) == sorted(map(repr, wh.table(name).collect()))


def test_stored_tables_can_be_opened_later(spark, messy):
    wh, con = messy
    table = open_tables(spark, wh.store.root)
    agree(con, "kpi_agent_performance", KPIS["kpi_agent_performance"](table))
    agree(con, "audit_stg_counts", AUDITS["audit_stg_counts"](table))


def test_queries_on_empty_tables(build):
    table = build([], []).table
    assert tuple(KPIS["kpi_funnel_counts"](table).first()) == (None,) * 7
    assert tuple(KPIS["kpi_conversion_rates"](table).first()) == (None,) * 3
    assert tuple(KPIS["kpi_lead_mix"](table).first()) == (None,) * 3
    assert tuple(KPIS["kpi_sales_totals"](table).first()) == (0, *(None,) * 7)
    assert tuple(AUDITS["audit_sales_lead_coverage"](table).first()) == (0, None, None, None)
    assert KPIS["kpi_agent_lead_to_sale"](table).count() == 0


def test_lead_to_sale_counts_join_rows(build):
    """Two sales of one lead weigh twice on both sides; an unsold lead weighs once below."""
    wh = build(
        [{"id": 1, "user_id": 5}, {"id": 2, "user_id": 5}, {"id": 3}],
        [{"id": 1, "lead_id": 1}, {"id": 2, "lead_id": 1}, {"id": 3, "lead_id": 3}],
    )
    row = KPIS["kpi_agent_lead_to_sale"](wh.table).collect()
    assert [(r.agent, r.total_leads, r.total_sales, str(r.lead_to_sale_pct)) for r in row] == [
        (5, 2, 2, "66.67")
    ]


def test_checks_find_violations(spark, messy):
    wh, _ = messy
    fact = wh.table("fact_lead").limit(3).collect()
    broken = [
        {**fact[0].asDict(), "lead_id": 1, "agent_key": 999, "location": "x" * 300},
        {**fact[1].asDict(), "lead_id": 1, "agent_key": None},
        {**fact[2].asDict(), "lead_id": None, "created_date_key": 19990101},
    ]
    broken = spark.createDataFrame([tuple(r.values()) for r in broken], wh.table("fact_lead").schema)
    table = lambda name: broken if name == "fact_lead" else wh.table(name)
    pk = {r.table_name: r for r in CHECKS["check_pk"](table).collect()}["fact_lead"]
    assert (pk.row_count, pk.null_keys, pk.duplicate_keys) == (3, 1, 1)
    fk = {(r.fact, r.column_name): r.orphan_rows for r in CHECKS["check_fk"](table).collect()}
    assert len(fk) == 20
    assert fk["fact_lead", "agent_key"] == 1 and fk["fact_lead", "created_date_key"] == 1
    assert fk["fact_lead", "customer_key"] == 0 and fk["fact_sale", "lead_id"] > 0
    nulls = {(r.table_name, r.column_name): r.null_rows for r in CHECKS["check_not_null"](table).collect()}
    assert nulls["fact_lead", "lead_id"] == 1
    lengths = {(r.table_name, r.column_name): r for r in CHECKS["check_varchar_len"](table).collect()}
    assert lengths["fact_lead", "location"].longest == 300
    assert lengths["fact_lead", "location"].too_long == 1


def test_ambiguous_lookup_ids_are_reported(build):
    wh = build([{"id": 1, "lead_type_id": 5, "lead_type": "Seller"},
                {"id": 2, "lead_type_id": 5, "lead_type": "Primary"},
                {"id": 3, "lead_type_id": 6, "lead_type": "primary"},
                {"id": 4, "lead_type_id": 6, "lead_type": "Primary"}])
    found = {r.table_name: (r.ids, r.ambiguous_ids) for r in CHECKS["check_lookup_unique"](wh.table).collect()}
    assert found == {"dim_lead_type": (2, 1), "dim_property_type": (0, 0)}

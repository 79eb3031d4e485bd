from __future__ import annotations

from decimal import Decimal

from conftest import at
from funnelmart.schemas import DIMENSIONS, FACT_LEAD, FACT_SALE


def rows_by(df, key):
    return {row[key]: row for row in df.collect()}


def test_lead_fact(build):
    wh = build([
        {"id": 1, "created_at": at("2009-12-31 23:59:59"), "status_name": "EOI", "buyer": 2,
         "meeting_flag": 2, "budget": Decimal("10.50"), "customer_id": 9, "location": "North"},
        {"id": 1, "created_at": at("2009-12-31"), "updated_at": at("2010-01-01"), "status_name": "eoi",
         "buyer": 1, "seller": 0, "do_not_call": 1, "campaign": "  ", "lead_source": " Google ",
         "date_of_last_request": at("2040-12-31 12:00:00"), "date_of_last_contact": at("2041-01-01")},
        {"id": 2, "created_at": at("2024-02-29 08:00:00"), "commercial": None, "campaign": None,
         "lead_source": "GOOGLE", "user_id": 3, "area_id": 4},
    ], [{"id": 1, "area_id": 5}])
    fact = rows_by(wh.table("fact_lead"), "lead_id")
    status = rows_by(wh.table("dim_lead_status"), "lead_status_key")
    source = rows_by(wh.table("dim_lead_source"), "lead_source_key")
    campaign = rows_by(wh.table("dim_campaign"), "campaign_key")
    area = rows_by(wh.table("dim_area"), "area_key")

    assert wh.table("fact_lead").columns == FACT_LEAD.names
    first, second = fact[1], fact[2]
    assert status[first.lead_status_key].raw_status_name == "EOI"
    assert (first.is_buyer, first.is_seller, first.is_commercial) == (1, 0, 0)
    assert (first.meeting_flag, first.do_not_call_flag, second.is_commercial) == (0, 1, 0)
    assert first.created_date_key is None
    assert first.last_request_date_key == 20401231
    assert first.last_contact_date_key is None
    assert second.created_date_key == 20240229
    assert (first.customer_key, first.budget, first.location) == (None, None, None)
    assert campaign[first.campaign_key].campaign_clean == "Unknown"
    assert campaign[first.campaign_key].raw_campaign == ""
    assert second.campaign_key is None, "a NULL campaign is a member but is never looked up"
    assert {r.raw_campaign for r in campaign.values()} == {None, ""}
    assert source[first.lead_source_key].raw_lead_source == "GOOGLE"
    assert first.lead_source_key == second.lead_source_key
    assert {r.area_id for r in area.values()} == {4, 5}


def test_flags_other_than_one_and_null(build):
    wh = build([{"id": i, "meeting_flag": v, "do_not_call": v, "buyer": v}
                for i, v in enumerate([0, 1, 2, None])])
    fact = rows_by(wh.table("fact_lead"), "lead_id")
    assert [fact[i].is_buyer for i in range(4)] == [0, 1, 0, 0]
    assert [fact[i].meeting_flag for i in range(4)] == [0, 1, 2, 0]
    assert [fact[i].do_not_call_flag for i in range(4)] == [0, 1, 2, 0]


def test_one_type_id_with_two_names_does_not_multiply_leads(build):
    wh = build([
        {"id": 1, "lead_type_id": 5, "lead_type": "Seller"},
        {"id": 2, "lead_type_id": 5, "lead_type": "Primary"},
        {"id": 3, "lead_type_id": 6, "lead_type": None},
    ])
    fact = rows_by(wh.table("fact_lead"), "lead_id")
    types = rows_by(wh.table("dim_lead_type"), "lead_type_key")
    assert len(types) == 2 and len(fact) == 3
    assert types[fact[1].lead_type_key].lead_type_name == "Primary"
    assert types[fact[2].lead_type_key].lead_type_name == "Primary"
    assert fact[3].lead_type_key is None


def test_sale_fact(build):
    wh = build(
        [{"id": 10}, {"id": 11}],
        [
            {"id": 1, "lead_id": 10, "sale_category": " Primary ", "actual_value": Decimal("5.00"),
             "property_type_id": 1, "property_type": "Villa", "compound_id": 3,
             "date_of_reservation": at("2010-01-01 01:00:00")},
            {"id": 2, "lead_id": 10, "sale_category": "primary"},
            {"id": 3, "lead_id": 99, "sale_category": None, "property_type_id": 2},
        ],
    )
    fact = rows_by(wh.table("fact_sale"), "sale_id")
    category = rows_by(wh.table("dim_sale_category"), "sale_category_key")
    assert wh.table("fact_sale").columns == FACT_SALE.names
    assert [fact[i].lead_id for i in (1, 2, 3)] == [10, 10, None]
    assert category[fact[1].sale_category_key].raw_sale_category == " Primary "
    assert category[fact[2].sale_category_key].sale_category_group == "PRIMARY"
    assert fact[3].sale_category_key is None and fact[3].property_type_key is None
    assert fact[1].reservation_date_key == 20100101 and fact[1].contract_date_key is None


def test_empty_exports_give_empty_tables(build):
    wh = build([], [])
    wh.refresh()
    assert wh.table("fact_lead").count() == wh.table("fact_sale").count() == 0
    for name in DIMENSIONS:
        assert wh.table(name).count() == (11323 if name == "dim_date" else 0)


def test_surrogate_keys_are_dense(build):
    wh = build([{"id": i, "customer_id": i * 10 % 97, "campaign": f"c{i % 13}"} for i in range(300)])
    for name in ("dim_customer", "dim_campaign"):
        keys = sorted(r[0] for r in wh.table(name).collect())
        assert keys == list(range(1, len(keys) + 1))

"""Lead and sale exports derived from order tables (orders, lineitem, customer).

An order plays the lead and each of its lines a version of it; closed orders play the sales. Column
expressions are SQL that Spark and other engines read alike, so that the same text can define the
exports elsewhere. Texts come from the vocabularies below by index; an index past the end means NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelmart.functions import vocabulary as v
from funnelmart.functions.text import literals
from funnelmart.schemas import RAW_LEADS, RAW_SALES, Table
from funnelmart.sources.exports import conform


def words(families) -> list[str]:
    return [word for family in families for word in family[0]]


LEAD_TYPES = [" Seller " if w == "Seller" else w for w in words(v.LEAD_TYPE)] + ["Walk-up"]
CONTACT_METHODS = words(v.CONTACT_METHOD) + ["Facebook", " google ", "GOOGLE", "pigeon post", "", "  "]
LEAD_SOURCES = [
    "Facebook", "facebook ", "form facebook", "Instagram ads", "YouTube", "whatsapp", "whatsapp form",
    "Google", "form google", "maps.google.com", "x google_ads y", "x google ads y", "google_ads",
    "googleads.g.doubleclick.net", "bing.com", "10bestseo.com", "propertyfinder", "www.propertyfinder.eg",
    "website", "landing page 3", "organic search", "Organic", "Broker App", "client referral",
    "Through Friends", "walk-in", "hotline", "SMS", "call center resale", "direct", "(none)", "unknown",
    "unpaid", "cpc-display", "paid search", "criteo", "linkedin", "  billboard  ", "", "   ",
    *v.PARTNER_SOURCES, *v.INTERNAL_SOURCES,
]
CAMPAIGNS = [
    "Brand%20Search", "brand  awareness", "BRAND REMARKETING", "Remarket   March", "retarget-all",
    "pmax_cairo", "Display%20%20North", "demandgen", "prospecting Q1", "SMS blast", "0", "(none)",
    "(None)", "", "   ", "  spaced out  ", "Summer Launch", "summer launch",
]
PROPERTY_TYPES = [
    "Apartment", "DUPLEX", "penthouse", "Studio", "Serviced Apartment", " Family House ", "Villa",
    "townhouse", "TwinHouse", "Chalet", "CABIN", "Office", "retail", "Clinic", "Parking",
]
SALE_CATEGORIES = words(v.SALE_CATEGORY) + ["  Resale Buyer  "]
STATUSES = words(v.LEAD_STATUS) + ["Call back later"]

# text column -> (vocabulary, index); the vocabulary's end and beyond give NULL
LEAD_TEXTS = {
    "status_name": (STATUSES, f"(l_orderkey * 7 + l_linenumber * 3 + l_partkey) % {len(STATUSES) + 1}"),
    "lead_type": (LEAD_TYPES, f"l_partkey % {len(LEAD_TYPES) + 1}"),
    "method_of_contact": (CONTACT_METHODS, f"l_partkey % {len(CONTACT_METHODS) + 1}"),
    "lead_source": (LEAD_SOURCES, f"l_suppkey % {len(LEAD_SOURCES) + 1}"),
    "campaign": (CAMPAIGNS, f"(l_partkey + l_suppkey) % {len(CAMPAIGNS) + 1}"),
}
# Order dates run from 1995; the shift puts the first months before the calendar and the rest into it.
SHIFT = "interval 176 month"
LEAD_COLUMNS = {
    "id": "l_orderkey",
    "date_of_last_request": f"l_shipdate + {SHIFT}",
    "buyer": "l_linenumber % 2",
    "seller": "case when o_custkey % 3 = 0 then 1 else 0 end",
    "best_time_to_call": "cast(null as varchar(20))",
    "budget": "cast(l_extendedprice as decimal(18,2))",
    "created_at": f"o_orderdate + {SHIFT}",
    "updated_at": f"case when l_linenumber % 5 = 0 then null else l_shipdate + {SHIFT} end",
    "user_id": "case when o_custkey % 11 = 0 then null else o_custkey % 50 end",
    "location": "c_mktsegment",
    "date_of_last_contact": f"case when l_linenumber % 4 = 0 then null else l_shipdate + {SHIFT} end",
    "commercial": (
        "case when l_partkey % 17 = 0 then null when o_orderpriority = '1-URGENT' then 1 else 0 end"
    ),
    "merged": "0",
    "area_id": "case when l_orderkey % 13 = 0 then null else c_nationkey end",
    "compound_id": "l_suppkey",
    "developer_id": "case when l_partkey % 9 = 0 then null else l_partkey % 40 end",
    "meeting_flag": "nullif(l_partkey % 3, 2)",
    "do_not_call": "case when o_custkey % 19 = 0 then 1 else null end",
    "lead_type_id": f"nullif(l_partkey % {len(LEAD_TYPES) + 1}, {len(LEAD_TYPES)})",
    "customer_id": "case when l_orderkey % 29 = 0 then null else o_custkey end",
}
SALE_TEXTS = {
    "property_type": (PROPERTY_TYPES, f"o_custkey % {len(PROPERTY_TYPES) + 1}"),
    "sale_category": (SALE_CATEGORIES, f"o_orderkey % {len(SALE_CATEGORIES) + 1}"),
}
SALE_COLUMNS = {
    "id": "o_orderkey",
    "lead_id": "o_orderkey - o_orderkey % 2",
    "unit_value": "cast(o_totalprice as decimal(18,2))",
    "unit_location": "c_mktsegment",
    "expected_value": "cast(o_totalprice as decimal(18,2)) + 1000",
    "actual_value": "case when o_orderkey % 7 = 0 then null else cast(o_totalprice as decimal(18,2)) end",
    "date_of_reservation": f"o_orderdate + {SHIFT}",
    "reservation_update_date": f"o_orderdate + {SHIFT}",
    "date_of_contraction": (
        f"case when o_custkey % 6 = 0 then null else o_orderdate + {SHIFT} + interval 30 day end"
    ),
    "property_type_id": f"nullif(o_custkey % {len(PROPERTY_TYPES) + 1}, {len(PROPERTY_TYPES)})",
    "area_id": "c_nationkey + 5",
    "compound_id": "o_custkey % 120",
    "years_of_payment": "cast(o_custkey % 10 as decimal(10,2))",
}


def derive(rows: DataFrame, columns: dict, texts: dict, table: Table) -> DataFrame:
    chosen = [f"{sql} as {name}" for name, sql in columns.items()]
    chosen += [
        f"get(array({literals(vocabulary)}), cast({index} as int)) as {name}"
        for name, (vocabulary, index) in texts.items()
    ]
    return conform(rows.selectExpr(*chosen), table)


TABLES = ("lineitem", "orders", "customer")


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def raw_leads(spark: SparkSession, folder: str) -> DataFrame:
    lines, orders, customers = (read(spark, folder, t) for t in TABLES)
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        customers, F.col("o_custkey") == F.col("c_custkey")
    )
    return derive(rows, LEAD_COLUMNS, LEAD_TEXTS, RAW_LEADS)


def raw_sales(spark: SparkSession, folder: str) -> DataFrame:
    closed = read(spark, folder, "orders").where("o_orderstatus = 'F'")
    rows = closed.join(read(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return derive(rows, SALE_COLUMNS, SALE_TEXTS, RAW_SALES)

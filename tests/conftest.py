from __future__ import annotations

import datetime
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from funnelmart.plans import staging  # noqa: E402
from funnelmart.plans.warehouse import Warehouse  # noqa: E402
from funnelmart.schemas import RAW_LEADS, RAW_SALES  # noqa: E402
from funnelmart.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, "tests", **{
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    yield session
    session.stop()


def at(text: str | None):
    return None if text is None else datetime.datetime.fromisoformat(text)


@pytest.fixture(scope="session")
def make(spark):
    """Export rows from partial dictionaries; missing columns are NULL."""

    def build(table, rows):
        full = [tuple(row.get(name) for name in table.names) for row in rows]
        return spark.createDataFrame(full, table.struct)

    return build


@pytest.fixture(scope="session")
def leads(make):
    return lambda rows: make(RAW_LEADS, rows)


@pytest.fixture(scope="session")
def sales(make):
    return lambda rows: make(RAW_SALES, rows)


@pytest.fixture
def build(spark, leads, sales, tmp_path):
    """A warehouse over hand-written rows."""
    return lambda lead_rows, sale_rows=(): Warehouse(
        spark, str(tmp_path / "wh"), leads(lead_rows), sales(sale_rows)
    )


@pytest.fixture
def staged(leads, sales):
    def make_staged(lead_rows=(), sale_rows=()):
        return staging.stage_leads(leads(lead_rows)), staging.stage_sales(sales(sale_rows))

    return make_staged

"""A refresh becomes visible as a whole, or not at all."""

from __future__ import annotations

import subprocess
import sys
import textwrap
import threading
from pathlib import Path

import pytest

from funnelmart.plans import warehouse as wh
from funnelmart.plans.kpis import KPIS
from funnelmart.sources.tables import TableStore

ROOT = Path(__file__).resolve().parent.parent


def lead_ids(table):
    return sorted(r.lead_id for r in table("fact_lead").collect())


@pytest.fixture
def old(spark, leads, sales, tmp_path):
    """A refreshed warehouse of two leads, and its folder."""
    root = str(tmp_path / "wh")
    built = wh.Warehouse(spark, root, leads([{"id": 1, "campaign": "a"}, {"id": 2}]), sales([{"id": 5, "lead_id": 1}]))
    built.refresh()
    return built, root


def new(spark, root, leads, sales):
    return wh.Warehouse(spark, root, leads([{"id": i, "campaign": "b"} for i in (7, 8, 9)]), sales([{"id": 6, "lead_id": 7}]))


@pytest.mark.parametrize("at", ["dim_campaign", "fact_lead", "fact_sale"])
def test_a_failed_refresh_changes_nothing(spark, leads, sales, old, at, monkeypatch):
    built, root = old
    plan = wh.Layers.plan

    def fails(self, name, label="plan"):
        if name == at:
            raise OSError("disk is gone")
        return plan(self, name, label)

    monkeypatch.setattr(wh.Layers, "plan", fails)
    built.exports = new(spark, root, leads, sales).exports
    before = set(Path(root).glob("version-*/*"))
    with pytest.raises(OSError):
        built.refresh()
    assert lead_ids(built.table) == lead_ids(wh.open_tables(spark, root)) == [1, 2]
    assert set(Path(root).glob("version-*/*")) == before, "what it wrote is removed"
    monkeypatch.undo()
    built.refresh()
    assert lead_ids(built.table) == lead_ids(wh.open_tables(spark, root)) == [7, 8, 9]


def test_a_killed_refresh_changes_nothing(spark, old):
    built, root = old
    before = {name: [tuple(r) for r in KPIS[name](wh.open_tables(spark, root)).collect()] for name in KPIS}
    killed = textwrap.dedent(f"""
        import os, sys
        sys.path.insert(0, {str(ROOT)!r})
        from funnelmart.plans import facts, warehouse
        from funnelmart.schemas import RAW_LEADS, RAW_SALES
        from funnelmart.session import local_session
        spark = local_session(2, "killed")
        rows = [spark.createDataFrame([(9, *[None] * (len(t.names) - 1))], t.struct) for t in (RAW_LEADS, RAW_SALES)]
        facts.fact_sale = lambda *a, **k: os._exit(9)
        warehouse.Warehouse(spark, {root!r}, *rows).refresh()
    """)
    assert subprocess.run([sys.executable, "-c", killed], capture_output=True, timeout=240).returncode == 9
    assert len(list(Path(root).glob("version-*/fact_lead"))) == 2, "the killed refresh got as far as the lead fact"
    read = wh.open_tables(spark, root)
    assert {name: [tuple(r) for r in KPIS[name](read).collect()] for name in KPIS} == before
    built.store.clean(abandoned_hours=0)
    assert len(list(Path(root).glob("version-*"))) == 1
    assert lead_ids(read) == [1, 2]


def test_readers_stay_on_their_version(spark, leads, sales, old):
    built, root = old
    read = wh.open_tables(spark, root)
    other = new(spark, root, leads, sales)
    other.refresh()
    assert lead_ids(read) == [1, 2] and lead_ids(wh.open_tables(spark, root)) == [7, 8, 9]
    assert {r.raw_campaign for r in read("dim_campaign").collect()} == {"a", None}
    other.refresh()
    other.refresh()
    states = sorted(p.name for p in (Path(root) / "_states").glob("*.json"))
    assert len(states) == 2, "states before the last two are removed"
    for name in ("raw_leads", "dim_campaign", "fact_lead"):
        assert len(list(Path(root).glob(f"version-*/{name}"))) == 2
    assert not list((Path(root) / "_states").glob(".draft*.json"))


def test_writers_at_once_each_leave_a_whole_state(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    folders = [{n: store.write(n, spark.range(i + 1), f"v{i}") for n in ("a", "b")} for i in range(4)]
    threads = [threading.Thread(target=store.commit, args=(f,)) for f in folders]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert store.state() in folders
    assert store.read("a").count() == store.read("b").count()


def test_replace_leaves_other_tables(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.replace("a", spark.range(2))
    store.replace("b", spark.range(3))
    first = store.read("a")
    store.replace("a", spark.range(5))
    assert (store.read("a").count(), store.read("b").count(), first.count()) == (5, 3, 2)
    with pytest.raises(Exception, match="no such column|UNRESOLVED|cannot"):
        store.replace("a", spark.range(2).selectExpr("raise_error('no such column') as id"))
    assert store.read("a").count() == 5


def test_reading_before_any_refresh_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="no refresh has stored fact_lead"):
        wh.open_tables(spark, str(tmp_path))("fact_lead")

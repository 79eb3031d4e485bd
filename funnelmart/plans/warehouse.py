"""The warehouse: exports, staging, dimensions and facts, stored layer by layer."""

from __future__ import annotations

import threading
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from funnelmart.plans import dimensions, facts, staging
from funnelmart.schemas import DIMENSIONS, STAR
from funnelmart.sources.exports import MALFORMED
from funnelmart.sources.tables import TableStore, reconcile

EXPORTS = ("raw_leads", "raw_sales")
WRITERS = 8  # dimensions written at the same time


class Layers:
    """One version of all tables, written layer by layer; each table on first use."""

    def __init__(self, store: TableStore, exports: dict[str, DataFrame]):
        self.store, self.exports = store, exports
        self.version = uuid.uuid4().hex
        self.stored: dict[str, DataFrame] = {}
        self.folders: dict[str, str] = {}
        self._locks = {name: threading.Lock() for name in (*EXPORTS, *STAR)}

    def plan(self, name: str, label: str = "plan") -> DataFrame:
        """How a table follows from the layers below it; intermediate results are kept under ``label``."""
        if name in EXPORTS:
            return self.exports[name].drop(MALFORMED)
        if name == "stg_leads":
            return staging.stage_leads(self.table("raw_leads"))
        if name == "stg_sales":
            return staging.stage_sales(self.table("raw_sales"))
        if name == "latest_lead":
            return facts.latest_leads(self.table("stg_leads"))
        if name in DIMENSIONS:
            return dimensions.dimension(
                name, self.table("stg_leads"), self.table("stg_sales"), self.store.scratch(label)
            )
        if name == "fact_lead":
            self.store_all(DIMENSIONS)
            return facts.fact_lead(self.table("stg_leads"), self.table, store=self.keeper(label))
        if name == "fact_sale":
            return facts.fact_sale(self.table("stg_sales"), self.table, store=self.keeper(label))
        raise KeyError(name)

    def keeper(self, label: str):
        """Writes an intermediate result once and reads it from there."""

        def keep(rows: DataFrame) -> DataFrame:
            path = self.store.scratch(label)
            rows.write.parquet(path)
            return rows.sparkSession.read.schema(rows.schema).parquet(path)

        return keep

    def table(self, name: str) -> DataFrame:
        if name not in self._locks:  # views over stored tables
            return self.plan(name)
        with self._locks[name]:
            if name not in self.stored:
                label = f"{name}-{self.version}"
                rows = self.plan(name, label)
                self.folders[name] = self.store.write(name, rows, self.version)
                self.stored[name] = self.store.read_folder(self.folders[name], rows.schema)
                self.store.clear_scratch(label)
            return self.stored[name]

    def store_all(self, names) -> None:
        """Write tables that do not depend on each other, a few at a time."""
        with ThreadPoolExecutor(WRITERS) as writers:
            list(writers.map(self.table, names))


class Warehouse:
    """Star schema of a lead export and a sale export under one folder.

    ``plan`` says how a table follows from the stored layers below it, ``table`` reads a stored table and writes it
    first if this object has not done so yet. ``refresh`` writes a new version of everything and makes it current at its
    end: until then this object and all readers of the folder stay on the version before, however it ends.
    """

    def __init__(self, spark: SparkSession, root: str, leads: DataFrame, sales: DataFrame):
        self.spark = spark
        self.store = TableStore(spark, root)
        self.exports = {"raw_leads": leads, "raw_sales": sales}
        self._layers = Layers(self.store, self.exports)

    @property
    def _stored(self) -> dict[str, DataFrame]:
        return self._layers.stored

    def plan(self, name: str) -> DataFrame:
        return self._layers.plan(name)

    def table(self, name: str) -> DataFrame:
        return self._layers.table(name)

    def refresh(self, allow_rejected: bool = False) -> None:
        """Write every table anew: exports, then dimensions side by side, then facts; then make them current.

        Stops after the exports if some records are malformed or without an id, or were not stored, unless
        ``allow_rejected``. What a failed refresh has written is removed.
        """
        layers = Layers(self.store, self.exports)
        try:
            layers.store_all(EXPORTS)
            if not allow_rejected:
                found = reconcile({name: (self.exports[name], layers.table(name)) for name in EXPORTS})
                bad = found.where("complete = 0 or malformed_rows > 0 or null_ids > 0").collect()
                if bad:
                    raise ValueError("exports with unusable records: " + "; ".join(str(row.asDict()) for row in bad))
            for group in (DIMENSIONS, ["fact_lead"], ["fact_sale"]):
                layers.store_all(group)
            self.store.commit(layers.folders)
        except BaseException:
            self.store.discard(layers.version)
            raise
        self._layers = layers

    def reconciliation(self) -> DataFrame:
        """Row counts of each export and of its stored copy, and the export's unusable records."""
        return reconcile({name: (self.exports[name], self.table(name)) for name in EXPORTS})


def open_tables(spark: SparkSession, root: str):
    """Reader of an already stored warehouse, for use in KPI, audit and check queries.

    It looks the current version up once and stays on it, through one later refresh at least.
    """
    store = TableStore(spark, root)
    folders = store.state()

    def table(name: str) -> DataFrame:
        if name == "stg_leads":
            return staging.stage_leads(table("raw_leads"))
        if name == "stg_sales":
            return staging.stage_sales(table("raw_sales"))
        if name not in folders:
            raise ValueError(f"{store.root}: no refresh has stored {name}")
        return store.read_folder(folders[name])

    return table

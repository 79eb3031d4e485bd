"""Intermediate tables in the shared folder, and small helpers on columns."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelmart.session import let_workers_import, shared_folder
from funnelmart.sources.tables import remove

BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1000  # texts that one Arrow batch may hold


class Scratch:
    """Parquet tables that cut lineage; what is read from them no longer depends on lost executors."""

    def __init__(self, spark: SparkSession):
        let_workers_import(spark)
        self.spark = spark
        self.root = f"{shared_folder(spark)}/llm/{uuid.uuid4().hex}"

    def path(self, label: str) -> str:
        return f"{self.root}/{label}-{uuid.uuid4().hex}"

    def keep(self, rows: DataFrame, label: str) -> DataFrame:
        """Write ``rows`` and return them as stored."""
        path = self.path(label)
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def close(self) -> None:
        """Remove every table; frames that read them can no longer be used."""
        remove(self.spark, self.root)


class Rounds:
    """State of an iteration: each new state is stored and the one before the last is removed."""

    def __init__(self, scratch: Scratch, label: str):
        self.scratch, self.label = scratch, label
        self.paths: list[str] = []

    def keep(self, rows: DataFrame) -> DataFrame:
        path = self.scratch.path(self.label)
        rows.write.parquet(path)
        self.paths.append(path)
        if len(self.paths) > 2:
            remove(self.scratch.spark, self.paths.pop(0))
        return self.scratch.spark.read.schema(rows.schema).parquet(path)


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Limit the rows of an Arrow batch, so that a batch of long texts fits in a Python worker."""
    let_workers_import(spark)
    if int(spark.conf.get(BATCH_SETTING)) not in range(1, rows + 1):
        spark.conf.set(BATCH_SETTING, str(rows))


def free_name(rows: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores added until no column of ``rows`` has that name."""
    taken = {c.lower() for c in rows.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def col(name: str) -> Column:
    """A column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str) -> Column:
    """A text column with null read as empty."""
    return F.coalesce(col(name).cast("string"), F.lit(""))


def broadcast_if(rows: DataFrame, most: int) -> DataFrame:
    """``rows``, marked for broadcast if counting them shows no more than ``most``."""
    return F.broadcast(rows) if rows.count() <= most else rows

"""A training corpus from raw documents, stage by stage.

Each stage takes the documents its predecessor kept and returns those it keeps itself, in their columns;
the last adds ``shard`` and ``slot``. Stages are meant to be written and read again one after another. What a stage
stored on the way belongs to its run: the run's next stage removes it, and ``Run.close`` the rest. Runs know nothing of each
other, so several may go on at once, one to a thread, and an older run's answer outlives the start of a newer one.

Null, empty and very long texts, null ids and sources, repeated rows and empty tables pass through every stage as its
operator's docstring says; other columns of the documents are carried along.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession

from funnelmart.llm.decontamination import without_overlaps
from funnelmart.llm.mixing import expand, mix
from funnelmart.llm.near_dedup import one_of_each
from funnelmart.llm.quality import of_quality
from funnelmart.llm.sharding import into_shards
from funnelmart.llm.store import Scratch

SHARDS = 16
_of_thread = threading.local()


class Run:
    """One pass over the stages, and the tables it keeps on the way."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.stage: Scratch | None = None
        self.kept: list[Scratch] = []

    def scratch(self) -> Scratch:
        """Tables of the stage that starts now; those of the stage before are removed."""
        if self.stage:
            self.stage.close()
        self.stage = Scratch(self.spark)
        return self.stage

    def documents(self, sf_dir: str) -> DataFrame:
        """The corpus made of all documents; every stage but the last is written and read again."""
        _of_thread.run = self
        docs = self.spark.read.parquet(f"{sf_dir}/documents.parquet")
        for name, stage in STAGES[:-1]:
            written = Scratch(self.spark)
            docs = written.keep(stage(self.spark, docs, sf_dir), name.replace(" ", "-"))
            self.kept.append(written)
            if len(self.kept) > 1:
                self.kept.pop(0).close()
        return STAGES[-1][1](self.spark, docs, sf_dir)

    def close(self) -> None:
        """Remove all tables; the run's answer can no longer be read."""
        for scratch in [*self.kept, *([self.stage] if self.stage else [])]:
            scratch.close()
        self.kept, self.stage = [], None


def current(spark: SparkSession) -> Run:
    """The run that this thread is in."""
    run = getattr(_of_thread, "run", None)
    if run is None or run.spark is not spark:
        run = _of_thread.run = Run(spark)
    return run


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject. A first stage outside of ``run`` starts a new run."""
    if current(spark).stage:
        _of_thread.run = Run(spark)
    current(spark).scratch()
    return of_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return one_of_each(docs, current(spark).scratch(), by_group=True)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    scratch = current(spark).scratch()
    return without_overlaps(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), scratch=scratch)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return expand(mix(docs, current(spark).scratch()), docs.columns)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in uniformly shuffled shards of equal size."""
    return into_shards(docs, SHARDS, current(spark).scratch())


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing sources", mixing),
    ("sharding", sharding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus made of all documents, by a run of its own."""
    return Run(spark).documents(sf_dir)


# The classifier and the sampled signatures are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None

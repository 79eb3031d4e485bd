"""First row of each group, and the latest version of each entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

EPOCH = "1970-01-01 00:00:00"  # any fixed moment; only differences from it are compared


def first_per_group(rows: DataFrame, group: list[Column], order: list[Column]) -> DataFrame:
    """The first row of each group. ``order`` must tell any two different rows of a group apart.

    Because only rank 1 is kept, Spark prunes each map task to one row per group before the shuffle; a
    group that holds very many rows therefore costs its reducer one row per map task.
    """
    rank = F.row_number().over(W.partitionBy(*group).orderBy(*order))
    return rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def latest_versions(versions: DataFrame, entity: str, moments: list[str]) -> DataFrame:
    """One row per ``entity``: the one with the greatest first non-null of ``moments``.

    Undated versions come last, and ties are settled by all other columns in ascending order, NULLs
    first, so two runs agree. This is the row numbered 1 in a window by entity, but taken as the
    smallest struct in that order: the aggregate sorts on the entity alone, and each map task sends one
    row per entity, however many versions it holds.
    """
    others = [c for c in versions.columns if c != entity]
    moment = F.coalesce(*[F.col(m) for m in moments])
    ranked = F.struct(
        moment.isNull().alias("_undated"), (F.lit(EPOCH).cast("timestamp_ntz") - moment).alias("_age"), *others
    )
    first = versions.groupBy(entity).agg(F.min(ranked).alias("_first"))
    return first.select(*[F.col(c if c == entity else f"_first.{c}") for c in versions.columns])

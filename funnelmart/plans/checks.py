"""Declared constraints of the star schema, as queries that count violations."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelmart.schemas import FACTS, STAR

Tables = Callable[[str], DataFrame]

# lookups made by id alone: dimension, id, name
ID_LOOKUPS = (
    ("dim_lead_type", "lead_type_id", "lead_type_name"),
    ("dim_property_type", "property_type_id", "property_type_name"),
)


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, parts)


def primary_keys(table: Tables) -> DataFrame:
    """Rows, NULL keys and repeated keys per table."""
    reports = []
    for name, declared in STAR.items():
        keys = table(name).groupBy(F.col(declared.key).alias("k")).agg(F.count("*").alias("n"))
        reports.append(
            keys.agg(
                F.lit(name).alias("table_name"),
                F.lit(declared.key).alias("key_column"),
                F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
                F.count(F.when(F.col("k").isNull(), 1)).alias("null_keys"),
                F.count(F.when(F.col("n") > 1, 1)).alias("duplicate_keys"),
            )
        )
    return union(reports)


def foreign_keys(table: Tables) -> DataFrame:
    """Fact rows per reference whose non-null key is missing from the referenced table.

    Each fact is read once: its key columns are unpivoted and counted per distinct key, so what is
    joined is distinct keys.
    """
    used = []
    for name, declared in FACTS.items():
        keys = table(name).select(*[F.col(c.name).cast("bigint") for c in declared.references])
        target = F.create_map(
            *[F.lit(x) for c in declared.references for x in (c.name, c.refers_to)]
        )
        used.append(
            keys.unpivot([], keys.columns, "column_name", "k")
            .groupBy("column_name", "k")
            .agg(F.count("*").alias("n"))
            .select(
                F.lit(name).alias("fact"), "column_name",
                target[F.col("column_name")].alias("refers_to"), "k", "n",
            )
        )
    referenced = {c.refers_to for declared in FACTS.values() for c in declared.references}
    known = union(
        [
            table(name).select(
                F.lit(name).alias("known_table"),
                F.col(STAR[name].key).cast("bigint").alias("known_key"),
            )
            for name in sorted(referenced)
        ]
    )
    orphan = F.col("k").isNotNull() & F.col("known_key").isNull()
    return (
        union(used)
        .join(
            known,
            (F.col("refers_to") == F.col("known_table")) & (F.col("k") == F.col("known_key")),
            "left",
        )
        .groupBy("fact", "column_name", "refers_to")
        .agg(F.sum(F.when(orphan, F.col("n")).otherwise(0)).alias("orphan_rows"))
    )


def unique_lookups(table: Tables) -> DataFrame:
    """Ids that stand for more than one name, which a join by id alone would multiply."""
    reports = []
    for name, id_, label in ID_LOOKUPS:
        ids = (
            table(name)
            .where(F.col(id_).isNotNull())
            .groupBy(id_)
            .agg(F.countDistinct(F.lower(label)).alias("names"))
        )
        reports.append(
            ids.agg(
                F.lit(name).alias("table_name"),
                F.count("*").alias("ids"),
                F.count(F.when(F.col("names") > 1, 1)).alias("ambiguous_ids"),
            )
        )
    return union(reports)


def not_null(table: Tables) -> DataFrame:
    """NULLs per required column; each table is read once."""
    reports = []
    for name, declared in STAR.items():
        required = [c.name for c in declared.columns if c.required]
        nulls = table(name).agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in required])
        reports.append(
            nulls.unpivot([], required, "column_name", "null_rows").select(
                F.lit(name).alias("table_name"), "column_name", "null_rows"
            )
        )
    return union(reports)


def text_lengths(table: Tables) -> DataFrame:
    """Declared and greatest length, and values that are too long, per limited text column."""
    reports = []
    for name, declared in STAR.items():
        limits = {c.name: c.length for c in declared.columns if c.length}
        if not limits:
            continue
        measures = [
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(limit).alias("declared_length"),
                F.max(F.length(c)).alias("longest"),
                F.count(F.when(F.length(c) > limit, 1)).alias("too_long"),
            ).alias(c)
            for c, limit in limits.items()
        ]
        found = table(name).agg(*measures)
        reports.append(
            found.select(F.inline(F.array(*limits))).select(
                F.lit(name).alias("table_name"),
                "column_name", "declared_length", "longest", "too_long",
            )
        )
    return union(reports)


CHECKS: dict[str, Callable[[Tables], DataFrame]] = {
    "check_pk": primary_keys,
    "check_fk": foreign_keys,
    "check_lookup_unique": unique_lookups,
    "check_not_null": not_null,
    "check_varchar_len": text_lengths,
}

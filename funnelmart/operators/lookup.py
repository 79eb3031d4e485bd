"""Left lookups of surrogate keys that stay balanced whatever the key distribution."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 << 20  # all dimensions together that are sent whole to every executor
HOT_SHARE = 1 / 200  # a key with more than this share of the rows is looked up apart
KEY_BYTES = 16  # match value and key of one fixed-width row
ROW = "_row"  # tells stored rows apart


@dataclass(frozen=True)
class Lookup:
    """Fetch ``key`` of ``source`` as ``alias`` where its ``match`` equals ``on`` of the looked-up rows.

    ``on`` and ``match`` are SQL expressions. A ``source`` with several keys per match value must be
    declared ``unique=False``; its smallest key is taken, so a lookup never multiplies rows.
    """

    alias: str
    source: DataFrame
    key: str
    match: str
    on: str
    unique: bool = True

    def pairs(self) -> DataFrame:
        pairs = self.source.select(F.expr(self.match).alias("_match"), F.col(self.key).alias("_key"))
        pairs = pairs.where("_match is not null")
        return pairs if self.unique else pairs.groupBy("_match").agg(F.min("_key").alias("_key"))


def attach_keys(
    rows: DataFrame, lookups: list[Lookup], spread_by: str, profile: DataFrame | None = None,
    broadcast_bytes: int = BROADCAST_BYTES, store: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``rows`` with one key column per lookup; NULL where nothing matches.

    Planning runs jobs: every source is measured first. The smallest are broadcast as long as they come to
    no more than ``broadcast_bytes`` together. For the others the hot match values, at most
    1 / HOT_SHARE of them, are found in ``profile`` (rows distributed like ``rows``, by default ``rows``
    itself) and looked up in a broadcast of just those members; all other rows meet the source in a
    shuffle join. Rows that need no partner there, hot or NULL, are spread by ``spread_by`` instead of
    meeting in the task of the NULL key.

    With ``store``, which writes rows and reads them back, rows that need such joins are computed once. Only their
    match values travel through the joins, and the keys found come back to the whole rows at the end.
    """
    large = beyond(lookups, measure(lookups), broadcast_bytes)
    if large and store is not None:
        rows = store(rows.withColumn(ROW, F.monotonically_increasing_id()))
        narrow = rows.select(ROW, *[F.expr(x.on).alias(f"_on_{x.alias}") for x in large])
        sought = [replace(x, on=f"`_on_{x.alias}`") for x in large]
        hot = hot_values(narrow, sought)
        for lookup in sought:
            narrow = shuffle_lookup(narrow, lookup, hot[lookup.alias], ROW)
        rows = rows.join(narrow.select(ROW, *[x.alias for x in large]), ROW).drop(ROW)
    elif large:
        hot = hot_values(rows if profile is None else profile, large)
        for lookup in large:
            rows = shuffle_lookup(rows, lookup, hot[lookup.alias], spread_by)
    for lookup in lookups:
        if lookup not in large:
            rows = broadcast_lookup(rows, lookup, lookup.pairs())
    return rows


def beyond(lookups: list[Lookup], sizes: dict[str, int], limit: int) -> list[Lookup]:
    """The lookups that no longer fit when the smaller ones are broadcast first."""
    total, large = 0, []
    for lookup in sorted(lookups, key=lambda x: sizes[x.alias]):
        total += sizes[lookup.alias]
        if total > limit:
            large.append(lookup)
    return large


def measure(lookups: list[Lookup]) -> dict[str, int]:
    """Bytes of match values and keys per lookup, found in one job."""
    totals = []
    for lookup in lookups:
        value = lookup.source.select(F.expr(lookup.match).alias("_match"))
        text = isinstance(value.schema["_match"].dataType, T.StringType)
        width = F.octet_length("_match") if text else F.lit(0)
        totals.append(
            value.agg(
                F.lit(lookup.alias).alias("alias"),
                F.coalesce(F.sum(F.coalesce(width, F.lit(0)) + KEY_BYTES), F.lit(0)).alias("bytes"),
            )
        )
    return {r["alias"]: r["bytes"] for r in reduce(DataFrame.unionAll, totals).collect()}


def hot_values(profile: DataFrame, lookups: list[Lookup]) -> dict[str, list]:
    """Match values that may hold more than HOT_SHARE of the rows, none of them missed.

    ``freqItems`` is a bounded one-pass summary: it may name too many values, never too few, and at
    most 1 / HOT_SHARE per column.
    """
    columns = profile.select(*[F.expr(x.on).alias(x.alias) for x in lookups])
    found = columns.stat.freqItems([x.alias for x in lookups], HOT_SHARE).first()
    return {x.alias: [v for v in found[f"{x.alias}_freqItems"] if v is not None] for x in lookups}


def broadcast_lookup(rows: DataFrame, lookup: Lookup, pairs: DataFrame) -> DataFrame:
    pairs = pairs.withColumnRenamed("_key", lookup.alias)
    return rows.join(F.broadcast(pairs), F.expr(lookup.on) == F.col("_match"), "left").drop("_match")


def shuffle_lookup(rows: DataFrame, lookup: Lookup, hot: list, spread_by: str) -> DataFrame:
    pairs = lookup.pairs()
    wanted = F.expr(lookup.on)
    if hot:
        members = pairs.where(F.col("_match").isin(hot)).withColumnRenamed("_key", "_hot_key")
        rows = rows.join(F.broadcast(members), wanted == F.col("_match"), "left").drop("_match")
        wanted = F.when(F.col("_hot_key").isNull(), wanted)
    else:
        rows = rows.withColumn("_hot_key", F.lit(None).cast(pairs.schema["_key"].dataType))

    type_ = pairs.schema["_match"].dataType
    rows = rows.withColumn("_wanted", wanted.cast(type_)).withColumn(
        "_bucket",
        F.when(F.col("_wanted").isNull(), F.xxhash64(spread_by)).otherwise(F.xxhash64("_wanted")),
    )
    pairs = pairs.withColumn("_match_bucket", F.xxhash64("_match"))
    joined = rows.join(
        pairs,
        (F.col("_wanted") == F.col("_match")) & (F.col("_bucket") == F.col("_match_bucket")),
        "left",
    )
    return joined.withColumn(lookup.alias, F.coalesce("_hot_key", "_key")).drop(
        "_hot_key", "_key", "_wanted", "_bucket", "_match", "_match_bucket"
    )

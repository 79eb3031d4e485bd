"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

Rows lie in blocks. How many rows each block sends to each shard is drawn first, from the distribution
that a uniform shuffle would give (multivariate hypergeometric, with block sizes and shard sizes as
margins). Every block then permutes its own rows and cuts the permuted sequence by its row of the matrix,
rows are exchanged, and every shard permutes what it received. Each arrangement of the rows is equally
likely, shard sizes are exact, and no task sorts more than a block or a slice of a shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from funnelmart.llm.store import Scratch, col, free_name, text_of

PLACE_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits
GROUP_BLOCKS = 512  # blocks whose rows of the matrix are drawn in one task
SLICE_ROWS = 4096  # expected rows of a slice of a shard
EXACT_ROWS = 10**9  # populations up to which NumPy draws directly
MASK = (1 << 63) - 1


def shard_sizes(rows: int, shards: int) -> list[int]:
    """Sizes that differ by one at most; the first shards take the rest."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def hypergeometric(rng: np.random.Generator, good: int, bad: int, taken: int) -> int:
    """How many of ``taken`` rows, drawn without replacement, are among the ``good`` ones."""
    if good + bad < EXACT_ROWS:
        return int(rng.hypergeometric(good, bad, taken))
    # by inversion over all counts within 12 standard deviations; what lies outside is below 1e-30
    share = good / (good + bad)
    spread = 10 + 12 * int(np.sqrt(taken * share * (1 - share)))
    middle = int(taken * share)
    low, high = max(0, taken - bad, middle - spread), min(taken, good, middle + spread)
    k = np.arange(low, high, dtype=np.float64)
    steps = np.log(good - k) + np.log(taken - k) - np.log(k + 1) - np.log(bad - taken + k + 1)
    logs = np.concatenate(([0.0], np.cumsum(steps)))
    running = np.cumsum(np.exp(logs - logs.max()))
    return low + int(np.searchsorted(running, rng.random() * running[-1]))


def draw(seed: int, name: int, have: list[int], wanted: list[int]) -> list[list[int]]:
    """A random matrix of counts whose rows sum to ``have`` and whose columns sum to ``wanted``."""
    rng = np.random.default_rng([seed, name])
    left, matrix = list(wanted), []
    for rows in have:
        rest, todo, counts = sum(left), rows, []
        for size in left:
            rest -= size
            counts.append(hypergeometric(rng, size, rest, todo) if todo and size and rest else min(todo, size))
            todo -= counts[-1]
        left = [a - b for a, b in zip(left, counts)]
        matrix.append(counts)
    return matrix


def matrix_of(counts: DataFrame, sizes: list[int], seed: int) -> DataFrame:
    """The communication matrix: ``block`` and ``ends``, the running counts by shard.

    ``counts`` has ``block`` and ``n``. Blocks are gathered in groups of ``GROUP_BLOCKS``; the driver draws
    one row per group, tasks draw the rows of the blocks within a group.
    """
    spark = counts.sparkSession
    grouped = counts.withColumn("grp", F.expr(f"block div {GROUP_BLOCKS}"))
    totals = grouped.groupBy("grp").agg(F.sum("n").alias("n")).orderBy("grp").collect()
    shares = draw(seed, 0, [r["n"] for r in totals], sizes)
    lots = spark.createDataFrame(
        [(r["grp"], share) for r, share in zip(totals, shares)], "grp bigint, share array<bigint>"
    )

    def rows_of_group(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        drawn = draw(seed, 1 + int(pdf["grp"].iloc[0]), pdf["n"].tolist(), pdf["share"].iloc[0].tolist())
        return pd.DataFrame({"block": pdf["block"], "ends": [np.cumsum(x).tolist() for x in drawn]})

    return (
        grouped.join(lots, "grp").groupBy("grp").applyInPandas(rows_of_group, "block bigint, ends array<bigint>")
    )


def into_shards(rows: DataFrame, shards: int, scratch: Scratch, seed: int = 0) -> DataFrame:
    """``rows`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (0 to the shard's size - 1).

    Every arrangement is equally likely over seeds; shard sizes differ by one at most. Rows are stored
    once, with their place, so a block is what one task wrote: rows that are equal, null or repeated are
    told apart by place alone, and no value can make a block large. The stored places also make a retried
    task give the same answer. Empty input gives no rows. Input columns named ``shard`` or ``slot`` are
    replaced.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    kept = [c for c in rows.columns if c.lower() not in ("shard", "slot")]
    place = free_name(rows, "_place")
    stored = scratch.keep(
        rows.select(*map(col, kept)).withColumn(place, F.monotonically_increasing_id()), "placed"
    )
    places = stored.select(F.col(place).alias("place"), F.shiftright(place, PLACE_BITS).alias("block"))
    counts = scratch.keep(places.groupBy("block").agg(F.count("*").alias("n")), "blocks")
    total = counts.agg(F.sum("n")).first()[0] or 0
    matrix = matrix_of(counts, shard_sizes(total, shards), seed)

    first = W.partitionBy("block").orderBy(F.xxhash64(F.lit(seed), "place"), "place")
    sent = (
        places.withColumn("rank", F.row_number().over(first) - 1)
        .join(matrix, "block")
        .select("place", F.expr("size(filter(ends, e -> e <= rank))").alias("shard"))
    )

    slices = max(1, total // shards // SLICE_ROWS)
    second = F.xxhash64(F.lit(seed), F.lit("second"), "place").bitwiseAND(F.lit(MASK))
    sent = scratch.keep(
        sent.withColumn("_key", second).withColumn("_slice", F.expr(f"_key div {MASK // slices + 1}")), "sent"
    )
    before = W.partitionBy("shard").orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        sent.groupBy("shard", "_slice").agg(F.count("*").alias("n"))
        .select("shard", "_slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    )
    within = W.partitionBy("shard", "_slice").orderBy("_key", "place")
    slots = (
        sent.withColumn("_rank", F.row_number().over(within) - 1)
        .join(starts, ["shard", "_slice"])
        .select("place", "shard", (F.col("_start") + F.col("_rank")).cast("bigint").alias("slot"))
    )
    return stored.join(slots.withColumnRenamed("place", place), place).drop(place)


def write_shards(placed: DataFrame, path: str) -> None:
    """Write one folder per shard; its files, read in order of name, hold the rows by slot."""
    ordered = placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.mode("overwrite").partitionBy("shard").parquet(path)


def op4_hypergeometric_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in shards 0 to 15, by law ``rows``."""
    documents = spark.read.parquet(f"{folder}/documents.parquet").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(text_of("text").cast("binary")).alias("text_crc32"),
    )
    return into_shards(documents, 16, Scratch(spark)).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )

"""Dense surrogate keys without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def with_dense_key(members: DataFrame, key: str, order: list[str], folder: str) -> DataFrame:
    """Number distinct ``members`` 1..n in the order of ``order`` (NULLs first), as column ``key``.

    The members are range-partitioned, sorted within partitions and written to ``folder`` together with
    their place (partition, row). The stored places no longer change, however often they are read or
    recomputed, so the key is the number of rows in earlier partitions plus the row within its own. Only
    the per-partition counts, one row per partition, pass through one task and are broadcast.
    """
    ordering = [F.col(c).asc_nulls_first() for c in order]
    placed = (
        members.repartitionByRange(*ordering)
        .sortWithinPartitions(*ordering)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    placed.write.mode("overwrite").parquet(folder)

    spark = members.sparkSession
    stored = spark.read.schema(placed.schema).parquet(folder).withColumn(
        "_part", F.shiftright("_place", ROW_BITS)
    )
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        stored.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    row = F.col("_place").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return stored.join(F.broadcast(offsets), "_part").select(
        (F.col("_offset") + row + 1).alias(key), *[F.col(c) for c in members.columns]
    )

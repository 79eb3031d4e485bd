"""Records of large CSV files whose texts hold line breaks, read by many tasks per file.

A file is read line by line in blocks, as any text file is. A line break belongs to a text if an odd number of quotes
stands before it in the file; that number is known from the blocks before and the lines before in its own block, so each
needs a count per block and running counts within blocks. First, quotes alone are counted; a row per block says
whether it starts inside a text, and where the record began that it continues. Then lines are read
with that. Lines that are records of their own, nearly all, are parsed as they are; the others are joined first.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from funnelmart.session import shared_folder
from funnelmart.sources.tables import file_system

BROADCAST_BLOCKS = 200_000  # rows about blocks that are sent to every task
QUOTE = '"'


def largest_file(spark: SparkSession, path: str) -> int:
    """Bytes of the largest file of an export."""
    target, files = file_system(spark, path)
    largest = 0
    for found in files.globStatus(target) or ():
        inside = files.listFiles(found.getPath(), True)
        while inside.hasNext():
            largest = max(largest, inside.next().getLen())
    return largest


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their ``file``, the start of their ``block``, their ``place`` in it, and the quotes ``before`` them there."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), (F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))).alias("quotes"),
    )
    in_block = W.partitionBy("file", "block").orderBy("line")
    return lines.select(
        "*", F.row_number().over(in_block).alias("place"),
        F.coalesce(F.sum("quotes").over(in_block.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"),
    )


def blocks_of(spark: SparkSession, path: str) -> DataFrame:
    """Per block the quotes in its file ``ahead`` of it, and the last start of a record before it, ``from_block`` and ``from_place``.

    Where a record starts depends on whether the block starts inside a text, so the last start is taken for both
    cases before that is known. Stored, as each line asks for its block. A file whose quotes don't balance is an error.
    """
    starts = [F.max(F.when(F.col("before") % 2 == parity, F.col("place"))).alias(f"last_{parity}") for parity in (0, 1)]
    counted = lines_of(spark, path).drop("value").groupBy("file", "block").agg(F.sum("quotes").alias("quotes"), *starts)
    so_far = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    known = counted.withColumn("ahead", F.coalesce(F.sum("quotes").over(so_far), F.lit(0)))
    last = F.when(F.col("ahead") % 2 == 0, F.col("last_0")).otherwise(F.col("last_1"))
    start = F.when(last.isNotNull(), F.struct("block", last.alias("place")))
    carried = F.last(start, ignorenulls=True).over(so_far)
    folder = f"{shared_folder(spark)}/csv-blocks-{uuid.uuid4().hex}"
    known.select(
        "file", "block", "ahead", "quotes", carried["block"].alias("from_block"), carried["place"].alias("from_place")
    ).write.parquet(folder)
    stored = spark.read.parquet(folder)
    odd = stored.groupBy("file").agg((F.sum("quotes") % 2).alias("odd")).where("odd = 1").select("file").first()
    if odd:
        raise ValueError(f"{odd['file']}: quotes don't balance, so texts with line breaks can't be told from records")
    return stored.drop("quotes")


def csv_records(spark: SparkSession, path: str, names: list[str], raw: str) -> DataFrame:
    """Records of CSV files with a header line as text columns ``names``; ``raw`` has a record of a wrong length.

    Lines end with or without a carriage return; a break within a text is a line feed in either case.
    """
    blocks = blocks_of(spark, path)
    if blocks.count() <= BROADCAST_BLOCKS:
        blocks = F.broadcast(blocks)
    lines = lines_of(spark, path).join(blocks, ["file", "block"]).withColumn("value", F.regexp_replace("value", r"\r\z", ""))
    odd = F.col("quotes") % 2
    starts = (F.col("ahead") + F.col("before")) % 2 == 0
    so_far = W.partitionBy("file", "block").orderBy("line").rowsBetween(W.unboundedPreceding, W.currentRow)
    lines = lines.withColumn("start", F.last(F.when(starts, F.col("place")), ignorenulls=True).over(so_far))
    lines = lines.withColumn("single", starts & (odd == 0)).withColumn(
        "from_block", F.when(F.col("start").isNull(), F.col("from_block")).otherwise(F.col("block"))
    ).withColumn("from_place", F.coalesce("start", "from_place"))
    alone = lines.where("single").select("from_block", "from_place", "value")
    parts = F.array_sort(F.collect_list(F.struct("block", "place", "value")))
    joined = lines.where("not single").groupBy("file", "from_block", "from_place").agg(
        F.array_join(F.transform(parts, lambda line: line["value"]), "\n").alias("value")
    ).drop("file")
    records = alone.unionByName(joined).where("value <> ''")

    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*names, raw]])
    options = {"escape": QUOTE, "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": raw}
    parsed = records.select("*", F.from_csv("value", schema.simpleString(), options).alias("record"))
    found = F.concat_ws("\x00", *[F.lower(F.trim(F.coalesce(parsed["record"][name], F.lit("")))) for name in names])
    is_header = (F.col("from_block") == 0) & (F.col("from_place") == 1)
    same = found == F.lit("\x00".join(name.lower().strip() for name in names))
    wrong = F.raise_error(F.concat(F.lit(f"{path}: a file has another header: "), F.col("value"))).cast("boolean")
    return parsed.where(F.when(~is_header, True).otherwise(F.when(same, False).otherwise(wrong))).select("record.*")

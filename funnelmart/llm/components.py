"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelmart.llm.store import Rounds, Scratch

MOST_ROUNDS = 60


def stars(links: DataFrame) -> bool:
    """Whether no node has two smaller neighbours, or a smaller and a larger one."""
    one, none = F.lit(1), F.lit(0)
    ends = links.select(F.inline(F.array(
        F.struct("u", one.alias("as_u"), none.alias("as_v")), F.struct(F.col("v").alias("u"), none.alias("as_u"), one.alias("as_v")),
    )))
    counted = ends.groupBy("u").agg(F.sum("as_u").alias("as_u"), F.max("as_v").alias("as_v"))
    return counted.where("as_u > 1 or (as_u = 1 and as_v = 1)").isEmpty()


def both_ways(links: DataFrame) -> DataFrame:
    """Every link (u, v) in either direction, in one pass."""
    return links.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``node`` and ``component``, the smallest node it reaches, for every node of ``links`` (a, b).

    Alternating stars: every node first links its larger neighbours, then its smaller ones, to the
    smallest node it knows, until all links are stars: every node but the centres has one link, to a
    centre. Neighbourhoods are never collected: a round takes a minimum per node, which is added up before
    the shuffle, and joins it back. The rounds needed grow with the logarithm of the longest path.
    """
    rounds = Rounds(scratch, "links")
    links = links.where("a is not null and b is not null and a <> b")
    state = rounds.keep(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    for _ in range(MOST_ROUNDS):
        if stars(state):
            break
        both = both_ways(state)
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # every link gives one row here at most, so equal rows can wait for the end of the round
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u")
        pairs = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))
        state = rounds.keep(small.select(F.inline(pairs)).where("u <> v").distinct())
    else:
        raise RuntimeError(f"links did not become stars in {MOST_ROUNDS} rounds")
    nodes = state.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionAll(roots)

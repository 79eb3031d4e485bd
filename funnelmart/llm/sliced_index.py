"""Exact top-k by inner product over a bit-sliced index.

Components are quantised to integers, and rows are cut into blocks by position. A block's index holds, per attribute,
one bitmap per binary digit of the attribute less its smallest value in the block: bit r of slice b says whether row r
has that digit. The inner product with a query is then a sum of slices, shifted by the digits of the query's
components, and bitmaps are added for all rows at once by carry-save adders: three bitmaps of one weight become one of
that weight and one of twice the weight. The slices of the sum are walked from the most significant one down: rows
that have the digit are ahead of all others that are still in question, until k rows are settled. Rows that no slice
tells apart are the boundary; they are taken by id. Nothing is estimated, so recall is 1.

A block's answer is at most k rows per query, so what is shuffled after the search does not grow with a block's rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from funnelmart.llm.store import Scratch, broadcast_if, col
from funnelmart.operators.dense_key import with_dense_key

SCALE = 256
TOP = 5
QUERY_EVERY = 50
BLOCK_ROWS = 1 << 14  # rows of a block
BLOCK_VALUES = 1 << 21  # rows times attributes of a block; wider vectors have shorter blocks
QUERY_ROWS = 256  # queries that one task holds at a time
LIMIT = 1 << 53  # quantised components beyond it count as it
LOW_BITS = 62  # a score is kept as two longs, so its order is exact however large it is
BROADCAST_ROWS = 200_000
U64 = np.uint64
ALL = U64(0xFFFFFFFFFFFFFFFF)

INDEX = "size int, block bigint, n int, positions array<bigint>, ids array<bigint>, low array<bigint>, digits int, slices binary"
ANSWER = "query bigint, query_id bigint, vec_id bigint, position bigint, high bigint, low bigint"


def quantised(vectors: DataFrame, identity: str, vector: str, scale: float) -> DataFrame:
    """``vec_id``, ``q`` and ``size``: floors of the scaled components of each usable vector."""
    component = F.transform(col(vector), lambda x: x.cast("double"))
    usable = vectors.select(col(identity).cast("bigint").alias("vec_id"), component.alias("v")).where("v is not null").where(
        ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    )
    limit = F.lit(float(LIMIT))
    floor = F.transform("v", lambda x: F.floor(F.greatest(-limit, F.least(limit, x * F.lit(float(scale))))).cast("bigint"))
    return usable.select("vec_id", F.size("v").alias("size"), floor.alias("q"))


def block_rows(size: int) -> int:
    """Rows of a block of vectors of this many components; a whole number of 64-bit words."""
    return max(64, min(BLOCK_ROWS, BLOCK_VALUES // max(1, size)) // 64 * 64)


def pack(bits: np.ndarray) -> np.ndarray:
    """Bitmaps of the last axis as 64-bit words; bit r of a bitmap is bit r % 64 of word r // 64."""
    short = -bits.shape[-1] % 64
    if short:
        bits = np.concatenate([bits, np.zeros((*bits.shape[:-1], short), dtype=bits.dtype)], axis=-1)
    return np.packbits(np.ascontiguousarray(bits), axis=-1, bitorder="little").view(U64)


def slice_block(q: np.ndarray) -> tuple[np.ndarray, int, np.ndarray]:
    """Smallest values by attribute, digits of the widest attribute, and slices (attribute, digit, word) of rows ``q``."""
    n, size = q.shape
    low = q.min(axis=0) if size else np.empty(0, dtype=np.int64)
    above = (q - low).astype(U64)
    digits = max(1, int(above.max(initial=0)).bit_length())
    slices = np.empty((size, digits, -(-n // 64)), dtype=U64)
    for digit in range(digits):
        slices[:, digit] = pack(((above >> U64(digit)) & U64(1)).astype(np.uint8).T)
    return low, digits, slices


def signed_digits(value: int) -> list[tuple[int, int]]:
    """``value`` as a sum of sign * 2**shift in which no two shifts are next to each other."""
    out, shift = [], 0
    while value:
        if value & 1:
            sign = 2 - (value & 3)
            out.append((sign, shift))
            value -= sign
        value >>= 1
        shift += 1
    return out


def add_bitmaps(columns: dict[int, list[np.ndarray]], words: int) -> list[np.ndarray]:
    """Slices of the sum, least significant first; ``columns`` has by weight what to add, as rows of bitmaps."""
    out: list[np.ndarray] = []
    carried: list[np.ndarray] = []
    weight = 0
    while weight <= max(columns, default=-1) or carried:
        waiting = carried + columns.get(weight, [])
        carried = []
        rows = np.concatenate(waiting) if waiting else np.zeros((1, words), dtype=U64)
        while len(rows) > 1:
            if len(rows) == 2:
                carried.append(rows[:1] & rows[1:])
                rows = rows[:1] ^ rows[1:]
                break
            third = len(rows) // 3
            a, b, c = rows[:third], rows[third: 2 * third], rows[2 * third: 3 * third]
            half = a ^ b
            carried.append((a & b) | (half & c))
            rows = np.concatenate([half ^ c, rows[3 * third:]])
        out.append(rows[0])
        weight += 1
    return out


def weighted_sum(slices: np.ndarray, low: list[int], query: list[int]) -> tuple[list[np.ndarray], int]:
    """Slices of a non-negative number per row, and what to add to it to have the row's inner product with ``query``.

    An attribute with a negative digit of the query is added by its complement, so nothing is ever subtracted.
    """
    size, digits, words = slices.shape
    most = (1 << digits) - 1
    plus: dict[int, list[int]] = {}
    minus: dict[int, list[int]] = {}
    constant = 0
    for attribute, value in enumerate(query):
        constant += value * low[attribute]
        for sign, shift in signed_digits(value):
            (plus if sign > 0 else minus).setdefault(shift, []).append(attribute)
            if sign < 0:
                constant -= most << shift
    columns: dict[int, list[np.ndarray]] = {}
    for taken, flip in ((plus, False), (minus, True)):
        for shift, attributes in taken.items():
            for digit in range(digits):
                rows = slices[attributes, digit]
                columns.setdefault(shift + digit, []).append(~rows if flip else rows)
    return add_bitmaps(columns, words), constant


def ones(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def first_rows(bitmap: np.ndarray, most: int) -> list[int]:
    """The lowest ``most`` positions whose bit is set."""
    out: list[int] = []
    for word in np.flatnonzero(bitmap).tolist():
        bits = int(bitmap[word])
        while bits and len(out) < most:
            out.append(word * 64 + (bits & -bits).bit_length() - 1)
            bits &= bits - 1
        if len(out) == most:
            break
    return out


def top_rows(total: list[np.ndarray], allowed: np.ndarray, k: int) -> list[int]:
    """Positions of the ``k`` largest numbers among the rows ``allowed``; of equal ones at the boundary the lowest."""
    settled, asked = np.zeros_like(allowed), allowed
    have, left = 0, ones(allowed)
    if left <= k:
        return first_rows(allowed, left)
    for digit in reversed(total):
        ahead = asked & digit
        n = ones(ahead)
        if have + n > k:
            asked = ahead
        else:
            settled, have, asked = settled | ahead, have + n, asked & ~digit
            if have == k:
                return first_rows(settled, k)
    return first_rows(settled, have) + first_rows(asked, k - have)


def number_at(total: list[np.ndarray], row: int) -> int:
    word, bit = divmod(row, 64)
    return sum(((int(digit[word]) >> bit) & 1) << weight for weight, digit in enumerate(total))


def search_block(index: pd.Series, queries: pd.DataFrame, k: int) -> list[tuple]:
    """The best ``k`` rows of a block for each query, as rows of ANSWER."""
    n, size, digits = int(index["n"]), int(index["size"]), int(index["digits"])
    slices = np.frombuffer(index["slices"], dtype=U64).reshape(size, digits, -(-n // 64))
    every = pack(np.ones((1, n), dtype=np.uint8))[0]
    ids, positions = list(index["ids"]), np.asarray(index["positions"])
    low = [int(x) for x in index["low"]]
    out = []
    for query, query_id, vector in zip(queries["position"], queries["vec_id"], queries["q"]):
        allowed = every
        own = int(np.searchsorted(positions, query))
        if own < n and positions[own] == query:
            allowed = every.copy()
            allowed[own // 64] &= ALL ^ (U64(1) << U64(own % 64))
        total, constant = weighted_sum(slices, low, [int(x) for x in vector])
        for row in top_rows(total, allowed, k):
            high, rest = divmod(number_at(total, row) + constant, 1 << LOW_BITS)
            out.append((query, query_id, None if pd.isna(ids[row]) else int(ids[row]), int(positions[row]), high, rest))
    return out


def build_index(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per block of ``rows`` (position, vec_id, size, q): its bitmaps, and which rows they stand for.

    Positions order rows by size of the vector and id, so a block's rows of equal score are in the order of ids.
    """
    first = scratch.keep(rows.groupBy("size").agg(F.min("position").alias("first")), "first")

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("position")
        q = np.array(pdf["q"].tolist(), dtype=np.int64).reshape(len(pdf), int(pdf["size"].iloc[0]))
        low, digits, slices = slice_block(q)
        return pd.DataFrame({
            "size": [q.shape[1]], "block": [pdf["block"].iloc[0]], "n": [len(pdf)], "positions": [pdf["position"].tolist()],
            "ids": [[None if pd.isna(x) else int(x) for x in pdf["vec_id"]]], "low": [low.tolist()], "digits": [digits],
            "slices": [slices.tobytes()],
        })

    in_blocks = rows.join(broadcast_if(first, BROADCAST_ROWS), "size").withColumn("block", block_of("position"))
    return scratch.keep(in_blocks.groupBy("size", "block").applyInPandas(build, INDEX), "index")


def block_of(position: str) -> F.Column:
    """The block of a row: its place among the vectors of its size, by the rows that a block of that size has."""
    words = F.floor(F.least(F.lit(BLOCK_ROWS), F.lit(BLOCK_VALUES) / F.greatest(F.lit(1), F.col("size"))) / 64)
    return F.floor((F.col(position) - F.col("first")) / F.greatest(F.lit(64), words * 64)).cast("bigint")


def top_k(vectors: DataFrame, scratch: Scratch, is_query: F.Column, k: int = TOP, identity: str = "vec_id",
          vector: str = "embedding", scale: float = SCALE) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score``: per query its ``k`` rows of the highest inner product.

    Components count as floor(scale * x), beyond 2**53 as that. ``is_query`` tells by ``vec_id`` which rows ask. Every
    row but the query's own answers; equal scores go by the smaller id, null ids last. Vectors that are null or hold
    null, NaN or infinite components take no part; vectors of different lengths don't meet, so one of a length of its own
    has no answer; empty ones score 0 with each other. A repeated row is a row of its own, asks for itself and is an answer to
    its twin. Rows with fewer than ``k`` others get all of them. A score beyond 64 bits is ranked exactly and shown as
    the nearest long. Empty input gives no rows; other columns are ignored.
    """
    rows = quantised(vectors, identity, vector, scale).withColumn("nameless", F.col("vec_id").isNull())
    keyed = with_dense_key(rows, "position", ["size", "nameless", "vec_id", "q"], scratch.path("rows")).drop("nameless")
    index = build_index(keyed, scratch)
    asked = keyed.where(is_query & F.col("vec_id").isNotNull())
    sizes = broadcast_if(index.groupBy("size").agg(F.max("block").alias("last")), BROADCAST_ROWS)
    # queries are dealt to groups by a hash, as many groups as hold QUERY_ROWS each on average
    groups = asked.groupBy("size").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("groups"))
    groups = broadcast_if(scratch.keep(groups, "groups"), BROADCAST_ROWS)
    grouped = F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part")
    blocks = index.join(groups, "size").select("*", grouped).drop("groups")
    asked = asked.join(groups, "size").join(sizes, "size").select(
        "size", F.explode(F.sequence(F.lit(0), "last")).alias("block"),
        F.pmod(F.xxhash64("position"), F.col("groups")).cast("int").alias("part"), "position", "vec_id", "q",
    )

    def search(block: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = [row for _, b in block.iterrows() for row in search_block(b, queries, k)]
        return pd.DataFrame(found, columns=["query", "query_id", "vec_id", "position", "high", "low"]).astype({"vec_id": "Int64"})

    keys = ["size", "block", "part"]
    found = blocks.groupBy(keys).cogroup(asked.groupBy(keys)).applyInPandas(search, ANSWER)
    order = [F.desc("high"), F.desc("low"), F.asc_nulls_last("vec_id"), F.asc("position")]
    ranked = found.withColumn("rank", F.row_number().over(W.partitionBy("query").orderBy(*order))).where(F.col("rank") <= k)
    half = 1 << (63 - LOW_BITS)
    score = (
        F.when(F.col("high") >= half, F.lit((1 << 63) - 1)).when(F.col("high") < -half, F.lit(-(1 << 63)))
        .otherwise(F.shiftleft("high", LOW_BITS).bitwiseOR(F.col("low")))
    )
    return ranked.select("query_id", "rank", "vec_id", score.cast("bigint").alias("score"))


def op12_bit_sliced_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest vectors of every vector whose id is divisible by 50, among all vectors."""
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding")
    return top_k(vectors, Scratch(spark), F.col("vec_id") % QUERY_EVERY == 0)


OP12_SQL = """
with q as (
    select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select a.vec_id as query_id, b.vec_id, list_inner_product(a.v, b.v)::bigint as score
    from q a join q b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id
), ranked as (
    select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored
)
select query_id, rank::int as rank, vec_id, score from ranked where rank <= 5
"""

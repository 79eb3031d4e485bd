"""Exact top-k over a bit-sliced index, against integer arithmetic on all pairs."""

from __future__ import annotations

import math
import random

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from funnelmart.llm import sliced_index as si

SCHEMA = "vec_id bigint, embedding array<double>, label int, position string, size int, q double, block int"
LONGEST = (1 << 63) - 1


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2, 0.5, 3) for i, v in rows], SCHEMA).repartition(3)


def brute(rows, k, every=50, scale=256):
    usable = []
    for n, (i, v) in enumerate(rows):
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable.append((n, i, [math.floor(max(-2.0**53, min(2.0**53, x * scale))) for x in v]))
    out = []
    for n, i, v in usable:
        if i is None or i % every:
            continue
        scored = [
            (-sum(a * b for a, b in zip(v, w)), j is None, j or 0, j) for m, j, w in usable if m != n and len(w) == len(v)
        ]
        for rank, (score, _, _, j) in enumerate(sorted(scored, key=lambda r: r[:3])[:k], 1):
            out.append((i, rank, j, max(-LONGEST - 1, min(LONGEST, -score))))
    return out


def answer(spark, scratch, rows, k=5):
    found = si.top_k(table(spark, rows), scratch, F.col("vec_id") % 50 == 0, k)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return [tuple(r) for r in found.collect()]


def same(a, b):
    return sorted(a, key=repr) == sorted(b, key=repr)


def test_agrees_with_all_pairs_over_blocks(spark, scratch, monkeypatch):
    monkeypatch.setattr(si, "BLOCK_ROWS", 64)
    monkeypatch.setattr(si, "QUERY_ROWS", 3)
    rng = random.Random(5)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, rng.gauss(0, 0.3)]) for _ in range(6)]) for i in range(500)]
    rows += [(500 + i, rows[7][1]) for i in range(200)]  # equal scores over several blocks
    assert same(answer(spark, scratch, rows), brute(rows, 5))


def test_odd_vectors(spark, scratch):
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (50, [-1.0, 0.5]), (3, [1.0, 2.0]), (None, [1.0, 2.0]), (100, None), (150, [1.0, None]),
        (200, [float("nan"), 1.0]), (250, [float("inf"), 1.0]), (300, []), (7, []), (350, [1.0, 2.0, 3.0]), (400, [1e300, -1e300]),
        (450, [-1e300, 1e300]), (500, [0.0, -0.0]), (550, [0.003, -0.003]), (-50, [2.0, 2.0]),
    ]
    assert same(answer(spark, scratch, rows, 4), brute(rows, 4))
    assert same(answer(spark, scratch, rows, 50), brute(rows, 50))


def test_empty_table(spark, scratch):
    assert answer(spark, scratch, []) == []
    assert answer(spark, scratch, [(50, [1.0])]) == []


def test_registered_query_agrees_with_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{folder}/embeddings.parquet'")
    found = [tuple(r) for r in si.op12_bit_sliced_top_k(spark, folder).collect()]
    assert sorted(found) == sorted(con.execute(si.OP12_SQL).fetchall())


@pytest.mark.parametrize("value", [0, 1, -1, 7, -200, 255, 12345, -(1 << 53)])
def test_signed_digits(value):
    digits = si.signed_digits(value)
    assert sum(sign << shift for sign, shift in digits) == value
    assert all(b - a > 1 for (_, a), (_, b) in zip(digits, digits[1:]))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-300, 300), min_size=3, max_size=3), min_size=1, max_size=150),
       st.lists(st.integers(-300, 300), min_size=3, max_size=3), st.integers(1, 6))
def test_bitmap_arithmetic(rows, query, k):
    low, digits, slices = si.slice_block(np.array(rows, dtype=np.int64))
    total, constant = si.weighted_sum(slices, low.tolist(), query)
    scores = [sum(a * b for a, b in zip(row, query)) for row in rows]
    assert [si.number_at(total, r) + constant for r in range(len(rows))] == scores
    every = si.pack(np.ones((1, len(rows)), dtype=np.uint8))[0]
    wanted = sorted(range(len(rows)), key=lambda r: (-scores[r], r))[:k]
    assert sorted(si.top_rows(total, every, k)) == sorted(wanted)

from __future__ import annotations

from collections import Counter

import numpy as np

from funnelmart.llm.sharding import draw, hypergeometric, into_shards, shard_sizes, write_shards


def test_matrix_has_exact_margins():
    have, wanted = [5, 0, 17, 3, 8], shard_sizes(33, 4)
    matrix = np.array(draw(1, 2, have, wanted))
    assert matrix.sum(axis=1).tolist() == have
    assert matrix.sum(axis=0).tolist() == wanted
    assert (matrix >= 0).all()


def test_matrix_follows_the_hypergeometric_law():
    first = [draw(seed, 0, [10, 30], [20, 20])[0][0] for seed in range(3000)]
    assert abs(np.mean(first) - 5) < 0.1
    assert abs(np.var(first) - 10 * 0.25 * 30 / 39) < 0.15


def test_large_populations_are_drawn_by_inversion():
    rng = np.random.default_rng(0)
    got = [hypergeometric(rng, 10**10, 3 * 10**10, 10**6) for _ in range(200)]
    assert abs(np.mean(got) - 250_000) < 150
    assert 300 < np.std(got) < 600


def test_shards_are_exact_gapless_and_repeatable(documents, scratch):
    rows = documents([(i, f"t{i}", "s") for i in range(1003)], parts=7)
    placed = into_shards(rows, 16, scratch, seed=3)
    assert set(placed.columns) == set(rows.columns) | {"shard", "slot"}
    found = placed.select("doc_id", "shard", "slot").collect()
    assert sorted(r["doc_id"] for r in found) == list(range(1003))
    sizes = Counter(r["shard"] for r in found)
    assert sorted(sizes) == list(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard in range(16):
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(sizes[shard]))
    again = placed.select("doc_id", "shard", "slot").collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, found))


def test_neighbours_are_spread(documents, scratch):
    rows = documents([(i, "t", "s") for i in range(2000)], parts=4)
    shard = {r["doc_id"]: r["shard"] for r in into_shards(rows, 4, scratch).collect()}
    together = sum(shard[i] == shard[i + 1] for i in range(1999)) / 1999
    assert 0.2 < together < 0.3


def test_odd_rows_and_empty_table(odd, scratch):
    found = into_shards(odd, 3, scratch)
    assert found.count() == odd.count()
    assert dict(found.dtypes)["slot"] == "bigint"  # replaces the column of that name
    assert into_shards(odd.where("false"), 3, scratch).count() == 0


def test_one_shard_and_more_shards_than_rows(documents, scratch):
    rows = documents([(1, "a", "s"), (2, "b", "s")])
    assert {r["shard"] for r in into_shards(rows, 1, scratch).collect()} == {0}
    assert sorted(r["slot"] for r in into_shards(rows, 5, scratch).collect()) == [0, 0]


def test_written_shards_hold_rows_by_slot(spark, documents, scratch, tmp_path):
    placed = into_shards(documents([(i, f"t{i}", "s") for i in range(50)]), 3, scratch)
    write_shards(placed, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == 50

from __future__ import annotations

import re
from collections import defaultdict

import pytest

from funnelmart.llm.mixing import expand, mix, solve_duals
from funnelmart.llm.queries import QUERIES

WEIGHTS = (5.0, 2.0, 1.0)


def expected_targets(sizes: dict) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        share = sum(weight[s] for s in sizes if s not in capped)
        target = {s: 3.0 * sizes[s] if s in capped else rest * weight[s] / share for s in sizes}
        more = {s for s in sizes if s not in capped and target[s] > 3 * sizes[s]}
        if not more:
            return target
        capped |= more


def by_source(rows):
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * r["copies"]
        target[r["source"]] = r["target"]
    return sizes, taken, target


def test_query_meets_targets(spark):
    folder = "/root/testdata/sf0.001"
    rows = QUERIES["op2_entropy_mixing"](spark, folder).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", texts[r["doc_id"]] or ""))
        assert r["taken"] <= 3 * r["size"]
    sizes, taken, target = by_source(rows)
    for source, wanted in expected_targets(sizes).items():
        assert target[source] == pytest.approx(wanted, rel=1e-9, abs=1e-6)
        assert abs(taken[source] - wanted) <= 0.05 * wanted + 20  # ten documents a source
    again = QUERIES["op2_entropy_mixing"](spark, folder).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_capped_sources_and_odd_rows(documents, scratch):
    rows = [(i, "w " * (1 + i % 7), "a") for i in range(20)] + [(100 + i, "w " * (1 + i % 11), None) for i in range(300)]
    rows += [(500 + i, "w " * (1 + i % 5), "b") for i in range(200)] + [(900, None, "b"), (901, "", "zero"), (None, "w w", "b")]
    found = mix(documents(rows), scratch).collect()
    assert len(found) == len(rows)
    sizes, taken, target = by_source(found)
    wanted = expected_targets(sizes)
    assert wanted["a"] == 3 * sizes["a"]  # at its cap
    for source in wanted:
        assert target[source] == pytest.approx(wanted[source])
        assert abs(taken[source] - wanted[source]) <= 3
    assert all(0 <= r["copies"] <= 3 for r in found)
    assert {r["copies"] for r in found if r["size"] == 0} == {1}


def test_repeated_rows_are_taken_alike(documents, scratch):
    found = mix(documents([(1, "a b c", "s")] * 7 + [(2, "d e", "t")] * 5), scratch).collect()
    assert len({(r["doc_id"], r["copies"]) for r in found}) == 2


def test_very_long_text_and_empty_table(odd, scratch):
    assert mix(odd, scratch).count() == odd.count()
    assert mix(odd.where("false"), scratch).count() == 0


def test_expand_repeats_rows(documents, scratch):
    rows = documents([(i, "w " * (1 + i % 9), "ab"[i % 2]) for i in range(60)])
    mixed = mix(rows, scratch)
    out = expand(mixed, rows.columns)
    assert out.columns == rows.columns
    assert out.count() == sum(r["copies"] for r in mixed.collect())


def test_duals_solve_the_constraints(spark, scratch):
    classes = spark.createDataFrame([("a", 1, 5), ("a", 10, 3), ("a", 100, 2), ("b", 7, 4)], "source string, size bigint, n bigint")
    targets = spark.createDataFrame([("a", 235, 400.0), ("b", 28, 10.0)], "source string, words bigint, target double")
    dual = {r["source"]: r["dual"] for r in solve_duals(classes, targets, 3, scratch).collect()}
    for source, rows, wanted in (("a", [(1, 5), (10, 3), (100, 2)], 400.0), ("b", [(7, 4)], 10.0)):
        got = sum(n * s * min(3.0, 2.718281828459045 ** (dual[source] * s)) for s, n in rows)
        assert got == pytest.approx(wanted, rel=1e-6)

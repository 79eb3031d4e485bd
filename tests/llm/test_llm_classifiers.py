from __future__ import annotations

import random
import zlib
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from funnelmart.llm import quality, toxicity
from funnelmart.llm.labelled import fold, logistic, training_rows
from funnelmart.llm.queries import QUERIES

LABELS = "doc_id bigint, quality int, toxic int, text string"


@pytest.mark.parametrize("query, label, least", [("op6_bradley_terry_quality", "quality", 0.97), ("op8_segment_toxicity", "toxic", 0.94)])
def test_held_out_accuracy(spark, query, label, least):
    folder = "/root/testdata/sf0.1"
    found = {r["doc_id"]: r for r in QUERIES[query](spark, folder).collect()}
    assert len(found) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 for r in found.values())
    held = [(found[r["doc_id"]]["predicted"], r[label]) for r in spark.read.parquet(f"{folder}/labels.parquet").collect()
            if found[r["doc_id"]]["held_out"]]
    assert sum(p == t for p, t in held) >= least * len(held)
    for i, r in found.items():
        rest = zlib.crc32(str(i).encode()) % (5 if label == "quality" else 3)
        assert r["held_out"] == (rest == (0 if label == "quality" else 1))


def small_corpus(spark, documents, odd):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(100, 300):
        words = [f"w{rng.randrange(300)}" for _ in range(40)]
        if i % 4 == 0:
            words[rng.randrange(20): 22] = ["vile", "brute"]
        rows.append((i, " ".join(words) if i % 5 else " ".join(words).upper() + "!!!", "s"))
        labels.append((i, int(i % 5 > 0), int(i % 4 == 0), "other"))
    labels += [(100, None, None, "x"), (None, 1, 1, "x"), (1, 0, 0, "x"), (99999, 0, 1, "x"), (101, 1, 0, "y")]
    return documents(rows).unionByName(odd), spark.createDataFrame(labels, LABELS)


def test_quality_of_odd_rows(spark, documents, odd):
    docs, labels = small_corpus(spark, documents, odd)
    found = quality.with_quality(docs, labels).collect()
    assert len(found) == docs.count() and all(0 <= r["score"] <= 1 for r in found)
    assert all((r["score"] >= quality.CUT_SCORE) == (r["doc_id"] % 5 > 0) for r in found if r["doc_id"] and r["doc_id"] >= 100)
    kept = quality.of_quality(docs, labels)
    assert kept.columns == docs.columns
    assert quality.with_quality(docs.where("false"), labels).count() == 0
    assert quality.of_quality(docs, labels.where("false")).count() == docs.count()
    again = quality.with_quality(docs, labels).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_toxicity_of_odd_rows(spark, documents, odd):
    docs, labels = small_corpus(spark, documents, odd)
    found = toxicity.with_toxicity(docs, labels).collect()
    assert len(found) == docs.count() and all(0 <= r["score"] <= 1 for r in found)
    for r in found:
        if r["doc_id"] and r["doc_id"] >= 100:
            assert (r["score"] >= toxicity.PREDICT) == (r["doc_id"] % 4 == 0)
            for p in r["passages"]:
                assert {"vile", "brute"} & set(r["text"].lower().replace("!", "").split()[p["start"]: p["start"] + p["words"]])
        else:
            assert not r["passages"]
    assert toxicity.with_toxicity(docs.where("false"), labels).count() == 0
    assert {r["score"] < 0.01 for r in toxicity.with_toxicity(docs, labels.where("false")).collect()} == {True}


def test_strengths_follow_preferences():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, quality.FEATURES))
    good = x @ np.linspace(-1, 1, quality.FEATURES) > 0.3
    ranking = quality.fit(x, good)
    score = ranking.score(x)
    assert ((score >= quality.CUT_SCORE) == good).mean() > 0.95
    assert quality.fit(x, np.ones(400, dtype=bool)).score(x).min() >= quality.CUT_SCORE


def all_segments(scores):
    """Maximal segments by their definition: the best segment, then the same to its left and right."""
    best = max(((sum(scores[i:j]), -i, j) for i, j in combinations(range(len(scores) + 1), 2)), default=(0, 0, 0))
    if best[0] <= 0:
        return []
    start, end = -best[1], best[2]
    return all_segments(scores[:start]) + [(start, end)] + [(a + end, b + end) for a, b in all_segments(scores[end:])]


def test_segments_agree_with_their_definition():
    rng = np.random.default_rng(4)
    for _ in range(200):
        scores = rng.integers(-4, 4, 12) + rng.random(12) / 100
        assert [(a, b) for a, b, _ in toxicity.maximal_segments(scores)] == all_segments(scores.tolist())
    assert toxicity.maximal_segments(np.empty(0)) == []


def test_decay_solves_its_equation():
    scores, shares = np.array([5.0, 1.0, -0.5]), np.array([0.01, 0.05, 0.94])
    assert np.exp(toxicity.decay(scores, shares) * scores) @ shares == pytest.approx(1)


def test_training_rows_are_bounded_and_of_the_right_fold(spark):
    labels = spark.createDataFrame([(i, i % 2, 0, "") for i in range(500)] + [(None, 1, 0, "")], LABELS)
    rows = training_rows(labels, "quality", fold(F.col("doc_id"), 5) != 0, most=100).collect()
    assert len(rows) == 100 and all(zlib.crc32(str(r["id"]).encode()) % 5 for r in rows)


def test_logistic_recovers_weights():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(20_000, 2))
    y = (rng.random(20_000) < 1 / (1 + np.exp(-(x @ [1.5, -0.7])))).astype(float)
    assert np.abs(logistic(x, y) - [1.5, -0.7]).max() < 0.1

"""Document quality by Bradley-Terry ranking.

A document of good quality is preferred to one of poor quality. Each document has a strength, a weighted
sum of features of its whole text, and a preference is as likely as the logistic function of the
difference of two strengths; weights are fitted to preference pairs by logistic loss on feature
differences. A quantile of the strengths is the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelmart.llm.labelled import MOST_LABELLED, fold, logistic, training_rows
from funnelmart.llm.store import bounded_batches, col, free_name, text_of
from funnelmart.llm.words import hash_words, shingles

MOST_PAIRS = 200_000
SEED = 6
CUT_SCORE = 0.3  # score of a document whose strength is the threshold

# byte classes: each is one feature, its share of the text
CLASSES = (
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b"!", b"?", b".",
    b",", b";:", b"|", b"#$%&*@^~", b"'\"`", b"()[]{}<>", b"-_+=/\\", bytes(range(128, 256)),
)
_class = np.full(256, len(CLASSES), dtype=np.uint8)
for _i, _members in enumerate(CLASSES):
    _class[list(_members)] = _i
FEATURES = len(CLASSES) + 1 + 9


def features(text: str, words: np.ndarray) -> np.ndarray:
    """Numbers that describe a whole text; all 0 for an empty one."""
    out = np.zeros(FEATURES)
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    if not len(raw):
        return out
    out[: len(CLASSES) + 1] = np.sqrt(np.bincount(_class[raw], minlength=len(CLASSES) + 1) / len(raw))
    lines = text.split("\n")
    n = len(words)
    times = np.unique(words, return_counts=True)[1] if n else np.zeros(1)
    runs = shingles(words, 3)
    out[len(CLASSES) + 1:] = (
        np.log1p(n) / 5,
        len(times) / max(n, 1),
        np.sqrt((words[1:] == words[:-1]).mean()) if n > 1 else 0.0,
        np.sqrt(times.max() / max(n, 1)),
        1 - len(np.unique(runs)) / max(len(runs), 1),
        len(raw) / max(n, 1) / 10,
        np.log1p(len(raw) / len(lines)) / 5,
        1 - len(set(lines)) / len(lines),
        np.sqrt(1 / len(lines)),
    )
    return out


@dataclass(frozen=True)
class Ranking:
    """Centre and scale of the features, their weights, and the threshold on the strength."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1, ``CUT_SCORE`` at the threshold."""
        z = self.strength(x) - self.cut + np.log(CUT_SCORE / (1 - CUT_SCORE))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(x: np.ndarray, good: np.ndarray) -> Ranking:
    """Fit strengths to pairs of a good and a poor document.

    Pairs are drawn evenly, at most ``MOST_PAIRS``. The threshold is the quantile of the strengths that
    parts good from poor with the fewest errors. With labels of one kind only, all strengths are 0 and
    every document passes.
    """
    if good.all() or not good.any():
        return Ranking(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), -1.0)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-9] = 1.0
    z = (x - mean) / scale
    rng = np.random.default_rng(SEED)
    better, worse = np.flatnonzero(good), np.flatnonzero(~good)
    n = min(MOST_PAIRS, len(better) * len(worse))
    pairs = z[rng.choice(better, n)] - z[rng.choice(worse, n)]
    weights = logistic(pairs, np.ones(n))
    strength = z @ weights
    order = np.argsort(strength, kind="stable")
    errors = np.concatenate(([(~good).sum()], (~good).sum() + np.cumsum(np.where(good[order], 1, -1))))
    best = np.flatnonzero(errors == errors.min())
    level = best[len(best) // 2] / len(strength)
    return Ranking(mean, scale, weights, float(np.quantile(strength, level)))


def fitted(documents: DataFrame, rows: DataFrame, text: str = "text", identity: str = "doc_id") -> Ranking:
    """A ranking from documents and their labels ``rows`` (id, label); at most MOST_LABELLED rows."""

    @F.pandas_udf("array<double>")
    def features_of(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t, w).tolist() for t, w in zip(texts, hash_words(texts.tolist()))], dtype=object)

    known = documents.select(col(identity).alias("id"), text_of(text).alias("text"))
    known = known.join(F.broadcast(rows), "id").orderBy(F.xxhash64("id", "text")).limit(MOST_LABELLED)
    found = known.select("label", features_of("text").alias("x")).collect()
    x = np.array([r["x"] for r in found]).reshape(len(found), FEATURES)
    return fit(x, np.array([r["label"] for r in found], dtype=int) == 1)


def score_column(spark: SparkSession, ranking: Ranking, text: Column) -> Column:
    sent = spark.sparkContext.broadcast(ranking)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            x = [features(t, w) for t, w in zip(texts, hash_words(texts.tolist()))]
            yield pd.Series(sent.value.score(np.array(x).reshape(len(x), FEATURES)))

    return score(text)


def with_quality(documents: DataFrame, labels: DataFrame, usable: Column | None = None, name: str = "score",
                 text: str = "text", identity: str = "doc_id", label: str = "quality") -> DataFrame:
    """``documents`` with a quality score between 0 and 1 in column ``name``.

    ``usable`` says from which rows of ``labels`` may be learned. Only the text is scored; null reads as
    empty, and empty texts are scored like any other. Repeated rows get equal scores. Without usable labels
    every score is the same and passes. A column of ``documents`` with that name is replaced.
    """
    bounded_batches(documents.sparkSession)
    rows = training_rows(labels, label, F.lit(True) if usable is None else usable, identity)
    ranking = fitted(documents, rows, text, identity)
    kept = [c for c in documents.columns if c.lower() != name.lower()]
    score = score_column(documents.sparkSession, ranking, text_of(text))
    return documents.select(*map(col, kept), score.alias(name))


def of_quality(documents: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that pass the threshold, in the columns given."""
    name = free_name(documents, "_quality")
    scored = with_quality(documents, labels, name=name, **options)
    return scored.where(F.col(name) >= CUT_SCORE).select(*map(col, documents.columns))


def op6_bradley_terry_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document; labels of one fold in five are held out."""
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held_out = fold(F.col("doc_id"), 5) == 0
    return with_quality(documents, labels, ~held_out).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= CUT_SCORE).cast("int").alias("predicted"),
    )

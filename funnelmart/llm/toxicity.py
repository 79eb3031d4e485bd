"""Toxic passages by maximum-scoring segments.

Every word has a score: its log-odds of standing in a toxic text, estimated under a Dirichlet prior that
follows the whole corpus, less a little, so that an ordinary text drifts downward. A linear scan finds all
maximal segments of positive score. How high a segment scores by chance in an ordinary text of that
length follows an extreme-value law; segments beyond it are the toxic passages, and their significance
adds up to the score of the document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelmart.llm.labelled import MOST_LABELLED, fold, logistic, training_rows
from funnelmart.llm.store import bounded_batches, col, text_of
from funnelmart.llm.words import U64, hash_tokens, mixed

STEMS = (5, 4)  # bytes; a word that was not seen in toxic texts is scored by its beginning
PRIOR_DOCUMENTS = 10.0  # weight of the corpus in the prior, in documents
FLAT = 0.5  # and of nothing at all
CAUTION = 2.0  # standard deviations by which a log-odds is moved toward 0
DRIFT = 0.8  # taken off each word's score, so that a long ordinary text does not add up to a passage
LEAST_TOXIC = 2  # toxic documents a token must occur in to be scored by itself
K = 0.1  # scale of the extreme-value law; what it is off by, the calibration on labels takes up
MOST_CHANCE = 0.1  # expected number of such segments by chance up to which one is significant
PREDICT = 0.7
FILTER_BITS = 20
PASSAGES = "array<struct<start: int, words: int, score: double, chance: double>>"


def levels(text: str) -> list[np.ndarray]:
    """Per word the keys under which it may be known: the whole word, then its stems."""
    whole, stems = hash_tokens(text, STEMS)
    return [whole, *(mixed(s + U64(n)) for s, n in zip(stems, STEMS))]


class Lexicon:
    """Keys in ascending order; finds the place of each word's most specific known key."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.present = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.present[self.slot(keys)] = True

    @staticmethod
    def slot(keys: np.ndarray) -> np.ndarray:
        return (keys >> U64(64 - FILTER_BITS)).astype(np.int64)

    def find(self, text: str) -> np.ndarray:
        """Index of the key by which each word is known, or the number of keys."""
        found = levels(text)
        out = np.full(len(found[0]), len(self.keys), dtype=np.int64)
        for keys in found:
            at = np.flatnonzero((out == len(self.keys)) & self.present[self.slot(keys)])
            place = np.searchsorted(self.keys, keys[at])
            hit = self.keys[np.minimum(place, len(self.keys) - 1)] == keys[at] if len(self.keys) else at < 0
            out[at[hit]] = place[hit]
        return out


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in linear time.

    Only places with a positive score open a segment; running sums stand for all places between.
    """
    running = np.concatenate(([0.0], np.cumsum(scores)))
    kept: list[tuple[int, int, float, float, int]] = []  # start, end, sum before, sum after, nearest lower
    for at in np.flatnonzero(scores > 0).tolist():
        start, end, left, right = at, at + 1, running[at], running[at + 1]
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= left:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= right:
                kept.append((start, end, left, right, j))
                break
            start, left = kept[j][0], kept[j][2]
            del kept[j:]
    return [(s, e, float(r - l)) for s, e, l, r, _ in kept]


def decay(scores: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of E[exp(x * score)] = 1: how fast the chance of a high segment falls."""
    if not ((scores > 0) & (shares > 0)).any() or scores @ shares >= 0:
        return 1.0
    low, high = 0.0, 1.0
    while np.exp(np.minimum(high * scores, 500)) @ shares < 1 and high < 100:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if np.exp(np.minimum(middle * scores, 500)) @ shares < 1 else (low, middle)
    return max(low, 1e-3)


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    scores: np.ndarray  # one per key, and a last one for unknown words
    decay: float
    line: tuple[float, float]  # calibration: intercept and slope

    def passages(self, text: str) -> list[tuple[int, int, float, float]]:
        """Significant passages of a text: first word, words, score, expected number by chance."""
        scores = self.scores[self.lexicon.find(text)] if text else np.empty(0)
        out = []
        for start, end, score in maximal_segments(scores):
            chance = K * len(scores) * float(np.exp(-self.decay * score))
            if chance <= MOST_CHANCE:
                out.append((start, end - start, score, chance))
        return out

    def evidence(self, text: str) -> float:
        return float(sum(-np.log(max(c, 1e-300)) for *_, c in self.passages(text)))

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        z = self.line[0] + self.line[1] * np.log1p(evidence)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def token_counts(known: DataFrame) -> DataFrame:
    """Documents and places per token in toxic and other texts (``text``, ``label``), pre-aggregated."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            parts = []
            for text, label in zip(pdf["text"], pdf["label"]):
                for keys in levels(text):
                    token, times = np.unique(keys, return_counts=True)
                    parts.append(np.stack([
                        token.view(np.int64), np.full(len(token), int(label == 1)), times.astype(np.int64),
                    ]))
            if parts:
                token, label, times = np.concatenate(parts, axis=1)
                frame = pd.DataFrame({"token": token, "toxic": label, "other": 1 - label, "places": times * (1 - label)})
                yield frame.groupby("token", as_index=False).sum()

    counted = known.select("text", "label").mapInPandas(count, "token bigint, toxic bigint, other bigint, places bigint")
    return counted.groupBy("token").agg(*[F.sum(c).alias(c) for c in ("toxic", "other", "places")])


def corpus_counts(documents: DataFrame, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray, int]:
    """Over all documents: documents and places per key (last: unknown words), and documents."""
    sent = documents.sparkSession.sparkContext.broadcast(lexicon)
    size = len(lexicon.keys) + 1

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, places, seen = np.zeros(size, np.int64), np.zeros(size, np.int64), 0
        for pdf in batches:
            seen += len(pdf)
            for text in pdf["text"]:
                found, times = np.unique(sent.value.find(text), return_counts=True)
                held[found] += 1
                places[found] += times
        some = np.flatnonzero(places)
        yield pd.DataFrame({"key": some, "held": held[some], "places": places[some]})
        yield pd.DataFrame({"key": [-1], "held": [seen], "places": [0]})

    counted = documents.select("text").mapInPandas(count, "key bigint, held bigint, places bigint")
    held, places, seen = np.zeros(size, np.int64), np.zeros(size, np.int64), 0
    for row in counted.groupBy("key").agg(F.sum("held").alias("held"), F.sum("places").alias("places")).collect():
        if row["key"] < 0:
            seen = row["held"]
        else:
            held[row["key"]], places[row["key"]] = row["held"], row["places"]
    return held, places, seen


def fitted(documents: DataFrame, rows: DataFrame, text: str = "text", identity: str = "doc_id") -> Model:
    """A model from documents and their labels ``rows`` (id, label), at most MOST_LABELLED rows."""
    texts = documents.select(col(identity).alias("id"), text_of(text).alias("text"))
    known = texts.join(F.broadcast(rows), "id")
    totals = known.agg(F.sum((F.col("label") == 1).cast("int")), F.count("*")).first()
    toxic, other = int(totals[0] or 0), int(totals[1]) - int(totals[0] or 0)
    if not toxic or not other:
        return Model(Lexicon(np.empty(0, U64)), np.array([-DRIFT]), 1.0, (-30.0 if not toxic else 30.0, 0.0))

    found = token_counts(known).where(F.col("toxic") >= LEAST_TOXIC).orderBy("token").toPandas()
    found = found.assign(key=found["token"].to_numpy().view(U64)).sort_values("key")
    lexicon = Lexicon(found["key"].to_numpy())
    held, places, seen = corpus_counts(texts, lexicon)
    prior = PRIOR_DOCUMENTS * held[:-1] / max(seen, 1) + FLAT
    y, n = found["toxic"].to_numpy() + prior, found["other"].to_numpy() + prior
    all_y, all_n = toxic + PRIOR_DOCUMENTS + 2 * FLAT, other + PRIOR_DOCUMENTS + 2 * FLAT
    odds = np.log(y / np.maximum(all_y - y, FLAT)) - np.log(n / np.maximum(all_n - n, FLAT))
    sure = np.sign(odds) * np.maximum(np.abs(odds) - CAUTION * np.sqrt(1 / y + 1 / n), 0)
    scores = np.concatenate((sure - DRIFT, [-DRIFT]))

    plain = found["places"].to_numpy() + 1000.0 * places[:-1] / max(places.sum(), 1)
    unknown = max(float(places[-1]) / max(places.sum(), 1), 0.01) * max(plain.sum(), 1.0)
    shares = np.concatenate((plain, [unknown]))
    model = Model(lexicon, scores, decay(scores, shares / shares.sum()), (0.0, 0.0))

    evidence = evidence_column(documents.sparkSession, model, F.col("text"))
    # repeated ids may be more rows than labels; those taken are told by a hash, and come in one order
    order = [F.xxhash64("id"), "id", "label", "x"]
    scored = known.select("id", "label", evidence.alias("x")).orderBy(*order).limit(2 * MOST_LABELLED).toPandas()
    x = np.log1p(scored["x"].to_numpy())
    line = logistic(np.stack([np.ones(len(x)), x], axis=1), (scored["label"] == 1).to_numpy().astype(float), 1e-4)
    return Model(lexicon, scores, model.decay, (float(line[0]), max(float(line[1]), 0.0)))


def evidence_column(spark: SparkSession, model: Model, text: Column) -> Column:
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def evidence(texts: pd.Series) -> pd.Series:
        return pd.Series([sent.value.evidence(t) for t in texts], dtype=float)

    return evidence(text)


def passages_column(spark: SparkSession, model: Model, text: Column) -> Column:
    """The significant toxic passages of a text, by words."""
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf(PASSAGES)
    def passages(texts: pd.Series) -> pd.Series:
        names = ("start", "words", "score", "chance")
        return pd.Series([[dict(zip(names, p)) for p in sent.value.passages(t)] for t in texts], dtype=object)

    return passages(text)


def with_toxicity(documents: DataFrame, labels: DataFrame, usable: Column | None = None, text: str = "text",
                  identity: str = "doc_id", label: str = "toxic") -> DataFrame:
    """``documents`` with ``score``, the probability of toxicity, and ``passages``, the significant passages.

    ``usable`` says from which rows of ``labels`` may be learned. Only the text is scored; null reads as
    empty, and texts without words have no passage. Repeated rows get equal scores. Without usable labels
    of both kinds there are no passages, and every score is that of the labels there are (0 if none). Input
    columns named like an added one are replaced.
    """
    spark = documents.sparkSession
    bounded_batches(spark)
    rows = training_rows(labels, label, F.lit(True) if usable is None else usable, identity)
    model = fitted(documents, rows, text, identity)
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf(f"struct<score: double, passages: {PASSAGES}>")
    def both(texts: pd.Series) -> pd.DataFrame:
        found = [sent.value.passages(t) for t in texts]
        evidence = np.array([sum(-np.log(max(c, 1e-300)) for *_, c in x) for x in found], dtype=float)
        names = ("start", "words", "score", "chance")
        return pd.DataFrame({
            "score": sent.value.probability(evidence),
            "passages": pd.Series([[dict(zip(names, p)) for p in x] for x in found], dtype=object),
        })

    kept = [c for c in documents.columns if c.lower() not in ("score", "passages")]
    found = both(text_of(text))
    return documents.select(*map(col, kept), found.alias("_found")).select(
        *map(col, kept), F.col("_found.score").alias("score"), F.col("_found.passages").alias("passages")
    )


def op8_segment_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document; labels of one fold in three are held out."""
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held_out = fold(F.col("doc_id"), 3) == 1
    return with_toxicity(documents, labels, ~held_out).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= PREDICT).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"),
    )

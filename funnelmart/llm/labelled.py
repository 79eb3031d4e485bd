"""Bounded samples of labelled documents, and logistic fits on them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelmart.llm.store import col

MOST_LABELLED = 20_000  # labelled rows a model is fitted on


def fold(identity: Column, folds: int) -> Column:
    """crc32 of an id as text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(identity.cast("string").cast("binary")), F.lit(folds))


def training_rows(labels: DataFrame, label: str, usable: Column, identity: str = "doc_id",
                  most: int = MOST_LABELLED) -> DataFrame:
    """At most ``most`` rows (id, label) for which ``usable`` holds, chosen by a hash of the id.

    Null ids and labels are left out; an id with several labels keeps the largest.
    """
    known = labels.where(usable & col(identity).isNotNull() & col(label).isNotNull())
    known = known.groupBy(col(identity).alias("id")).agg(F.max(col(label).cast("int")).alias("label"))
    return known.orderBy(F.xxhash64("id"), "id").limit(most)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 60,
             weight: np.ndarray | None = None) -> np.ndarray:
    """Weights of a logistic regression by damped Newton steps; ``x`` has its own column of ones if wanted.

    A row counts as often as its ``weight`` says, which may be a fraction.
    """
    w = np.zeros(x.shape[1])
    if not len(x):
        return w
    share = np.full(len(x), 1 / len(x)) if weight is None else weight / weight.sum()

    def loss(v):
        z = x @ v
        return share @ (np.logaddexp(0, z) - y * z) + ridge * v @ v / 2

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (share * (p - y)) + ridge * w
        curve = (x * (share * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        size = 1.0
        while size > 1e-4 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return w

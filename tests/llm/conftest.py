from __future__ import annotations

import pytest

from funnelmart.llm.store import Scratch

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint, slot string, `limit` int, size int, score double"


@pytest.fixture
def scratch(spark):
    own = Scratch(spark)
    yield own
    own.close()


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text, source); the other columns clash with names that operators use."""

    def build(rows, parts=3):
        full = [(i, t, "en", s, None if t is None else len(t), "x", 1, 2, 0.5) for i, t, s in rows]
        return spark.createDataFrame(full, DOCUMENTS).repartition(parts)

    return build


ODD = [
    (1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, "one", "b"), (4, "one", "b"), (None, "lost and found again here", "b"),
    (5, "word " * 60_000, "a"), (6, "é" * 300_000, "a"), (7, "<turn \\ </turn> \x00 ünï 𝒳", "b"), (8, "!!! ### |", None),
]


@pytest.fixture
def odd(documents):
    """Null, empty, repeated and very long texts, null ids and sources."""
    return documents(ODD)

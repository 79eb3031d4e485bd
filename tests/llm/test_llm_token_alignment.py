"""Alignment of two tokenizers, against one that walks byte by byte and counts all pairs of tokens."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from funnelmart.llm import token_alignment as ta


@pytest.fixture(scope="module")
def sides():
    a = tokenizers.Tokenizer.from_file(ta.BYTE_LEVEL)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=ta.PIECES), ta.ByteLevel(ta.BYTE_LEVEL)


def groups_of(text, sides):
    """Groups of (a ids, b ids), by stepping through the bytes; none where the bytes differ."""
    a, b, table = sides
    if not text:
        return []
    data = b" " + text.encode()
    a_ids = a.encode(" " + text, add_special_tokens=False).ids
    b_ids = b.encode(text)
    b_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in b_ids]
    a_bytes = [table.bytes[i] for i in a_ids]
    if b"".join(a_bytes) != data or b"".join(b_bytes) != data:
        return []
    ends = [{}, {}]
    for side, parts in enumerate((a_bytes, b_bytes)):
        at = 0
        for i, part in enumerate(parts):
            at += len(part)
            ends[side][at] = i
    out, a_from, b_from = [], 0, 0
    for at in range(1, len(data) + 1):
        if at in ends[0] and at in ends[1]:
            out.append((a_ids[a_from: ends[0][at] + 1], b_ids[b_from: ends[1][at] + 1]))
            a_from, b_from = ends[0][at] + 1, ends[1][at] + 1
    return out


def brute(texts, sides):
    every = [groups_of(t, sides) for t in texts]
    links = [Counter(p for a, b in groups for p in ((x, y) for x in a for y in b)) for groups in every]
    docs = Counter(p for c in links for p in c)
    most = {}
    for (a, _), n in docs.items():
        most[a] = max(most.get(a, 0), n)
    out = []
    for groups, c in zip(every, links):
        joined = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((
            sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(c.values()),
            sum(n for p, n in c.items() if docs[p] == most[p[0]]), sum(n * docs[p] for p, n in c.items()),
            hashlib.sha256(joined.encode()).hexdigest() if groups else "",
        ))
    return out


def answer(documents, scratch, texts, **options):
    found = ta.aligned_documents(documents([(i, t, "a") for i, t in enumerate(texts)]), scratch, **options)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return [tuple(r)[1:] for r in sorted(found.collect(), key=lambda r: r["doc_id"])]


ODD = [
    None, "", " ", "  ", " a", "a ", "a  b   c ", "\n", "é" * 5_000, "\x00\x01", "▁a b", "a ▁ b", "<s> </s> <unk> <|endoftext|> <0x0A>", "日本語 テキスト",
    "👩‍👩‍👧 ok", "a b　c\u0085d", " " * 3_000 + "x", "word " * 9_000, "same text here", "same text here", "﻿x", "​ ‍ .",
]


def test_agrees_with_brute_force(sides, documents, scratch):
    rng = random.Random(2)
    alphabet = [*"abcdeé ß.!?\n\t0123 ", " the", " und ", "ñ", "日", "🙂", "  ", "▁"]
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(400))) for _ in range(80)]
    wanted = brute(texts, sides)
    assert answer(documents, scratch, texts) == wanted
    # many small pieces, and few pairs in the broadcast
    assert answer(documents, scratch, texts, work=7, hot_pairs=40) == wanted
    assert answer(documents, scratch, texts, work=64, hot_pairs=0) == wanted


def test_empty_table(documents, scratch):
    assert answer(documents, scratch, []) == []
    assert answer(documents, scratch, [None]) == [(0, 0, 0, 0, 0, 0, "")]


def test_null_and_repeated_ids_stay_rows(documents, scratch):
    rows = ta.aligned_documents(documents([(None, "one two", "a"), (4, "one two", "b"), (4, "one two", "b")]), scratch).collect()
    assert len(rows) == 3 and len({tuple(r)[1:] for r in rows}) == 1


def test_registered_query_agrees_with_brute_force(spark, sides):
    folder = "/root/testdata/sf0.001"
    table = pq.read_table(f"{folder}/documents.parquet")
    wanted = dict(zip(table["doc_id"].to_pylist(), brute(table["text"].to_pylist(), sides)))
    assert {r["doc_id"]: tuple(r)[1:] for r in ta.op13_merge_path_alignment(spark, folder).collect()} == wanted


def test_operator_gives_the_groups(sides, documents, scratch):
    texts = ["Zweiundvierzig Fälle.", "plain words", "x" * 900]
    rows = documents([(i, t, "a") for i, t in enumerate(texts)])
    found = {int(r["name"]): r for r in ta.align(rows, scratch, work=20).collect()}
    for i, text in enumerate(texts):
        groups = groups_of(text, sides)
        assert found[i]["groups"] == ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        assert {(o["a"], o["b"]): o["times"] for o in found[i]["overlaps"]} == Counter((x, y) for a, b in groups for x in a for y in b)


def test_ranks_say_what_merges_do(sides):
    """Both engines cut every character alike, in several surroundings."""
    a, _, ours = sides
    assert ours.by_rank
    points = [c for c in range(1, 0x30000, 3) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 64):
        text = "|".join(f"a{chr(c)}a {chr(c)}  {chr(c)}1 !{chr(c)}\n" for c in points[at: at + 64])
        assert ours.encode(text).tolist() == a.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from([*"  \n▁abé<0x>s日\u00a0\x1c"]), min_size=1, max_size=40), max_size=4))
def test_words_give_the_ids_of_the_text(sides, texts):
    found = ta.both(ta.BYTE_LEVEL, ta.PIECES).encode(texts)
    assert len(found) == len(texts)
    for text, ids in zip(texts, found):
        if ids is None:
            assert groups_of(text, sides) == []
        else:
            assert ids[0].tolist() == sides[0].encode(" " + text, add_special_tokens=False).ids
            assert ids[1].tolist() == sides[1].encode(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=60), st.lists(st.integers(1, 4), min_size=1, max_size=60), st.integers(1, 30))
def test_crossings_lie_on_the_merge_path(a, b, work):
    a_ends, b_ends = np.cumsum(a), np.cumsum(b)
    merged = sorted([(e, 0) for e in a_ends.tolist()] + [(e, 1) for e in b_ends.tolist()])
    diagonals = np.arange(work, len(merged), work)
    for d, i, j in zip(diagonals.tolist(), *ta.crossings(a_ends, b_ends, diagonals)):
        before = merged[:d]
        n = sum(side == 0 for _, side in before)
        whole = d < len(merged) and merged[d] == (before[-1][0], 1) and before[-1][1] == 0
        assert (i, j) == (n, d - n + whole)


def test_large_groups_are_counted_by_id():
    a, b = np.array([5, 5, 6] * 30, dtype=np.int32), np.array([7, 8] * 40, dtype=np.int32)
    groups = ta.Groups(a, b, np.array([89]), np.array([79]))
    assert [x.tolist() for x in groups.overlaps(np.zeros(1, dtype=np.int64))] == [[0] * 4, [5, 5, 6, 6], [7, 8, 7, 8], [2400, 2400, 1200, 1200]]

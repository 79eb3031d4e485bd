from __future__ import annotations

import random
import re

import numpy as np

from funnelmart.llm.words import PIECE, hash_tokens, hash_words, shingles

WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")


def test_equal_words_have_equal_hashes_and_others_differ():
    rng = random.Random(0)
    texts = [" ".join(rng.choice(["the", "The", "é", "x1", "a-b", "𝒳y", "", "!"]) for _ in range(rng.randrange(30))) for _ in range(200)]
    known: dict[str, int] = {}
    for text, hashes in zip(texts, hash_words(texts)):
        words = WORD.findall(text.lower())
        assert len(words) == len(hashes)
        for w, h in zip(words, hashes.tolist()):
            assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known)


def test_long_texts_are_hashed_whole():
    words = [f"w{i}" for i in range(PIECE)]
    long, = hash_words([" ".join(words)])
    short = np.concatenate(list(hash_words(words)))
    assert (long == short).all()
    giant, = hash_words(["a" * (3 * PIECE)])
    assert len(giant) == 1


def test_null_and_empty_texts_have_no_words():
    assert [len(x) for x in hash_words([None, "", "..", "a"])] == [0, 0, 0, 1]
    assert len(hash_tokens("", (4,))[0]) == 0


def test_stems_are_first_bytes():
    whole, (stem,) = hash_tokens("lowercase lowest low", (3,))
    assert stem[0] == stem[1] == stem[2] == whole[2]


def test_shingles_tell_order_and_length():
    a, b, c = (set(shingles(w, 5).tolist()) for w in hash_words(["a b c d e f", "b a c d e f", "a b c"]))
    assert len(a) == 2 and len(c) == 1 and not a & b and not a & c

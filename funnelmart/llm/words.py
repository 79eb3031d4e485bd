"""Words of texts as 64-bit hashes, for whole batches of texts at once.

A word is a maximal run of ASCII letters, ASCII digits and characters beyond ASCII, in lower case. Texts
are hashed as UTF-8 bytes in NumPy: a running polynomial over the bytes gives the hash of any stretch as
a difference of two of its values, so the cost is a few array passes per byte and none per word. Nothing
is cut off: a text longer than a piece is taken in pieces that end between words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np

PIECE = 1 << 18  # bytes hashed at a time; a longer word makes a longer piece
BASE = 0x9E3779B97F4A7C15
U64 = np.uint64

_separator = np.ones(256, dtype=bool)
_separator[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_gap = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. n - 1`` modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, PIECE + 64), base, dtype=U64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have


def mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values; one to one."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def hash_piece(data: bytes, stems: Sequence[int] = ()) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Hashes and starting bytes of the words of ``data``, and hashes of their first so many bytes."""
    raw = np.frombuffer(data, dtype=np.uint8)
    inside = np.zeros(len(raw) + 2, dtype=np.int8)
    inside[1:-1] = ~_separator[raw]
    change = np.diff(inside)
    starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    if not len(starts):
        return np.empty(0, dtype=U64), starts, [np.empty(0, dtype=U64) for _ in stems]
    running = np.zeros(len(raw) + 1, dtype=U64)
    np.cumsum((raw.astype(U64) + U64(1)) * powers(BASE, len(raw))[: len(raw)], out=running[1:])
    before, back = running[starts], powers(pow(BASE, -1, 1 << 64), len(raw))[starts]

    def until(stop: np.ndarray) -> np.ndarray:
        return mixed((running[stop] - before) * back + (stop - starts).astype(U64))

    return until(ends), starts, [until(np.minimum(ends, starts + n)) for n in stems]


def pieces(data: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(data):
        cut = _gap.search(data, at + PIECE)
        end = cut.start() if cut else len(data)
        yield data[at:end]
        at = end


def hash_words(texts: Sequence[str | None]) -> Iterator[np.ndarray]:
    """The word hashes of each text, in order; a null text has none."""
    group: list[bytes] = []
    size = 0
    for text in texts:
        data = text.lower().encode("utf-8", "replace") if text else b""
        if len(data) > PIECE:
            yield from flush(group)
            group, size = [], 0
            yield np.concatenate([hash_piece(x)[0] for x in pieces(data)])
            continue
        group.append(data)
        size += len(data) + 1
        if size > PIECE:
            yield from flush(group)
            group, size = [], 0
    yield from flush(group)


def flush(group: list[bytes]) -> Iterator[np.ndarray]:
    if group:
        hashes, starts, _ = hash_piece(b"\n".join(group) + b"\n")
        ends = np.cumsum([len(x) + 1 for x in group])
        at = 0
        for end in np.searchsorted(starts, ends):
            yield hashes[at:end]
            at = end


def hash_tokens(text: str, stems: Sequence[int]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Word hashes of one text, and per length in ``stems`` the hashes of the words' first bytes."""
    found = [hash_piece(x, stems) for x in pieces(text.lower().encode("utf-8", "replace"))]
    if not found:
        return np.empty(0, dtype=U64), [np.empty(0, dtype=U64) for _ in stems]
    return np.concatenate([f[0] for f in found]), [
        np.concatenate([f[2][i] for f in found]) for i in range(len(stems))
    ]


def combined(words: np.ndarray, offsets: Sequence[int]) -> np.ndarray:
    """One hash per place, of the words at these distances from it, told apart by distance."""
    n = len(words) - max(offsets)
    out = np.zeros(max(n, 0), dtype=U64)
    for i, offset in enumerate(offsets):
        out += words[offset: offset + n] * powers(0xD6E8FEB86659FD93, 64 + len(offsets))[i + 1]
    return mixed(out)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words; a shorter text is one shingle, a text without words has none."""
    if not len(words):
        return words
    return combined(words, range(min(k, len(words))))

"""Alignment of two tokenizers' tokens by their byte ends, cut into equal work along the merge path.

Both tokenizers cut a text into tokens whose bytes are the text. Merging the two sorted lists of token ends gives the
offsets where both end; between two of those lies a group, and every token of one side overlaps those of the other
in its group. Where a text is long, the merge is cut: the path that a merge takes through the grid of both lists
crosses each diagonal once, at a place that a binary search finds without merging anything before it, so equally
spaced diagonals give pieces of equal work that know nothing of each other. Pieces are stored, and tasks share them by
bytes, not by document; each gives its whole groups and, open, what lies before its first and after its last common end. The open ends of neighbouring pieces are
stitched into the groups that the cuts went through.

How many documents hold a pair of ids linked is counted over the corpus. Most links are of few pairs: the most frequent
ones, HOT_PAIRS at most, are looked up in a broadcast, the others in a shuffle join.

Tokenizers load from files that every executor has at the same path.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelmart.llm.store import Scratch, bounded_batches, col

FOLDER = "/opt/tokenizers"
BYTE_LEVEL = f"{FOLDER}/byte_bpe_50k.json"
PIECES = f"{FOLDER}/piece_bpe_32k.model"
PIECE = 1 << 14  # ends of both sides that a piece merges
TEXT_BYTES = 1 << 21  # text whose tokens are merged at a time
WORDS, WORD_LENGTH = 1 << 18, 40  # words of up to so many characters whose pieces a worker remembers
PLAIN_GROUP = 1 << 10  # links of a group that are written out before equal ones are added up
HOT_PAIRS = 1 << 18
SPACE = "▁"
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""  # fixed value: byte-level BPE's words

OVERLAP = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("times", pa.int32())])
INTS = pa.list_(pa.int32())
ROW = {
    "row": pa.int64(), "name": pa.string(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups": pa.string(),
    "overlaps": pa.list_(OVERLAP),
}
CUT = {"piece": pa.int32(), "a": INTS, "a_start": pa.int64(), "b": INTS, "b_start": pa.int64()}
OPEN = {"piece": pa.int32(), "closed": pa.bool_(), "head_a": INTS, "head_b": INTS, "tail_a": INTS, "tail_b": INTS}
STRUCTS = "array<struct<a int, b int, times int>>"
ROW_SCHEMA = f"row bigint, name string, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, overlaps {STRUCTS}"
CUT_SCHEMA = "piece int, a array<int>, a_start bigint, b array<int>, b_start bigint"
OPEN_SCHEMA = "piece int, closed boolean, head_a array<int>, head_b array<int>, tail_a array<int>, tail_b array<int>"


class ByteLevel:
    """A byte-level BPE vocabulary in the JSON format of ``tokenizers``; strings of special tokens are plain text.

    Where merges stand in the order of the ids they make, ranks say all that merges do and ``tiktoken``, which takes
    ranks, gives the same ids several times faster; tests compare both over all characters.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model = described["model"]
        special = {t["id"] for t in described["added_tokens"]}
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        hidden = [b for b in range(256) if b not in shown]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if i not in special}
        self.length = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        self.length[list(ranks.values())] = [len(token) for token in ranks]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.by_rank = all(model["vocab"][a + b] == 256 + i for i, (a, b) in enumerate(merges))
        if self.by_rank:
            self.ranked = tiktoken.Encoding("byte level", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        else:
            self.plain = tokenizers.Tokenizer.from_file(path)
            self.plain.encode_special_tokens = True
        self.bytes = {i: token for token, i in ranks.items()}
        self.lossless = self.by_rank and all(bytes([b]) in ranks for b in range(256))
        self.spaced = np.zeros(len(self.length), dtype=bool)
        self.spaced[[i for token, i in ranks.items() if token[:1] == b" "]] = True

    def encode(self, text: str) -> np.ndarray:
        ids = self.ranked.encode_ordinary(text) if self.by_rank else self.plain.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype=np.int32)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word with a space before it; all are cut as one text, in which only words start with a space."""
        ids = self.encode("".join([f" {word}" for word in words]))
        data, starts = ids.tobytes(), (4 * np.flatnonzero(self.spaced[ids])).tolist()
        return [data[start:end] for start, end in zip(starts, [*starts[1:], len(data)])]

    def spells(self, ids: np.ndarray, data: bytes) -> bool:
        return self.lossless or b"".join(map(self.bytes.__getitem__, ids.tolist())) == data


class Pieces:
    """A SentencePiece model; ``by_word`` if no piece goes on past the end of a word."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [
            bytes([int(name[3:5], 16)]) if self.model.is_byte(i) else name.replace(SPACE, " ").encode() for i, name in enumerate(names)
        ]
        self.length = np.array([len(b) for b in self.bytes], dtype=np.int64)
        self.by_word = not any(re.search(f"[^{SPACE}]{SPACE}", name) for name in names)

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text, num_threads=1), dtype=np.int32)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word with a space before it."""
        return [array("i", ids).tobytes() for ids in self.model.encode(words, num_threads=1)]

    def spells(self, ids: np.ndarray, data: bytes) -> bool:
        return b"".join(map(self.bytes.__getitem__, ids.tolist())) == data


class Both:
    """Ids of texts on both sides, by word where words can be cut apart.

    Where single spaces stand between words that neither start nor end with white space, both sides start a token at
    each of those spaces, so a text's ids are those of its words. Words that a worker meets early, which the frequent
    ones are, are remembered.
    """

    def __init__(self, a: str, b: str):
        self.a, self.b = ByteLevel(a), Pieces(b)
        self.known: dict[str, tuple[bytes, bytes]] = {}
        self.ids = max(len(self.a.length), len(self.b.length))

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Per text its ids on both sides, with a space before the text; none where their bytes are not the text."""
        words = [text.split(" ") for text in texts]
        known = self.known.get
        found = [list(map(known, line)) for line in words]
        lacking = dict.fromkeys(w for line, ids in zip(words, found) if None in ids for w, x in zip(line, ids) if x is None)
        fresh = self.encode_words([w for w in lacking if w and w == w.strip() and SPACE not in w]) if self.b.by_word else {}
        out = []
        for text, line, ids in zip(texts, words, found):
            if None in ids:
                ids = [fresh.get(w) if x is None else x for w, x in zip(line, ids)]
            out.append(self.encode_whole(text) if None in ids else tuple(
                np.frombuffer(b"".join([x[side] for x in ids]), dtype=np.int32) for side in (0, 1)
            ))
        return out

    def encode_words(self, words: list[str]) -> dict[str, tuple[bytes, bytes]]:
        """Ids of words whose bytes they are; others are left out, so that their texts are looked at as a whole."""
        fresh = {}
        if not words:
            return fresh
        for word, a, b in zip(words, self.a.encode_words(words), self.b.encode_words(words)):
            data = b" " + word.encode()
            if all(side.spells(np.frombuffer(ids, dtype=np.int32), data) for side, ids in ((self.a, a), (self.b, b))):
                fresh[word] = a, b
                if len(word) <= WORD_LENGTH and len(self.known) < WORDS:
                    self.known[word] = a, b
        return fresh

    def encode_whole(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        a, b = self.a.encode(" " + text), self.b.encode(text)
        data = b" " + text.encode()
        return (a, b) if self.a.spells(a, data) and self.b.spells(b, data) else None


@lru_cache(maxsize=2)
def both(a: str, b: str) -> Both:
    return Both(a, b)


@lru_cache(maxsize=1)
def decimals(n: int) -> dict[str, np.ndarray]:
    """Ids up to ``n`` as text, each followed by a separator."""
    return {end: np.array([f"{i}{end}" for i in range(n)], dtype=object) for end in ",|;"}


def crossings(a_ends: np.ndarray, b_ends: np.ndarray, diagonals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many ends of each side lie before each diagonal on the merge path; of equal ends a's comes first.

    All diagonals are searched at once. A cut between the two halves of a common end is moved behind it.
    """
    low, high = np.maximum(0, diagonals - len(b_ends)), np.minimum(diagonals, len(a_ends))
    while (low < high).any():
        open_ = low < high
        middle = (low + high) // 2
        right = np.where(open_, diagonals - middle - 1, 0)
        ahead = open_ & (a_ends[np.minimum(middle, len(a_ends) - 1)] <= b_ends[np.clip(right, 0, len(b_ends) - 1)])
        low, high = np.where(ahead, middle + 1, low), np.where(open_ & ~ahead, middle, high)
    i, j = low, diagonals - low
    split = (i > 0) & (j < len(b_ends))
    split &= a_ends[np.maximum(i - 1, 0)] == b_ends[np.minimum(j, len(b_ends) - 1)]
    return i, j + split


def cut(a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray, work: int) -> Iterator[dict]:
    """Pieces of about ``work`` ends each; a side's tokens and the offset where the first of them starts."""
    total = len(a) + len(b)
    i, j = crossings(a_ends, b_ends, np.arange(work, total, work))
    for n, (i0, i1, j0, j1) in enumerate(zip([0, *i], [*i, len(a)], [0, *j], [*j, len(b)])):
        starts = (int(ends[at - 1]) if at else 0 for ends, at in ((a_ends, i0), (b_ends, j0)))
        yield {"piece": n, "a": a[i0:i1], "a_start": next(starts), "b": b[j0:j1], "b_start": next(starts)}


def last_tokens(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the tokens of each side that end where one of the other side ends."""
    if not len(a_ends) or not len(b_ends):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    place = np.minimum(np.searchsorted(b_ends, a_ends), len(b_ends) - 1)
    a_last = np.flatnonzero(b_ends[place] == a_ends)
    return a_last, place[a_last]


@dataclass
class Groups:
    """Whole groups of a stretch of tokens, by the places of their last tokens on both sides."""

    a: np.ndarray
    b: np.ndarray
    a_last: np.ndarray
    b_last: np.ndarray

    def __post_init__(self):
        self.n = len(self.a_last)
        self.a_first, self.b_first = (np.concatenate([[0], last + 1]) for last in (self.a_last, self.b_last))
        self.a_size, self.b_size = np.diff(self.a_first), np.diff(self.b_first)
        self.a_of, self.b_of = (np.repeat(np.arange(self.n), size) for size in (self.a_size, self.b_size))
        self.links = self.a_size * self.b_size

    def texts(self, stops: np.ndarray, ids: int) -> list[str]:
        """The ids of both sides group by group; one text up to each group in ``stops``, without its last separator."""
        name = decimals(ids)
        out = np.empty(len(self.a) + len(self.b), dtype=object)
        for side, last, before, end in (
            (self.a, self.a_last, self.b_first[:-1][self.a_of], "|"), (self.b, self.b_last, self.a_first[1:][self.b_of], ";")
        ):
            place = np.arange(len(side)) + before
            out[place] = name[","][side]
            out[place[last]] = name[end][side[last]]
        ends = (self.a_first + self.b_first)[stops].tolist()
        flat = out.tolist()
        return ["".join(flat[start:end])[:-1] for start, end in zip([0, *ends], ends)]

    def overlaps(self, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Owners of groups, pairs of ids linked in their groups, and how often; by owner, then ids."""
        plain = self.links <= PLAIN_GROUP
        mine = np.flatnonzero(plain[self.a_of])
        each = self.b_size[self.a_of[mine]]
        left = np.repeat(mine, each)
        group = self.a_of[left]
        right = np.arange(len(left)) - np.repeat(np.cumsum(each) - each, each) + self.b_first[group]
        columns = [[owner[group]], [self.a[left]], [self.b[right]], [np.ones(len(left), dtype=np.int64)]]
        for g in np.flatnonzero(~plain):  # ids that repeat within a large group are counted before they are paired
            a, a_times = np.unique(self.a[self.a_first[g]: self.a_first[g + 1]], return_counts=True)
            b, b_times = np.unique(self.b[self.b_first[g]: self.b_first[g + 1]], return_counts=True)
            found = np.full(len(a) * len(b), owner[g]), np.repeat(a, len(b)), np.tile(b, len(a)), np.outer(a_times, b_times).ravel()
            for column, part in zip(columns, found):
                column.append(part)
        return added_up(*[np.concatenate(c).astype(np.int64) for c in columns])


def added_up(owner: np.ndarray, a: np.ndarray, b: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One row per owner and pair, in order, with the sum of ``times``."""
    if not len(owner):
        return owner, a, b, times
    b_span = int(b.max()) + 1
    a_span = int(a.max()) + 1
    key = (owner * a_span + a) * b_span + b  # owners are places in a batch, so this stays far below 2**63
    order = np.argsort(key, kind="stable") if (times > 1).any() else None
    key = key[order] if order is not None else np.sort(key)
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    total = np.add.reduceat(times[order], new) if order is not None else np.diff(np.append(new, len(key)))
    key = key[new]
    return key // (a_span * b_span), key // b_span % a_span, key % b_span, total


def overlap_lists(owners: int, owner: np.ndarray, a: np.ndarray, b: np.ndarray, times: np.ndarray) -> pa.Array:
    pairs = pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in (a, b, times)], fields=list(OVERLAP))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(owners + 1)).astype(np.int32)), pairs)


def batch(schema: dict[str, pa.DataType], **columns) -> pa.RecordBatch:
    """A batch in ``schema``; columns that aren't given are null."""
    rows = len(next(iter(columns.values())))
    arrays = []
    for name, kind in schema.items():
        given = columns.get(name)
        if given is None:
            arrays.append(pa.nulls(rows, kind))
        else:
            arrays.append(given if isinstance(given, pa.Array) else pa.array(given, kind))
    return pa.RecordBatch.from_arrays(arrays, schema=pa.schema(list(schema.items())))


def keys(rows: list[tuple]) -> dict[str, list]:
    return {"row": [row for row, _ in rows], "name": [name for _, name in rows]}


def merged(rows: list[tuple], tokens: list[tuple], ids: int, schema: dict) -> pa.RecordBatch:
    """One row per short document; all are merged as one, as documents end on both sides at once."""
    a, a_ends, b, b_ends = (np.concatenate(x) for x in zip(*tokens))
    before = np.cumsum([0, *[t[1][-1] for t in tokens]])
    a_ends = a_ends + np.repeat(before[:-1], [len(t[0]) for t in tokens])
    b_ends = b_ends + np.repeat(before[:-1], [len(t[2]) for t in tokens])
    groups = Groups(a, b, *last_tokens(a_ends, b_ends))
    stops = np.searchsorted(a_ends[groups.a_last], before[1:]) + 1
    firsts = np.concatenate([[0], stops[:-1]])
    owner = np.repeat(np.arange(len(rows)), stops - firsts)
    return batch(
        schema, **keys(rows), n_a=[len(t[0]) for t in tokens], n_b=[len(t[2]) for t in tokens], n_groups=stops - firsts,
        n_links=np.add.reduceat(groups.links, firsts), groups=groups.texts(stops, ids),
        overlaps=overlap_lists(len(rows), *groups.overlaps(owner)),
    )


def tokenized(batches: Iterator[pa.RecordBatch], a_path: str, b_path: str, work: int) -> Iterator[pa.RecordBatch]:
    """Aligned rows of short documents, and pieces of long ones (``piece`` is not null), from rows and texts."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    sides = both(a_path, b_path)
    schema = ROW | CUT
    for part in batches:
        rows, texts = list(zip(part.column(0).to_pylist(), part.column(1).to_pylist())), part.column(2).to_pylist()
        size = np.cumsum([0, *[len(text or "") for text in texts]])
        stops = [*np.searchsorted(size, np.arange(TEXT_BYTES, size[-1], TEXT_BYTES)).tolist(), len(rows)]
        for start, stop in zip([0, *stops], stops):
            yield from aligned_rows(rows[start:stop], texts[start:stop], sides, work, schema)


def aligned_rows(rows: list[tuple], texts: list[str | None], sides: Both, work: int, schema: dict) -> Iterator[pa.RecordBatch]:
    some = [i for i, text in enumerate(texts) if text]
    found = dict(zip(some, sides.encode([texts[i] for i in some])))
    bare = [row for i, row in enumerate(rows) if found.get(i) is None]
    if bare:
        zeros = [0] * len(bare)
        yield batch(schema, **keys(bare), n_a=zeros, n_b=zeros, n_groups=zeros, n_links=zeros, groups=[""] * len(bare), overlaps=[[]] * len(bare))
    short, tokens = [], []
    for i, ids in found.items():
        if ids is None:
            continue
        own = ids[0], np.cumsum(sides.a.length[ids[0]]), ids[1], np.cumsum(sides.b.length[ids[1]])
        if len(own[0]) + len(own[2]) > work:
            for piece in cut(*own, work):
                yield batch(schema, **keys([rows[i]]), **{name: [value] for name, value in piece.items()})
        else:
            short.append(rows[i])
            tokens.append(own)
    if short:
        yield merged(short, tokens, sides.ids, schema)


def numbers(column: pa.Array, i: int) -> np.ndarray:
    return column[i].values.to_numpy(zero_copy_only=False)


def merge_pieces(batches: Iterator[pa.RecordBatch], a_path: str, b_path: str) -> Iterator[pa.RecordBatch]:
    """Whole groups of each piece, and what lies open at its ends; a piece knows nothing of its neighbours."""
    schema = ROW | OPEN
    sides = both(a_path, b_path)
    for part in batches:
        given = dict(zip(part.schema.names, part.columns))
        rows = zip(given["row"].to_pylist(), given["name"].to_pylist())
        for i, (row, piece) in enumerate(zip(rows, given["piece"].to_pylist())):
            a, b = numbers(given["a"], i), numbers(given["b"], i)
            a_ends = np.cumsum(sides.a.length[a]) + given["a_start"][i].as_py()
            b_ends = np.cumsum(sides.b.length[b]) + given["b_start"][i].as_py()
            a_last, b_last = last_tokens(a_ends, b_ends)
            out = {**keys([row]), "piece": [piece], "closed": [len(a_last) > 0], "n_a": [len(a)], "n_b": [len(b)]}
            if not len(a_last):
                yield batch(schema, **out, head_a=[a], head_b=[b], tail_a=[[]], tail_b=[[]], n_groups=[0], n_links=[0], groups=[""],
                            overlaps=[[]])
                continue
            (a0, a1), (b0, b1) = ((last[0] + 1, last[-1] + 1) for last in (a_last, b_last))
            groups = Groups(a[a0:a1], b[b0:b1], a_last[1:] - a0, b_last[1:] - b0)
            text = groups.texts(np.array([groups.n]), sides.ids)
            yield batch(
                schema, **out, head_a=[a[:a0]], head_b=[b[:b0]], tail_a=[a[a1:]], tail_b=[b[b1:]], n_groups=[groups.n],
                n_links=[int(groups.links.sum())], groups=text,
                overlaps=overlap_lists(1, *groups.overlaps(np.zeros(groups.n, dtype=np.int64))),
            )


def stitch(table: pa.Table, ids: int) -> pa.Table:
    """One aligned row from the pieces of one document: open ends of neighbours make up the groups that were cut."""
    table = table.sort_by("piece").combine_chunks()
    given = {name: table.column(name).chunk(0) for name in table.column_names}
    texts, seams, open_a, open_b = [], [], [], []
    for i in range(table.num_rows):
        open_a.append(numbers(given["head_a"], i))
        open_b.append(numbers(given["head_b"], i))
        if given["closed"][i].as_py():
            seams.append((np.concatenate(open_a), np.concatenate(open_b)))
            open_a, open_b = [numbers(given["tail_a"], i)], [numbers(given["tail_b"], i)]
            texts.append(f"{','.join(map(str, seams[-1][0]))}|{','.join(map(str, seams[-1][1]))}")
            if given["groups"][i].as_py():
                texts.append(given["groups"][i].as_py())
    a, b = (np.concatenate([s[side] for s in seams]) for side in (0, 1))
    groups = Groups(a, b, *(np.cumsum([len(s[side]) for s in seams]) - 1 for side in (0, 1)))
    inside = given["overlaps"].flatten()
    found = [np.concatenate([x, y]) for x, y in zip(
        groups.overlaps(np.zeros(len(seams), dtype=np.int64)),
        [np.zeros(len(inside), dtype=np.int64), *[inside.field(f).to_numpy().astype(np.int64) for f in range(3)]],
    )]
    total = {name: [int(np.sum(given[name].to_numpy()))] for name in ("n_a", "n_b")}
    return pa.Table.from_batches([batch(
        ROW, row=[given["row"][0].as_py()], name=[given["name"][0].as_py()], **total, n_groups=[len(seams) + int(np.sum(given["n_groups"].to_numpy()))],
        n_links=[int(groups.links.sum() + np.sum(given["n_links"].to_numpy()))], groups=[";".join(texts)],
        overlaps=overlap_lists(1, *added_up(*found)),
    )])


def align(documents: DataFrame, scratch: Scratch, identity: str = "doc_id", text: str = "text", a: str = BYTE_LEVEL, b: str = PIECES, work: int = PIECE,
          shape: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """One row per row of ``documents``, told apart by ``row``: its id as text, ``name``, and the alignment of its tokens.

    ``n_a``, ``n_b``, ``n_groups``, ``n_links`` count tokens, groups and links; ``groups`` is ``a1,a2|b1;a3|b2,b3``, the ids of
    each group; ``overlaps`` holds each pair of ids that is linked, and how many times. A space stands before the
    text, for both sides. Null and empty texts, and those whose tokens of either side are not the bytes of the text, have
    no tokens: zeros, empty text, no overlaps. ``shape`` may drop or derive columns before the answer is stored. A group of any size is
    counted in full. Other columns are ignored; an empty table gives an empty one.
    """
    bounded_batches(documents.sparkSession)
    names = list(ROW)
    texts = documents.select(F.monotonically_increasing_id().alias("row"), col(identity).cast("string"), col(text).cast("string"))
    whole = texts.mapInArrow(lambda batches: tokenized(batches, a, b, work), f"{ROW_SCHEMA}, {CUT_SCHEMA}")
    stored = scratch.keep(shape(whole), "tokens")
    short = stored.where("piece is null").drop(*CUT)
    pieces = stored.where("piece is not null").select("row", "name", *CUT)
    if pieces.isEmpty():
        return short
    open_ended = pieces.mapInArrow(lambda batches: merge_pieces(batches, a, b), f"{ROW_SCHEMA}, {OPEN_SCHEMA}")
    long = open_ended.groupBy("row").applyInArrow(lambda table: stitch(table, both(a, b).ids), ROW_SCHEMA).select(*names)
    return short.unionByName(scratch.keep(shape(long), "stitched"))


def counted_pairs(aligned: DataFrame, scratch: Scratch) -> DataFrame:
    """Per pair of ids (``code``) in how many rows it is linked (``docs``), and whether no pair of its a id is in more."""
    pairs = aligned.select(F.explode("overlaps").alias("o")).select(code_of("o").alias("code")).groupBy("code").agg(F.count("*").alias("docs"))
    counts = scratch.keep(pairs, "counts")
    most = counts.groupBy(F.shiftright("code", 32).alias("a")).agg(F.max("docs").alias("most"))  # a row per id of a vocabulary
    return counts.withColumn("a", F.shiftright("code", 32)).join(F.broadcast(most), "a").select(
        "code", "docs", (F.col("docs") == F.col("most")).alias("best")
    )


def code_of(pair: str) -> F.Column:
    return F.shiftleft(F.col(f"{pair}.a").cast("bigint"), 32).bitwiseOR(F.col(f"{pair}.b").cast("bigint"))


def link_sums(aligned: DataFrame, scratch: Scratch, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """Per row with links: ``n_best``, links whose pair is in most documents of those of its a id, and ``count_sum``."""
    counts = scratch.keep(counted_pairs(aligned, scratch), "pairs")
    level = F.floor(F.log2("docs")).cast("int")
    levels = counts.groupBy(level.alias("level")).agg(F.count("*").alias("n")).orderBy(F.desc("level")).collect()  # 64 at most
    room, least, everything = hot_pairs, 64, True
    for r in levels:
        room -= r["n"]
        if room < 0:
            everything = False
            break
        least = r["level"]
    hot = counts.where(level >= least).select("code", "docs", "best")
    links = aligned.select("row", F.explode("overlaps").alias("o")).select("row", code_of("o").alias("code"), F.col("o.times").alias("times"))
    sums = F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("docs")).alias("count_sum")
    found = links.join(F.broadcast(hot), "code", "inner" if everything else "left")
    if everything:
        return found.groupBy("row").agg(*sums)
    rare = found.where("docs is null").select("row", "code", "times").join(counts.where(level < least), "code")
    parts = found.where("docs is not null").groupBy("row").agg(*sums).unionAll(rare.groupBy("row").agg(*sums))
    return parts.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def aligned_documents(documents: DataFrame, scratch: Scratch, identity: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Digest columns of every row of ``documents``; repeated rows and null ids are documents of their own."""
    hot_pairs = options.pop("hot_pairs", HOT_PAIRS)
    digest = F.when(F.col("groups") != "", F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    aligned = align(documents, scratch, identity, text, shape=lambda rows: rows.select("*", digest).drop("groups"), **options)
    sums = link_sums(aligned, scratch, hot_pairs)
    return aligned.drop("overlaps").join(sums, "row", "left").select(
        F.col("name").cast(documents.schema[identity].dataType).alias("doc_id"), "n_a", "n_b", "n_groups", "n_links",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_best", "count_sum")], "groups_sha256",
    )


def op13_merge_path_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of all documents under both tokenizers, aligned."""
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return aligned_documents(documents, Scratch(spark))

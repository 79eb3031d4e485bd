"""Benchmark passages in documents, found by spaced seeds.

A spaced seed is a fixed mask over consecutive words: words under a 1 are hashed together, words under a
0 are ignored, so a substituted word leaves the hits of every mask that ignores it. Hashes of benchmark
items and of documents are joined; around each hit the two texts are laid on one another and the
longest stretch that tolerates substitutions is measured.

Characters of scripts that are written without spaces are words of their own here, and spaces and punctuation of any
script end a word.

A benchmark of BLOCK_BYTES of text at most is sent to every task and documents stream past it, so they are never shuffled. A
larger one stays a table: its hashes are joined with those of the documents, of which a bitmap of bounded size lets
through only what the benchmark may hold, and only pairs that hit meet with their texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelmart.llm.store import Scratch, bounded_batches, col, free_name, text_of
from funnelmart.llm.words import U64, combined, hash_words

MASKS = ("1111011", "110110101", "1010011011", "1100100010111")  # weight 6; no two agree in more than half
LONGEST_MASK = max(map(len, MASKS))
SUBSTITUTED = 8  # items of so many words may differ in one; of two halves of them, one is then as it was
WINDOWS = tuple(range(1, 8))  # lengths of whole items below that, and of halves of items up to the longest mask
SPANS = (*[tuple(i for i, bit in enumerate(mask) if bit == "1") for mask in MASKS], *[tuple(range(n)) for n in WINDOWS])
BLOCK_BYTES = 16 << 20  # text of a benchmark that is sent to the tasks
FILTER_BITS = 20
SHARED_BITS = 26  # of the bitmap of a larger benchmark's hashes: 8 MB
BITMAP_BITS = 1 << 15  # that Spark's bitmap functions keep in one row
HOT_SHARE = 1 / 200  # hashes with more than this share of the documents' hits are joined by broadcast
HOT_ROWS = 1_000_000  # of the benchmark's hashes that are broadcast for that at most
# Thai to Myanmar, Khmer, kana, Han and its extensions
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3041-\u30fa\u30fc-\u30ff\u31f0-\u31ff\u3400-\u4dbf" \
    "\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
# spaces and marks beyond Latin-1: general punctuation, CJK, full-width forms
BREAKS = "\u1680\u2000-\u200a\u2010-\u205f\u3000-\u3004\u3008-\u3020\u30fb\ufe30-\ufe4f\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65"
SPECIAL = re.compile(f"([{UNSPACED}])|[{BREAKS}]")
RESULT = "array<struct<item_id: bigint, start: int, words: int, matched: int>>"


@dataclass(frozen=True)
class Rule:
    """What counts as an overlap: a stretch with ``matched`` equal words at least, or nearly the whole item.

    Within the stretch at least ``share`` of the words agree. Items of fewer than ``shortest`` words can't
    be told from chance and match nothing; items shorter than the longest mask match only as a whole, with one
    word substituted at most, and those of fewer than SUBSTITUTED words exactly.
    """

    matched: int = 12
    share: float = 0.8
    shortest: int = 5


def words_of(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The word hashes of each text, with unspaced scripts taken by character."""
    return hash_words([t if not t or t.isascii() else SPECIAL.sub(lambda m: f" {m[1] or ''} ", t) for t in texts])


def item_seeds(words: np.ndarray, rule: Rule) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(span, hashes, places) under which an item is found."""
    n = len(words)
    if n < rule.shortest:
        return
    for span in range(len(MASKS)):
        if n > max(SPANS[span]):
            found = combined(words, SPANS[span])
            yield span, found, np.arange(len(found))
    if n < LONGEST_MASK:
        half = n // 2
        for start, length in ((0, n),) if n < SUBSTITUTED else ((0, half), (half, n - half)):
            if length in WINDOWS:
                yield len(MASKS) + WINDOWS.index(length), combined(words[start: start + length], range(length)), np.array([start])


class Index:
    """Spaced hashes of some benchmark items, ready for lookup."""

    def __init__(self, items: list[tuple[int, str]], rule: Rule):
        self.rule = rule
        self.ids = [i for i, _ in items]
        self.words = list(words_of([t for _, t in items]))
        self.seeds: list[tuple[list[int], np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        found: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        for i, words in enumerate(self.words):
            for span, keys, place in item_seeds(words, rule):
                found.setdefault(span, []).append((keys, np.full(len(keys), i), place))
        for span, parts in sorted(found.items()):
            keys, owner, place = map(np.concatenate, zip(*parts))
            order = np.argsort(keys, kind="stable")
            present = np.zeros(1 << FILTER_BITS, dtype=bool)
            present[(keys >> U64(64 - FILTER_BITS)).astype(np.int64)] = True
            self.seeds.append((list(SPANS[span]), keys[order], owner[order], place[order], present))

    def overlaps(self, words: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(item, first word, words, equal words) of the best stretch of each item that overlaps."""
        lines: set[tuple[int, int]] = set()
        for offsets, keys, owner, place, present in self.seeds:
            if len(words) <= max(offsets):
                continue
            hashes = combined(words, offsets)
            at = np.flatnonzero(present[(hashes >> U64(64 - FILTER_BITS)).astype(np.int64)])
            if not len(at):
                continue
            low = np.searchsorted(keys, hashes[at], "left")
            high = np.searchsorted(keys, hashes[at], "right")
            for p, a, b in zip(at[high > low].tolist(), low[high > low].tolist(), high[high > low].tolist()):
                lines.update(zip(owner[a:b].tolist(), (p - place[a:b]).tolist()))
        shifts: dict[int, list[int]] = {}
        for item, shift in lines:
            shifts.setdefault(item, []).append(shift)
        best = {item: best_stretch(self.words[item], words, own, self.rule) for item, own in shifts.items()}
        return sorted((self.ids[i], *x) for i, x in best.items() if x)


def best_stretch(item: np.ndarray, words: np.ndarray, shifts: list[int], rule: Rule) -> tuple[int, int, int] | None:
    """(first word, words, equal words) of the stretch with the most equal words, the first of several."""
    found = [x for x in (stretch(item, words, shift, rule) for shift in shifts) if x]
    return min(found, key=lambda x: (-x[2], x[0], x[1]), default=None)


def stretch(item: np.ndarray, words: np.ndarray, shift: int, rule: Rule) -> tuple[int, int, int] | None:
    """Best stretch with ``item`` laid at ``shift``: an equal word counts 1, a substituted one -2."""
    a, b = max(0, -shift), min(len(item), len(words) - shift)
    equal = item[a:b] == words[a + shift: b + shift]
    running = np.concatenate(([0], np.cumsum(np.where(equal, 1, -2))))
    floor = np.minimum.accumulate(running)
    end = int(np.argmax(running - floor))
    start = int(np.argmin(running[: end + 1]))
    length, matched = end - start, int(equal[start:end].sum())
    # the whole item, if enough of it agrees
    if matched < rule.matched and equal.sum() >= rule.share * len(item):
        start, length, matched = 0, len(equal), int(equal.sum())
    enough = matched >= min(rule.matched, np.ceil(rule.share * len(item)))
    if not enough or matched < rule.share * length:
        return None
    if len(item) < LONGEST_MASK and matched < len(item) - (len(item) >= SUBSTITUTED):
        return None
    return a + shift + start, length, matched


def overlap_column(spark: SparkSession, items: list[tuple[int, str]], text: Column, rule: Rule) -> Column:
    sent = spark.sparkContext.broadcast(items)

    @F.pandas_udf(RESULT)
    def overlaps(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = Index(sent.value, rule)
        names = ("item_id", "start", "words", "matched")
        for texts in batches:
            yield pd.Series([
                [dict(zip(names, x)) for x in index.overlaps(words)] for words in words_of(texts.tolist())
            ], dtype=object)

    return overlaps(text)


def with_overlaps(documents: DataFrame, benchmark: DataFrame, name: str = "overlaps", text: str = "text",
                  item: str = "item_id", item_text: str = "text", rule: Rule = Rule(),
                  block_bytes: int = BLOCK_BYTES, scratch: Scratch | None = None) -> DataFrame:
    """``documents`` with the benchmark items each of them overlaps, at word positions, as column ``name``.

    Every document is searched in full and no hit is left out. Null and empty texts overlap nothing, as
    do null items; repeated items and repeated documents give the same answer each. An item that is found
    at several places is reported once, at its best stretch. An empty benchmark gives empty arrays.
    A column of ``documents`` with that name is replaced. ``scratch`` keeps what a benchmark beyond ``block_bytes`` needs.
    """
    spark = documents.sparkSession
    bounded_batches(spark)
    kept = [c for c in documents.columns if c.lower() != name.lower()]
    items = benchmark.select(col(item).cast("bigint").alias("id"), text_of(item_text).alias("text"))
    items = items.where("id is not null and text <> ''").distinct()
    if (items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) > block_bytes:
        return joined_overlaps(documents, items, name, text, kept, rule, scratch or Scratch(spark))
    block = sorted((r["id"], r["text"]) for r in items.collect())
    return documents.select(*map(col, kept), overlap_column(spark, block, text_of(text), rule).alias(name))


def bitmap_of(seeds: DataFrame) -> np.ndarray:
    """Which leading bits of hashes occur; put together by Spark, SHARED_BITS bits in all."""
    lead = seeds.select(F.shiftrightunsigned("seed", 64 - SHARED_BITS).alias("lead"))
    parts = lead.groupBy((F.floor(F.col("lead") / BITMAP_BITS)).alias("part")).agg(
        F.bitmap_construct_agg(F.pmod("lead", F.lit(BITMAP_BITS))).alias("bits")
    ).collect()
    present = np.zeros((1 << SHARED_BITS) // 8, dtype=np.uint8)
    for row in parts:
        at = row["part"] * BITMAP_BITS // 8
        present[at: at + len(row["bits"])] = np.frombuffer(row["bits"], dtype=np.uint8)
    return present


def joined_overlaps(documents: DataFrame, items: DataFrame, name: str, text: str, kept: list[str], rule: Rule,
                    scratch: Scratch) -> DataFrame:
    """``with_overlaps`` for a benchmark of any size: hashes of both sides meet in joins, then the texts of what hit.

    Hashes that hold a large share of the documents' hits meet the benchmark's rows of just those in a broadcast.
    """
    spark = documents.sparkSession
    row = free_name(documents, "_row")
    items = scratch.keep(items.select(F.monotonically_increasing_id().alias("item"), "id", "text"), "items")
    docs = scratch.keep(documents.select(*map(col, documents.columns), F.monotonically_increasing_id().alias(row)), "documents")

    def seeds_of_items(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for own, words in zip(pdf["item"], words_of(pdf["text"].tolist())):
                for span, keys, place in item_seeds(words, rule):
                    yield pd.DataFrame({"span": span, "seed": keys.view(np.int64), "item": own, "item_place": place})

    seeds = scratch.keep(items.mapInPandas(seeds_of_items, "span int, seed bigint, item bigint, item_place int"), "item_seeds")
    used = sorted(r["span"] for r in seeds.select("span").distinct().collect())
    sent = spark.sparkContext.broadcast(bitmap_of(seeds))

    def seeds_of_documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        present = sent.value
        for pdf in batches:
            for own, words in zip(pdf[row], words_of(pdf["text"].tolist())):
                for span in used:
                    if len(words) > max(SPANS[span]):
                        keys = combined(words, SPANS[span])
                        lead = keys >> U64(64 - SHARED_BITS)
                        at = np.flatnonzero(present[(lead >> U64(3)).astype(np.int64)] >> (lead & U64(7)).astype(np.uint8) & 1)
                        if len(at):
                            yield pd.DataFrame({"span": span, "seed": keys[at].view(np.int64), row: own, "place": at})

    texts = docs.select(row, text_of(text).alias("text"))
    hits = scratch.keep(texts.mapInPandas(seeds_of_documents, f"span int, seed bigint, `{row}` bigint, place int"), "hits")
    hot = hits.stat.freqItems(["seed"], HOT_SHARE).first()["seed_freqItems"] or []
    hot_seeds = seeds.where(F.col("seed").isin(hot))
    if not hot or hot_seeds.count() > HOT_ROWS:
        met = hits.join(seeds, ["span", "seed"])
    else:
        met = hits.where(~F.col("seed").isin(hot)).join(seeds, ["span", "seed"]).unionByName(
            hits.where(F.col("seed").isin(hot)).join(F.broadcast(hot_seeds), ["span", "seed"])
        )
    shifts = met.groupBy(row, "item").agg(F.collect_set(F.col("place") - F.col("item_place")).alias("shifts"))
    found = scratch.keep(shifts.join(items, "item"), "candidates")

    def verify(hit: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(hit) or not len(own):
            return pd.DataFrame({row: [], name: []})
        words = next(iter(words_of(own["text"].tolist())))
        best = [
            (item, *one) for item, places, item_words in zip(hit["id"], hit["shifts"], words_of(hit["text"].tolist()))
            if (one := best_stretch(item_words, words, list(places), rule))
        ]
        names = ("item_id", "start", "words", "matched")
        return pd.DataFrame({row: [own[row].iloc[0]], name: [[dict(zip(names, x)) for x in sorted(best)]]})

    asked = texts.join(found.select(row).distinct(), row, "left_semi")
    overlaps = found.groupBy(row).cogroup(asked.groupBy(row)).applyInPandas(verify, f"`{row}` bigint, `{name}` {RESULT}")
    none = F.array().cast(RESULT)
    return docs.select(*map(col, kept), row).join(overlaps, row, "left").select(*map(col, kept), F.coalesce(col(name), none).alias(name))


def without_overlaps(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that overlap no benchmark item, in the columns given."""
    name = free_name(documents, "_overlaps")
    clean = with_overlaps(documents, benchmark, name, **options).where(F.size(name) == 0)
    return clean.select(*map(col, documents.columns))


def op3_spaced_seed_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document and benchmark item that overlap."""
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    found = with_overlaps(documents, spark.read.parquet(f"{folder}/benchmark.parquet"))
    return found.select("doc_id", F.explode("overlaps").alias("hit")).select(
        "doc_id", "hit.item_id", "hit.start", "hit.words", "hit.matched"
    )

"""Near-duplicate documents by consistent weighted sampling of TF-IDF shingles.

A document is a weighted set: each run of five words counts with its frequency times its inverse
document frequency. Improved consistent weighted sampling draws from each set samples that agree between
two sets with a probability equal to their weighted Jaccard similarity. Samples are banded; documents
that agree in a band are compared exactly, and pairs at or above the threshold are links. Linked
documents form classes.

Document frequencies count every document as one, or every large group of near copies as one: then what a group's
members share isn't taken for common phrases, and their similarity does not depend on how many they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from funnelmart.llm.components import components
from funnelmart.llm.store import Scratch, bounded_batches, broadcast_if, col, free_name, text_of
from funnelmart.llm.words import U64, hash_words, mixed, shingles

WORDS = 5  # words of a shingle
SIMILARITY = 0.8
BANDS, SAMPLES = 10, 4  # a pair at 0.8 is missed in all bands with a probability of 0.5 %, at 0.9 of 3e-5 %
CLASS_BITS = 20  # shingles are counted in this many hash classes, so the counts have a fixed size
LEAST_SHARE = 1 / 500  # shingles in fewer documents weigh alike; it lies well above the load of a class
SLICE = 1 << 14  # counters in one row of a partial count
PIVOTS = 4  # members of a candidate group that all others are compared with first
FINE = 128  # samples by which candidates are told from others before texts are compared
LIKELY = 86  # of them must agree; at a similarity of 0.8 fewer do with a chance of 0.05 %
BLOCK = 512  # members of a group compared with as many others in one task
SLACK = 1e-9  # for rounding, on a distance
BROADCAST_ROWS = 500_000
TABLE_BITS = 16
COLUMNS = 1 << 11  # shingles sampled at a time

GROUP_BANDS, GROUP_HASHES = 4, 3  # smallest hashes by which large groups of near copies are told
LARGE_SHARE = 1 / 1000  # groups below this share of all documents cannot lift a shingle above LEAST_SHARE
UNIT = 1 << 20  # a whole document in the counts, which are whole numbers so that their sum has no order
HOT_SHARE = 1 / 200  # classes with more than this share of the documents are looked up in a broadcast

STEP = 0x9E3779B97F4A7C15


@lru_cache(1)
def sampling_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Quantiles of Gamma(2, 1), their inverses and logarithms, and of the uniform distribution."""
    share = (np.arange(1 << TABLE_BITS) + 0.5) / (1 << TABLE_BITS)
    low, high = np.zeros_like(share), np.full_like(share, 60.0)
    for _ in range(60):
        middle = (low + high) / 2
        below = 1 - np.exp(-middle) * (1 + middle) < share
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    gamma = ((low + high) / 2).astype(np.float32)
    return gamma, 1 / gamma, np.log(gamma), share.astype(np.float32)


def sample(keys: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """``n`` consistent weighted samples of a set: ``keys`` in ascending order with positive weights.

    For each sample and key, r and c are Gamma(2, 1) and b uniform, drawn by hashing. The key with the
    smallest ln c - r (t - b + 1), t = floor(ln w / r + b), is taken together with its t.
    """
    gamma, inverse, log_gamma, uniform = sampling_tables()
    rows = mixed(np.arange(1, n + 1, dtype=U64) * U64(STEP)) | U64(1)
    best = np.full(n, np.inf, dtype=np.float32)
    out = np.zeros(n, dtype=U64)
    low16 = U64(0xFFFF)
    for at in range(0, len(keys), COLUMNS):
        part, log_w = keys[at: at + COLUMNS], np.log(weights[at: at + COLUMNS]).astype(np.float32)
        x = part[None, :] * rows[:, None]
        x ^= x >> U64(31)
        x *= U64(0xD6E8FEB86659FD93)
        r_at = (x >> U64(48)).astype(np.intp)
        r, b = gamma[r_at], uniform[((x >> U64(16)) & low16).astype(np.intp)]
        t = np.floor(log_w[None, :] * inverse[r_at] + b)
        value = log_gamma[((x >> U64(32)) & low16).astype(np.intp)] - r * (t - b + 1)
        winner = np.argmin(value, axis=1)
        line = np.arange(n)
        better = value[line, winner] < best
        chosen, level = part[winner], t[line, winner].astype(np.int64).view(U64)
        out = np.where(better, mixed(chosen + level * U64(STEP)), out)
        best = np.where(better, value[line, winner], best)
    return out


class Weights:
    """Inverse document frequencies by class of shingle."""

    def __init__(self, counts: np.ndarray, documents: float, shingled: float):
        load = shingled / len(counts)  # what a class holds on average of shingles that don't matter
        self.idf = idf = np.asarray(counts - load, dtype=np.float64)  # in place: the driver holds few copies
        idf /= max(documents, 1)
        np.subtract(1, np.log(np.clip(idf, LEAST_SHARE, 1.0, out=idf), out=idf), out=idf)
        self._sent: Broadcast | None = None

    def sent(self, spark: SparkSession) -> Broadcast:
        """These weights on the executors; sent once, whatever the number of uses."""
        if self._sent is None:
            self._sent = spark.sparkContext.broadcast(self)
        return self._sent

    def of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The weighted set of a document: shingles in ascending order, and their weights."""
        keys, times = np.unique(shingles(words, WORDS), return_counts=True)
        return keys, times * self.idf[class_of(keys)]


def share_of(keys: np.ndarray, sizes: dict[int, int]) -> int:
    """What a document counts, in UNIT parts; all of it where there are no groups."""
    if not sizes:
        return UNIT
    return max(1, UNIT // max([sizes.get(key, 1) for key in group_keys(keys).tolist()]))


def class_of(keys: np.ndarray) -> np.ndarray:
    return (keys >> U64(64 - CLASS_BITS)).astype(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity; 0 if a set is empty."""
    total = a[1].sum() + b[1].sum()
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = np.minimum(a[1][i], b[1][j]).sum()
    return float(shared / (total - shared)) if total else 0.0


def group_keys(keys: np.ndarray) -> np.ndarray:
    """One hash per band, of the smallest hashes of a set; near copies agree in most bands, other documents in none."""
    rows = mixed(np.arange(1, GROUP_BANDS * GROUP_HASHES + 1, dtype=U64) * U64(STEP + 2))
    least = np.full(len(rows), np.iinfo(np.uint64).max, dtype=U64)
    for at in range(0, len(keys), COLUMNS):
        least = np.minimum(least, mixed(keys[None, at: at + COLUMNS] ^ rows[:, None]).min(axis=1))
    return mixed((least.reshape(GROUP_BANDS, GROUP_HASHES) * rows.reshape(GROUP_BANDS, GROUP_HASHES)).sum(axis=1)).view(np.int64)


def large_groups(documents: DataFrame, text: str, scratch: Scratch) -> dict[int, int]:
    """Sizes of the bands' groups with LARGE_SHARE of all documents or more, so some thousands of them at most."""

    def bands(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [group_keys(np.unique(shingles(w, WORDS))) for w in hash_words(pdf["text"].tolist()) if len(w)]
            if found:
                yield pd.DataFrame({"key": np.concatenate(found)})

    keys = documents.select(text_of(text).alias("text")).mapInPandas(bands, "key bigint")
    counted = scratch.keep(keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "groups")
    least = max(2, documents.count() * LARGE_SHARE)
    return {r["key"]: r["n"] for r in counted.where(F.col("n") >= least).collect()}


def count_shingles(documents: DataFrame, text: str, groups: dict[int, int] | None = None) -> Weights:
    """Document frequencies over all documents; one pass, partial counts of a fixed size per task.

    A document in one of ``groups`` counts as its share of the largest of its groups.
    """
    sent = documents.sparkSession.sparkContext.broadcast(groups or {})

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, seen = np.zeros(1 << CLASS_BITS, dtype=np.int64), 0
        sizes = sent.value
        for pdf in batches:
            found = [np.unique(shingles(w, WORDS)) for w in hash_words(pdf["text"].tolist()) if len(w)]
            weights = [share_of(keys, sizes) for keys in found]
            seen += sum(weights)
            for weight in set(weights):
                same = [class_of(keys) for keys, own in zip(found, weights) if own == weight]
                counts += weight * np.bincount(np.concatenate(same), minlength=len(counts))
        for at in range(0, len(counts), SLICE):
            part = counts[at: at + SLICE]
            if part.any():
                yield pd.DataFrame({"slice": [at // SLICE], "counts": [part.tobytes()], "seen": [0]})
        yield pd.DataFrame({"slice": [-1], "counts": [b""], "seen": [seen]})

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        summed = sum((np.frombuffer(x, dtype=np.int64) for x in pdf["counts"] if x), np.zeros(SLICE, np.int64))
        return pd.DataFrame({
            "slice": [pdf["slice"].iloc[0]], "counts": [summed.tobytes()], "seen": [pdf["seen"].sum()],
        })

    schema = "slice int, counts binary, seen bigint"
    parts = documents.select(text_of(text).alias("text")).mapInPandas(partial, schema)
    # two levels, so that no task adds up the counts of all others
    halfway = parts.withColumn("part", F.spark_partition_id() % 64).groupBy("part", "slice").applyInPandas(total, schema)
    found = halfway.groupBy("slice").applyInPandas(total, schema).collect()
    counts, seen = np.zeros(1 << CLASS_BITS, dtype=np.int64), 0
    for row in found:
        if row["slice"] >= 0:
            counts[row["slice"] * SLICE: (row["slice"] + 1) * SLICE] = np.frombuffer(row["counts"], np.int64)
        seen += row["seen"]
    return Weights(counts / UNIT, seen / UNIT, counts.sum() / UNIT)


def signatures(stored: DataFrame, row: str, text: str, weights: Weights) -> DataFrame:
    """Per document with words: its row, a key of its words in order, and its samples."""
    sent = weights.sent(stored.sparkSession)

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows, first, second, samples = [], [], [], []
            for at, words in zip(pdf["row"].tolist(), hash_words(pdf["text"].tolist())):
                if not len(words):
                    continue
                spots = mixed(np.arange(1, len(words) + 1, dtype=U64))
                rows.append(at)
                first.append(int(mixed(words ^ spots).sum().astype(np.int64)))
                second.append(int(mixed(words * (spots | U64(1))).sum().astype(np.int64)))
                drawn = sample(*sent.value.of(words), BANDS * SAMPLES)
                samples.append((drawn >> U64(32)).astype(np.uint32).view(np.int32))
            yield pd.DataFrame({"row": rows, "key_a": first, "key_b": second, "samples": samples})

    return stored.select(F.col(row).alias("row"), text_of(text).alias("text")).mapInPandas(
        sign, "row bigint, key_a bigint, key_b bigint, samples array<int>"
    )


def compare(pairs: DataFrame, texts: DataFrame, weights: Weights) -> DataFrame:
    """``pairs`` (a, b) with their exact similarity, as ``sim``; ``texts`` has ``row`` and ``text``."""
    sent = weights.sent(texts.sparkSession)
    full = (
        pairs.select("a", "b").join(texts.select(F.col("row").alias("b"), F.col("text").alias("text_b")), "b")
        .join(texts.select(F.col("row").alias("a"), F.col("text").alias("text_a")), "a")
        .select("a", "b", "text_a", "text_b")
    )

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, known = None, None  # rows of one a often follow each other
        for pdf in batches:
            sims = []
            for a, text_a, words in zip(pdf["a"], pdf["text_a"], hash_words(pdf["text_b"].tolist())):
                if a != last:
                    last, known = a, sent.value.of(next(hash_words([text_a])))
                sims.append(similarity(known, sent.value.of(words)))
            yield pd.DataFrame({"a": pdf["a"], "b": pdf["b"], "sim": sims})

    return full.mapInPandas(measure, "a bigint, b bigint, sim double")


def fine_samples(texts: DataFrame, weights: Weights) -> DataFrame:
    """``row`` and FINE samples of each of these documents (``row``, ``text``)."""
    sent = weights.sent(texts.sparkSession)

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            drawn = [
                (sample(*sent.value.of(words), FINE) >> U64(32)).astype(np.uint32).view(np.int32)
                for words in hash_words(pdf["text"].tolist())
            ]
            yield pd.DataFrame({"row": pdf["row"], "fine": drawn})

    return texts.mapInPandas(draw, "row bigint, fine array<int>")


def agreeing(pairs: DataFrame, fine: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with ``agree``, the number of equal samples, where that is LIKELY or more."""
    a = fine.select(F.col("row").alias("a"), F.col("fine").alias("fine_a"))
    b = fine.select(F.col("row").alias("b"), F.col("fine").alias("fine_b"))
    same = F.aggregate(
        F.zip_with("fine_a", "fine_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x
    )
    return pairs.join(a, "a").join(b, "b").select("a", "b", same.alias("agree")).where(F.col("agree") >= LIKELY)


def links_across(placed: DataFrame, fine: DataFrame, texts: DataFrame, weights: Weights, threshold: float) -> DataFrame:
    """Links (a, b) between members of different parts of the same group, enough to join the parts.

    ``placed`` has ``grp``, ``member`` and ``part``, ``fine`` also the groups of each member. Members outside
    a group's largest part are compared with all members of the group, in blocks: a task gets some BLOCK of either, and
    each text once. Pairs that agree in enough samples are compared exactly, those that agree most first, unless
    links have joined them already. A pair that shares several groups is compared in the first.
    """
    sizes = placed.groupBy("grp", "part").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("grp").agg(
        F.max(F.struct("n", "part")).alias("top"), F.sum("n").alias("all")
    ).select("grp", F.col("top.part").alias("top"), "all", (F.col("all") - F.col("top.n")).alias("few")).where("few > 0")
    blocks = largest.select(
        "grp", "top", F.ceil(F.col("few") / BLOCK).alias("ys"), F.ceil(F.col("all") / BLOCK).alias("xs")
    )
    split = placed.join(blocks, "grp")
    rows = split.select(F.col("member").alias("row")).distinct()
    known = fine.join(texts.join(broadcast_if(rows, BROADCAST_ROWS), "row", "left_semi"), "row")
    first = F.lit(0).cast("bigint")
    ys = split.where("part <> top").select(
        "grp", F.lit(True).alias("asks"), "member", "part", F.pmod(F.xxhash64("member"), "ys").alias("y"),
        F.explode(F.sequence(first, F.col("xs") - 1)).alias("x"),
    )
    xs = split.select(
        "grp", F.lit(False).alias("asks"), "member", "part",
        F.explode(F.sequence(first, F.col("ys") - 1)).alias("y"), F.pmod(F.xxhash64("member"), "xs").alias("x"),
    )
    sent = weights.sent(texts.sparkSession)

    def compare_blocks(pdf: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"a": [], "b": []}, dtype=np.int64)
        asks = pdf["asks"].to_numpy()
        if not asks.any() or asks.all():
            return none
        y, x = pdf[asks], pdf[~asks]
        one, two = np.stack(y["fine"].to_list()), np.stack(x["fine"].to_list())
        agree = np.zeros((len(y), len(x)), dtype=np.uint8)
        for i in range(one.shape[1]):
            agree += one[:, i, None] == two[None, :, i]
        i, j = np.nonzero((agree >= LIKELY) & (y["part"].to_numpy()[:, None] != x["part"].to_numpy()[None, :]))
        shared = np.stack(y["groups"].to_list())[i] == np.stack(x["groups"].to_list())[j]
        here = np.stack(y["groups"].to_list())[i, shared.argmax(axis=1)] == pdf["grp"].iloc[0]
        i, j = i[here], j[here]
        order = np.argsort(-agree[i, j].astype(int), kind="stable")
        parent: dict[int, int] = {}

        def root(n: int) -> int:
            while parent.get(n, n) != n:
                n = parent[n]
            return n

        sets: dict[int, tuple] = {}

        def weighted(n: int, text: str) -> tuple:
            if n not in sets:
                sets[n] = sent.value.of(next(hash_words([text])))
            return sets[n]

        y_at, x_at = [list(zip(f["member"].tolist(), f["part"].tolist(), f["text"])) for f in (y, x)]
        found = []
        for p, q in zip(i[order].tolist(), j[order].tolist()):
            (a, part_a, text_a), (b, part_b, text_b) = y_at[p], x_at[q]
            u, v = root(part_a), root(part_b)
            if u != v and similarity(weighted(a, text_a), weighted(b, text_b)) >= threshold:
                parent[max(u, v)] = min(u, v)
                found.append((min(a, b), max(a, b)))
        return pd.DataFrame(found, columns=["a", "b"]) if found else none

    dealt = ys.unionAll(xs).join(known.withColumnRenamed("row", "member"), "member")
    return dealt.groupBy("grp", "y", "x").applyInPandas(compare_blocks, "a bigint, b bigint").distinct()


class Linker:
    """Finds links among candidates, and keeps the components they form."""

    def __init__(self, stored: DataFrame, row: str, text: str, weights: Weights, threshold: float, scratch: Scratch):
        self.texts = stored.select(F.col(row).alias("row"), text_of(text).alias("text"))
        self.weights, self.threshold, self.scratch = weights, threshold, scratch
        self.parts: DataFrame | None = None

    def component(self, rows: DataFrame, name: str, out: str) -> DataFrame:
        """``rows`` with the component of the node in column ``name``."""
        if self.parts is None:
            return rows.withColumn(out, F.col(name))
        parts = self.parts.select(F.col("node").alias(name), F.col("component").alias("_component"))
        return rows.join(parts, name, "left").withColumn(out, F.coalesce("_component", name)).drop("_component")

    def apart(self, pairs: DataFrame) -> DataFrame:
        """The ``pairs`` (a, b) whose ends are in different components."""
        return self.component(self.component(pairs, "a", "_a"), "b", "_b").where("_a <> _b").drop("_a", "_b")

    def texts_of(self, rows: DataFrame) -> DataFrame:
        """The texts of these rows (``row``)."""
        return self.texts.join(broadcast_if(rows, BROADCAST_ROWS), "row", "left_semi")

    def verify(self, pairs: DataFrame) -> DataFrame:
        """Compare ``pairs`` (a, b) exactly and take those in reach as links; the pairs compared."""
        pairs = self.scratch.keep(pairs.select("a", "b"), "pairs")
        if pairs.isEmpty():
            return pairs
        texts = self.texts_of(pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct())
        measured = self.scratch.keep(compare(pairs, texts, self.weights), "measured")
        self.add(measured.where(F.col("sim") >= self.threshold).select("a", "b"))
        return pairs

    def add(self, links: DataFrame) -> None:
        """Join the components that these links (a, b) connect; earlier links are not gone through again."""
        if links.isEmpty():
            return
        if self.parts is None:
            self.parts = self.scratch.keep(components(links, self.scratch), "parts")
            return
        between = self.component(self.component(links, "a", "_a"), "b", "_b")
        between = between.select(F.col("_a").alias("a"), F.col("_b").alias("b"))
        joined = self.scratch.keep(components(between, self.scratch), "joined")
        found = joined.select(F.col("node").alias("component"), F.col("component").alias("_joined"))
        moved = self.parts.join(found, "component", "left").select(
            "node", F.coalesce("_joined", "component").alias("component")
        )
        new = joined.join(self.parts, "node", "left_anti").select("node", "component")
        self.parts = self.scratch.keep(moved.unionAll(new), "parts")

    def link(self, likely: DataFrame) -> None:
        """Compare likely pairs (a, b, agree), unless their ends are joined already.

        First every b is compared with the a it agrees with most; that settles nearly all. Then come all
        pairs whose ends are still apart.
        """
        rank = F.row_number().over(W.partitionBy("b").orderBy(F.desc("agree"), "a"))
        tried = self.verify(self.apart(likely).withColumn("rank", rank).where("rank = 1"))
        self.verify(self.apart(likely).join(tried, ["a", "b"], "left_anti"))


def link_groups(all_groups: DataFrame, linker: Linker, scratch: Scratch) -> None:
    """Link the members of candidate groups so that no class is split; each ``row`` has its ``groups``.

    Every member of a group is first compared with the group's pivots, members that share most candidates
    with others and so lie amid the near copies. That joins a group of n near copies at the cost of n
    comparisons, not n * n / 2. Where a group still falls into parts, all its members outside the largest
    part are compared with all others in blocks, by samples and, where those agree, by text. So every
    pair of candidates that isn't joined by others is compared, whatever the size of its group.
    """
    grouped = all_groups.select(F.explode("groups").alias("grp"), F.col("row").alias("member"))
    sized = grouped.groupBy("grp").agg(F.count("*").alias("n")).where("n > 1")
    members = scratch.keep(grouped.join(sized, "grp"), "members")
    if members.isEmpty():
        return
    rows = members.select(F.col("member").alias("row")).distinct()
    fine = fine_samples(linker.texts_of(rows), linker.weights).join(all_groups, "row")
    fine = scratch.keep(fine, "fine")
    central = members.groupBy("member").agg(F.sum("n").alias("met"))
    rank = F.row_number().over(W.partitionBy("grp").orderBy(F.desc("met"), "member"))
    heads = members.join(central, "member").select("grp", "member", "met", rank.alias("rank"))
    heads = heads.where(F.col("rank") <= PIVOTS).select("grp", F.col("member").alias("head"))
    pairs = members.select("grp", "member").join(heads, "grp").where("head <> member")
    pairs = pairs.select(F.least("head", "member").alias("a"), F.greatest("head", "member").alias("b")).distinct()
    linker.link(scratch.keep(agreeing(pairs, fine), "likely"))
    large = members.where(F.col("n") > PIVOTS + 1).select("grp", "member")
    placed = scratch.keep(linker.component(large, "member", "part"), "placed")
    across = links_across(placed, fine, linker.texts, linker.weights, linker.threshold)
    linker.add(scratch.keep(across, "across"))


def with_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str) -> DataFrame:
    """``rows`` with the columns of their group; groups that hold much of all rows, 1 / HOT_SHARE at most, are broadcast."""
    total = groups.agg(F.sum(size)).first()[0] or 0
    hot = F.broadcast(groups.where(F.col(size) > max(1, total * HOT_SHARE)))
    others = rows.join(hot.select(*keys), keys, "left_anti").join(groups, keys)
    return rows.join(hot, keys).unionByName(others)


def classes(stored: DataFrame, row: str, scratch: Scratch, text: str = "text", threshold: float = SIMILARITY,
            by_group: bool = False) -> DataFrame:
    """``row`` and ``class``, the smallest row of its class, for every stored document with words."""
    bounded_batches(stored.sparkSession)
    weights = count_shingles(stored, text, large_groups(stored, text, scratch) if by_group else None)
    signed = scratch.keep(signatures(stored, row, text, weights), "signatures")
    firsts = scratch.keep(
        signed.groupBy("key_a", "key_b").agg(F.min("row").alias("first"), F.count("*").alias("n")), "firsts"
    )
    keyed = signed.select("row", "key_a", "key_b")
    copies = scratch.keep(with_groups(keyed, firsts, ["key_a", "key_b"], "n").select("row", "first"), "copies")
    distinct = signed.join(copies.where("row = first").select("row"), "row", "left_semi").select("row", "samples")
    distinct = scratch.keep(distinct, "distinct")
    bands = [F.xxhash64(F.lit(i), F.slice("samples", 1 + i * SAMPLES, SAMPLES)) for i in range(BANDS)]
    linker = Linker(stored, row, text, weights, threshold, scratch)
    link_groups(distinct.select("row", F.array(*bands).alias("groups")), linker, scratch)
    found = copies.withColumnRenamed("first", "node")
    return linker.component(found, "node", "class").select("row", "class")


def decide(documents: DataFrame, scratch: Scratch, text: str, identity: str, threshold: float,
           by_group: bool) -> tuple[DataFrame, DataFrame, str]:
    """The stored documents, their class by row, and the name of the row column."""
    row = free_name(documents, "_row")
    stored = scratch.keep(documents.withColumn(row, F.monotonically_increasing_id()), "documents")
    found = classes(stored, row, scratch, text, threshold, by_group)
    placed = stored.select(F.col(row).alias("row"), col(identity).alias("id")).join(found, "row", "left")
    placed = scratch.keep(placed.withColumn("class", F.coalesce("class", "row")), "placed")
    best = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))
    chosen = scratch.keep(placed.groupBy("class").agg(best.alias("best"), F.count("*").alias("class_size")), "chosen")
    decided = with_groups(placed, chosen, ["class"], "class_size").select(
        F.col("row").alias(row), F.col("best.id").alias("class_id"), "class_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
    )
    return stored, decided, row


def near_duplicates(documents: DataFrame, scratch: Scratch, text: str = "text", identity: str = "doc_id",
                    threshold: float = SIMILARITY, by_group: bool = False) -> DataFrame:
    """``documents`` with ``class_id``, ``class_size`` and ``kept``.

    Documents whose weighted Jaccard similarity reaches ``threshold`` are linked, and linked documents are
    one class. ``class_id`` is the smallest id in the class; ``kept`` is true for exactly one document of
    each class, that with the smallest id (of repeated ids the first row stored). Texts that differ only
    in case, spacing and ASCII punctuation are equal. Documents without words, null texts among them, are
    each a class of their own. Null ids come last. Empty input gives no rows. Input columns named like an
    added one are replaced. ``by_group`` counts large groups of near copies once in the document frequencies.
    """
    columns = [c for c in documents.columns if c.lower() not in ("class_id", "class_size", "kept")]
    stored, decided, row = decide(documents.select(*map(col, columns)), scratch, text, identity, threshold, by_group)
    return stored.join(decided, row).drop(row)


def one_of_each(documents: DataFrame, scratch: Scratch, text: str = "text", identity: str = "doc_id",
                threshold: float = SIMILARITY, by_group: bool = False) -> DataFrame:
    """One document of each class, in the columns given."""
    stored, decided, row = decide(documents, scratch, text, identity, threshold, by_group)
    return stored.join(decided.where("kept").select(row), row, "left_semi").drop(row)


def op9_icws_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The class of every document."""
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return near_duplicates(documents, Scratch(spark), by_group=True).select("doc_id", "class_id", "class_size", "kept")

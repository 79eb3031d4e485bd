"""Near-duplicate vectors by a robust-pruned flat graph.

Vectors of a label are dealt to overlapping cells around centroids. In each cell a graph is built: from its
nearest candidates every vector keeps those that no kept one stands in for (robust pruning). The
adjacency lists that a vector got in its cells are united. A search starts at the medoid of a cell, goes
greedily toward the query, and once in range expands everything in range. What it finds is verified in
double precision.

Where vectors lie dense, centroids do too, and a group of near vectors is cut into many cells that a few overlaps
don't join. Vectors close to their centroid, the core, are therefore kept out of the graph: whatever lies within the
angle of the threshold plus that of the core from a centroid is compared exactly with the core around it, which
misses no pair. Recall is audited against brute force; if it is too low, cells overlap more, and if that does not
help, all vectors of a label are compared.

A link that any search in any cell finds, in either direction, is a link of both ends: what is found is brought together as
pairs before it is counted. A vector outside the core has few of them, for where it had many there would be a centroid.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelmart.llm.components import components
from funnelmart.llm.store import Scratch, broadcast_if, col

COSINE = 0.93
SAMPLE = 20_000  # vectors that centroids are fitted on
MOST_CENTROIDS = 4_000
CELL = 1_000  # vectors a cell is meant to hold
CHUNK = 1_024  # larger cells are cut into graphs of this size, and searched in all of them
OVERLAP = 2  # cells a vector lies in
DEGREE, CANDIDATES, LINKS_ABROAD = 24, 64, 16
ALPHA = 1.2
BEAM = 32
SLACK = 0.08  # nodes this far out of range are expanded too
STEP = 8  # nodes a query expands at a time
QUERIES = 512  # queries searched at a time
AUDIT_EVERY = 50  # the audit takes its queries among ids divisible by this first, then among others by a hash
AUDIT_QUERIES = 256  # at first; four times as many until ENOUGH_LINKS true links of theirs were seen
AUDIT_MOST = 4_096
ENOUGH_LINKS = 200
ASKING = 4_096  # vectors of a cell that search in one task
LEAST_RECALL = 0.99
DEMANDED_RECALL = 0.9  # below it there is no answer
CORE = 0.8  # vectors with this cosine to their centroid are compared exactly
BLOCK = 4_096  # of the core, and of those it is compared with, in one task
BROADCAST_ROWS = 200_000


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; first by their largest component, so squares don't overflow."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def centroids_of(sample: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Spherical k-means, a few rounds."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), min(n, len(sample)), replace=False)]
    for _ in range(8):
        nearest = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 1e-12, sums / np.maximum(size, 1e-12), centres)
    return centres


def medoids_of(vectors: np.ndarray, sims: np.ndarray) -> np.ndarray:
    """The vector nearest to the mean, and far ones after it, so that search starts near any region."""
    starts = [int((vectors @ vectors.mean(axis=0)).argmax())]
    nearest = sims[starts[0]].copy()
    for _ in range(min(7, len(vectors) - 1)):
        starts.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, sims[starts[-1]])
    return np.array(starts)


def build_graph(vectors: np.ndarray) -> list[np.ndarray]:
    """Neighbours of each vector by robust pruning; every vector can be reached from the medoid."""
    n = len(vectors)
    sims = vectors @ vectors.T
    np.fill_diagonal(sims, -2.0)
    k = min(CANDIDATES, n - 1)
    if k < 1:
        return [np.empty(0, dtype=np.int64) for _ in range(n)]
    pool = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    rng = np.random.default_rng(n)
    pool = np.concatenate([pool, rng.integers(0, n, (n, min(LINKS_ABROAD, n)))], axis=1)
    line = np.arange(n)[:, None]
    pool = np.take_along_axis(pool, np.argsort(-sims[line, pool], axis=1, kind="stable"), axis=1)
    near = sims[line, pool]
    alive = near > -2.0
    far = np.sqrt(np.maximum(2 - 2 * near, 0))
    kept = np.full((n, DEGREE), -1, dtype=np.int64)
    for slot in range(DEGREE):
        first = alive.argmax(axis=1)
        some = alive[np.arange(n), first]
        chosen = pool[np.arange(n), first]
        kept[some, slot] = chosen[some]
        between = np.sqrt(np.maximum(2 - 2 * sims[chosen[:, None], pool], 0))
        between[chosen[:, None] == pool] = 0.0
        alive &= ~((ALPHA * between <= far) | (pool == chosen[:, None])) & some[:, None]
        if not alive.any():
            break
    lists = [set(row[row >= 0].tolist()) for row in kept]
    for a, row in enumerate(kept):  # links go both ways
        for b in row[row >= 0].tolist():
            if len(lists[b]) < 2 * DEGREE:
                lists[b].add(a)
    reached = np.zeros(n, dtype=bool)
    stack = medoids_of(vectors, sims).tolist()
    while True:
        while stack:
            a = stack.pop()
            if not reached[a]:
                reached[a] = True
                stack.extend(b for b in lists[a] if not reached[b])
        if reached.all():
            break
        lost = int(np.flatnonzero(~reached)[0])
        door = int(np.where(reached, sims[lost], -3.0).argmax())
        lists[door].add(lost)
        stack.append(lost)
    return [np.array(sorted(x), dtype=np.int64) for x in lists]


def search(queries: np.ndarray, own: np.ndarray, vectors: np.ndarray, lists: list[np.ndarray],
           threshold: float) -> np.ndarray:
    """Which vectors each query finds in range, as a matrix.

    ``own`` is the query's place among the vectors, or -1; a query that is a node starts there too. All
    queries walk in step. The best known nodes are expanded first; a walk ends when every node in range, or
    nearly so, and the BEAM best nodes have been expanded.
    """
    n, degree = len(vectors), max(1, max(map(len, lists)))
    table = np.full((n, degree), n)
    for a, row in enumerate(lists):
        table[a, : len(row)] = row
    sims = np.full((len(queries), n + 1), -3.0)  # of known nodes; the last column stands for none
    todo = np.full((len(queries), n + 1), -3.0)  # of known nodes that are not expanded
    starts = medoids_of(vectors, vectors @ vectors.T)
    sims[:, starts] = queries @ vectors[starts].T
    todo[:, starts] = sims[:, starts]
    inside = np.flatnonzero(own >= 0)
    sims[inside, own[inside]] = (queries[inside] * vectors[own[inside]]).sum(axis=1)
    todo[inside, own[inside]] = sims[inside, own[inside]]
    active = np.arange(len(queries))
    padded = np.concatenate([vectors, np.zeros((1, vectors.shape[1]))])
    step, beam = min(STEP, n), min(BEAM, n)
    while len(active):
        best = np.argpartition(-todo[active], step - 1, axis=1)[:, :step]
        value = np.take_along_axis(todo[active], best, axis=1)
        bar = -np.partition(-sims[active], beam - 1, axis=1)[:, beam - 1]
        use = (value > -3.0) & ((value >= threshold - SLACK) | (value >= bar[:, None]))
        going = use.any(axis=1)
        active, best, use = active[going], best[going], use[going]
        if not len(active):
            break
        rows = np.repeat(active, step)[use.ravel()]
        nodes = best.ravel()[use.ravel()]
        todo[rows, nodes] = -3.0
        who, found = np.repeat(rows, degree), table[nodes].ravel()
        fresh = (found < n) & (sims[who, found] <= -3.0)
        who, found = who[fresh], found[fresh]
        code = np.unique(who * (n + 1) + found)
        who, found = code // (n + 1), code % (n + 1)
        got = np.einsum("ij,ij->i", queries[who], padded[found])
        sims[who, found] = got
        todo[who, found] = got
    return sims[:, :n] >= threshold


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest of ``n`` nodes that each reaches by the links a-b."""
    root = np.arange(n)
    while True:
        lower = root.copy()
        np.minimum.at(lower, a, root[b])
        np.minimum.at(lower, b, root[a])
        lower = lower[lower]
        if (lower == root).all():
            return root
        root = lower


def distinct_vectors(rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Usable vectors as nodes: equal vectors of a label are one node with a count; and the node of each row.

    ``rows`` has ``row``, ``vec``, ``label``. A vector is usable if its label is not null, no component is null, NaN
    or infinite, and one is not zero.
    """
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("vec", lambda x: x != 0.0)
    usable = rows.where(F.col("label").isNotNull() & F.col("vec").isNotNull()).where(~bad & some)
    keyed = usable.select(
        "row", "label", "vec", F.xxhash64("label", "vec").alias("key_a"),
        F.xxhash64(F.lit(1), F.size("vec"), F.reverse("vec"), "label").alias("key_b"),
    )
    nodes = keyed.groupBy("key_a", "key_b").agg(
        F.min("row").alias("node"), F.count("*").alias("times"), F.first("label").alias("label"), F.first("vec").alias("vec")
    )
    nodes = scratch.keep(nodes, "nodes")
    of_rows = keyed.select("row", "key_a", "key_b").join(
        broadcast_if(nodes.select("key_a", "key_b", "node", "times"), BROADCAST_ROWS), ["key_a", "key_b"]
    )
    return nodes.drop("key_a", "key_b").withColumn("size", F.size("vec")), of_rows.select("row", "node", "times")


def fit_centroids(nodes: DataFrame) -> dict[tuple[str, int], np.ndarray]:
    """Centroids by label and dimension, from at most SAMPLE vectors chosen by a hash of their node."""
    counts = {(r["label"], r["size"]): r["n"] for r in nodes.groupBy("label", "size").agg(F.count("*").alias("n"))
              .orderBy(F.desc("n")).limit(MOST_CENTROIDS).collect()}
    total = max(1, sum(counts.values()))
    sample: dict[tuple[str, int], list] = {}
    for r in nodes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("label", "size", "vec").collect():
        sample.setdefault((r["label"], r["size"]), []).append(r["vec"])
    out = {}
    for key, vectors in sample.items():
        n = counts.get(key, len(vectors))
        wanted = min(-(-n // CELL), max(1, MOST_CENTROIDS * n // total), max(1, len(vectors) // 4))
        out[key] = centroids_of(unit(np.array(vectors, dtype=np.float64)), wanted)
    return out


def regions_of(centroids: dict, threshold: float) -> dict[tuple[str, int], np.ndarray]:
    """The region of each centroid; centroids in range of one another are in one region."""
    return {
        key: local_roots(len(centres), *np.nonzero(centres @ centres.T >= threshold)) for key, centres in centroids.items()
    }


def cells_of(nodes: DataFrame, centroids: dict, overlap: int, threshold: float, everything: bool = False) -> DataFrame:
    """``nodes`` with ``cells``, ``region`` and ``visits``.

    A vector of the core has no cells but the ``region`` of its nearest centroid; any other has the ``overlap`` nearest
    cells, nearest first. ``visits`` are the regions whose core may hold vectors in range. ``everything`` makes
    all vectors of a label and dimension one region.
    """
    sent = nodes.sparkSession.sparkContext.broadcast((centroids, regions_of(centroids, threshold)))
    reach = np.cos(min(np.pi, np.arccos(np.clip(threshold, -1, 1)) + np.arccos(np.clip(CORE, -1, 1)))) - 1e-9

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, known_regions = sent.value
        for pdf in batches:
            cells: list[list[str]] = [[] for _ in range(len(pdf))]
            region: list[str | None] = [None] * len(pdf)
            visits: list[list[str]] = [[] for _ in range(len(pdf))]
            for (label, size), rows in pdf.groupby(["label", "size"]).indices.items():
                name, centres = f"{label}/{size}/", known.get((label, size))
                for part in (rows[at: at + QUERIES] for at in range(0, len(rows), QUERIES)):
                    if everything:
                        for i in part:
                            region[i], visits[i] = name + "all", [name + "all"]
                        continue
                    if centres is None or len(centres) == 1:
                        for i in part:
                            cells[i] = [name + "0"]
                        continue
                    sims = unit(np.array(pdf["vec"].iloc[part].tolist(), dtype=np.float64)) @ centres.T
                    order = np.argsort(-sims, axis=1, kind="stable")[:, :overlap]
                    for i, line, near in zip(part, sims, order):
                        if line[near[0]] >= CORE:
                            region[i] = name + str(known_regions[label, size][near[0]])
                        else:
                            cells[i] = [name + str(c) for c in near]
                        if line[near[0]] >= reach:
                            visits[i] = [name + str(r) for r in np.unique(known_regions[label, size][line >= reach])]
            yield pdf.assign(cells=cells, region=region, visits=visits)

    return nodes.mapInPandas(
        assign, "node bigint, times bigint, label string, vec array<double>, size int, cells array<string>, "
        "region string, visits array<string>"
    )


def core_links(placed: DataFrame, threshold: float, scratch: Scratch) -> DataFrame | None:
    """All links of which one end at least is in a core, as ``node``, ``n`` and ``root``; by blocks of a region."""
    core = placed.where("region is not null")
    sizes = scratch.keep(
        core.groupBy("region").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("targets")), "regions"
    )
    if sizes.isEmpty():
        return None
    visiting = placed.select("node", F.explode("visits").alias("region"))
    sizes = scratch.keep(sizes.join(
        visiting.groupBy("region").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "region"
    ), "blocks")
    sizes = broadcast_if(sizes, BROADCAST_ROWS)
    own = F.col("region").isNotNull().alias("core")
    asks = placed.select("node", "times", "vec", own, F.explode("visits").alias("region")).join(sizes, "region").select(
        "region", F.explode(F.sequence(F.lit(0), F.col("targets") - 1)).alias("target"),
        F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("block"), F.lit(True).alias("asks"), "node", "times", "vec", "core",
    )
    asked = core.select("region", "node", "times", "vec", own).join(sizes, "region").select(
        "region", F.pmod(F.xxhash64("node"), "targets").cast("int").alias("target"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(False).alias("asks"), "node", "times", "vec", "core",
    )

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        q, t = pdf[pdf["asks"]], pdf[~pdf["asks"]]
        ids = np.concatenate([q["node"].to_numpy(), t["node"].to_numpy()]).astype(np.int64)
        total, roots = np.zeros(len(ids), np.int64), np.arange(len(ids))
        if len(q) and len(t):
            ones, others = (unit(np.array(f["vec"].tolist(), dtype=np.float64)) for f in (q, t))
            outside = ~q["core"].to_numpy(dtype=bool)  # is no target anywhere, so its links count for both ends
            q_times, t_times = q["times"].to_numpy(), t["times"].to_numpy()
            for at in range(0, len(q), QUERIES):
                block = slice(at, at + QUERIES)
                hits = ones[block] @ others.T >= threshold
                hits &= ids[: len(q)][block][:, None] != ids[len(q):][None, :]
                total[: len(q)][block] += hits @ t_times
                total[len(q):] += (q_times[block] * outside[block]) @ hits
                a, b = np.nonzero(hits)
                every = np.arange(len(ids))
                roots = local_roots(len(ids), np.concatenate([every, a + at]), np.concatenate([roots, b + len(q)]))
        return pd.DataFrame({"node": ids, "n": total, "root": ids[roots]})

    return scratch.keep(
        asks.unionAll(asked).groupBy("region", "target", "block").applyInPandas(compare, "node bigint, n bigint, root bigint"),
        "core",
    )


def links(nodes: DataFrame, centroids: dict, overlap: int, threshold: float, scratch: Scratch,
          everything: bool = False) -> tuple[DataFrame, DataFrame]:
    """Links per node (``node``, ``n``) counted with copies, and edges (a, b) that join what is linked."""
    placed = scratch.keep(cells_of(nodes, centroids, overlap, threshold, everything), "cells")
    exact = core_links(placed, threshold, scratch)
    member = placed.drop("region", "visits").withColumn("cell", F.explode("cells")).drop("cells")
    sizes = scratch.keep(
        member.groupBy("cell").agg(F.count("*").alias("n")).select(
            "cell", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"), F.ceil(F.col("n") / ASKING).cast("int").alias("blocks")
        ), "sizes",
    )
    member = scratch.keep(
        member.join(broadcast_if(sizes, BROADCAST_ROWS), "cell")
        .withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")), "members",
    )

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        ids = pdf["node"].to_numpy()
        graph = build_graph(unit(np.array(pdf["vec"].tolist(), dtype=np.float64)))
        return pd.DataFrame({"node": ids, "near": [ids[x].tolist() for x in graph]})

    built = member.select("cell", "chunk", "node", "vec").groupBy("cell", "chunk").applyInPandas(
        build, "node bigint, near array<bigint>"
    )
    united = scratch.keep(
        built.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "graph"
    )

    def find(pdf: pd.DataFrame) -> pd.DataFrame:
        """Pairs in range of one block of a cell's vectors and one chunk of them, the smaller node first."""
        asks, inside = pdf[pdf["asks"]], pdf[~pdf["asks"]]
        found = [np.empty((0, 4), dtype=np.int64)]
        if len(asks) and len(inside):
            vectors = unit(np.array(inside["vec"].tolist(), dtype=np.float64))
            ids, times = inside["node"].to_numpy(), inside["times"].to_numpy()
            place = {int(v): i for i, v in enumerate(ids)}
            lists = [np.array([place[x] for x in near if x in place], dtype=np.int64) for near in inside["near"]]
            for at in range(0, len(asks), QUERIES):
                block = asks.iloc[at: at + QUERIES]
                own, own_times = block["node"].to_numpy(), block["times"].to_numpy()
                places = np.array([place.get(x, -1) for x in own.tolist()])
                a, b = np.nonzero(search(unit(np.array(block["vec"].tolist(), dtype=np.float64)), places, vectors, lists, threshold))
                a, b = a[own[a] != ids[b]], b[own[a] != ids[b]]
                swap = own[a] > ids[b]
                ends = np.where(swap, ids[b], own[a]), np.where(swap, own[a], ids[b])
                counts = np.where(swap, times[b], own_times[a]), np.where(swap, own_times[a], times[b])
                found.append(np.stack([*ends, *counts], axis=1))
        return pd.DataFrame(np.unique(np.concatenate(found), axis=0), columns=["a", "b", "a_times", "b_times"])

    keys = ["cell", "target", "block"]
    asking = member.select(
        "cell", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("target"),
        F.pmod(F.xxhash64("node", F.lit(1)), "blocks").cast("int").alias("block"), F.lit(True).alias("asks"), "node", "times", "vec",
        F.lit(None).cast("array<bigint>").alias("near"),
    )
    asked = member.join(united, "node").select(
        "cell", F.col("chunk").alias("target"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.lit(False).alias("asks"), "node", "times", "vec", "near",
    )
    pairs = asking.unionAll(asked).groupBy(keys).applyInPandas(find, "a bigint, b bigint, a_times bigint, b_times bigint")
    pairs = scratch.keep(pairs.distinct(), "pairs")
    counted = pairs.select("a", F.col("b_times").alias("n")).unionAll(pairs.select("b", "a_times"))
    counted = counted.select(F.col("a").alias("node"), "n")
    edges = pairs.select("a", "b")
    if exact is not None:
        counted = counted.unionAll(exact.select("node", "n"))
        edges = edges.unionAll(exact.where("node <> root").select("node", "root"))
    return counted.groupBy("node").agg(F.sum("n").alias("n")), edges


def true_links(nodes: DataFrame, asked: list, threshold: float) -> dict[int, int]:
    """Links of each node in ``asked`` (AUDIT_MOST rows at most), by brute force against all nodes."""
    groups: dict[tuple[str, int], list] = {}
    for r in asked:
        groups.setdefault((r["label"], r["size"]), []).append((r["node"], r["vec"]))
    ready = {
        key: (np.array([i for i, _ in rows]), unit(np.array([v for _, v in rows], dtype=np.float64))) for key, rows in groups.items()
    }
    sent = nodes.sparkSession.sparkContext.broadcast(ready)

    def brute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for key, part in pdf.groupby(["label", "size"]):
                if key in sent.value:
                    ids, vectors = sent.value[key]
                    hits = unit(np.array(part["vec"].tolist(), dtype=np.float64)) @ vectors.T >= threshold
                    hits &= part["node"].to_numpy()[:, None] != ids[None, :]
                    yield pd.DataFrame({"node": ids, "n": (hits * part["times"].to_numpy()[:, None]).sum(axis=0)})

    counted = nodes.select("node", "times", "label", "size", "vec").mapInPandas(brute, "node bigint, n bigint")
    return {r["node"]: r["n"] for r in counted.groupBy("node").agg(F.sum("n").alias("n")).collect()}


def audited(nodes: DataFrame, ranked: DataFrame, threshold: float) -> dict[int, int]:
    """True links of the nodes that the audit looks at: more of them until enough links were seen.

    ``ranked`` has every ``node`` and ``later``, which is 1 for nodes that are asked after all others.
    """
    wanted = AUDIT_QUERIES
    order = ranked.orderBy("later", F.xxhash64("node"), "node")
    while True:
        asked = order.limit(wanted).join(nodes, "node").select("node", "label", "size", "vec").collect()
        truth = true_links(nodes, asked, threshold) if asked else {}
        if sum(truth.values()) >= ENOUGH_LINKS or len(asked) < wanted or wanted >= AUDIT_MOST:
            return truth
        wanted = min(4 * wanted, AUDIT_MOST)


def recall_of(counted: DataFrame, truth: dict[int, int]) -> float | None:
    """Share of the true links that were found; None where there are none, so that nothing was measured.

    The lower of the share of all links and of the mean share of a query, so that neither many links of a few
    queries nor many queries of few links hide what others lack.
    """
    linked = {node: n for node, n in truth.items() if n}
    if not linked:
        return None
    found = {r["node"]: r["n"] for r in counted.where(F.col("node").isin(list(linked))).collect()}
    shares = [min(found.get(node, 0), n) / n for node, n in linked.items()]
    return min(sum(min(found.get(node, 0), n) for node, n in linked.items()) / sum(linked.values()), sum(shares) / len(shares))


def linked_vectors(vectors: DataFrame, scratch: Scratch, identity: str = "vec_id", vector: str = "embedding",
                   label: str = "label", threshold: float = COSINE) -> DataFrame:
    """Per row: ``vec_id``, ``n_links``, ``component_id``, ``kept`` and ``recall``, the audited share of links found.

    ``recall`` is null where none of the audited vectors has a link, so that there was nothing to measure.

    Rows link when labels are equal and not null and the cosine reaches ``threshold``. Vectors that are null, empty or
    zero, or hold null, NaN or infinite components, link with nothing, as do those of different dimensions.
    Repeated rows are vectors of their own that link with each other. ``component_id`` is the smallest id
    reachable, null ids last. Empty input gives no rows; other columns are ignored. A recall below LEAST_RECALL
    has cells overlap more and in the end all vectors of a label compared; one below DEMANDED_RECALL is an error.
    """
    rows = scratch.keep(
        vectors.select(
            col(identity).cast("bigint").alias("vec_id"), col(vector).cast("array<double>").alias("vec"),
            col(label).cast("string").alias("label"),
        ).withColumn("row", F.monotonically_increasing_id()), "rows",
    )
    nodes, of_rows = distinct_vectors(rows.select("row", "vec", "label"), scratch)
    nodes = nodes.select("node", "times", "label", "vec", "size")
    centroids = fit_centroids(nodes)
    of_rows = scratch.keep(of_rows, "of_rows")
    later = F.when(F.col("vec_id") % AUDIT_EVERY == 0, 0).otherwise(1)
    ranked = scratch.keep(rows.select("row", later.alias("later")).join(of_rows, "row").groupBy("node").agg(F.min("later").alias("later")), "ranked")
    truth = audited(nodes, ranked, threshold)
    overlap, known, everything = OVERLAP, -1.0, False
    while True:
        counted, edges = links(nodes, centroids, overlap, threshold, scratch, everything)
        recall = recall_of(counted, truth)
        if recall is None or recall >= LEAST_RECALL or everything:
            break
        everything = overlap >= 4 * OVERLAP or recall <= known
        known, overlap = recall, 2 * overlap
    if recall is not None and recall < DEMANDED_RECALL:
        raise RuntimeError(f"only {recall:.3f} of the audited links were found")

    reached = components(edges, scratch)
    per_node = counted.join(reached, "node", "left").select("node", "n", "component")
    placed = rows.select("row", "vec_id").join(of_rows, "row", "left").join(per_node, "node", "left").select(
        "row", "vec_id", (F.coalesce("n", F.lit(0)) + F.coalesce(F.col("times") - 1, F.lit(0))).alias("n_links"),
        F.coalesce("component", "node", "row").alias("component"),
    )
    placed = scratch.keep(placed, "placed")
    least = placed.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    return placed.join(least, "component").select(
        "vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
        F.lit(recall).cast("double").alias("recall"),
    )


def op5_pruned_graph_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of all embeddings."""
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label")
    return linked_vectors(vectors, Scratch(spark))

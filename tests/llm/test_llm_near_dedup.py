from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

import numpy as np

from funnelmart.llm import near_dedup as nd
from funnelmart.llm.components import components
from funnelmart.llm.words import hash_words


def corpus(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, common = [], " ".join(rng.choice(vocabulary) for _ in range(60))
    for i in range(120):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(30, 200))]
        rows.append((len(rows), (common + " " if i % 3 == 0 else "") + " ".join(words), "s"))
        for _ in range(rng.choice([0, 0, 1, 2, 12])):
            changed = list(words)
            for _ in range(rng.choice([0, 1, 1, 2, 4, 9])):
                changed[rng.randrange(len(changed))] = rng.choice(vocabulary)
            rows.append((len(rows), (common + " " if i % 3 == 0 else "") + " ".join(changed), "s"))
    return rows


def weights_of(texts):
    counts, seen = np.zeros(1 << nd.CLASS_BITS, dtype=np.int64), 0
    for words in hash_words(texts):
        if len(words):
            seen += 1
            np.add.at(counts, nd.class_of(np.unique(nd.shingles(words, nd.WORDS))), 1)
    return nd.Weights(counts, seen, int(counts.sum()))


def brute(rows, threshold=nd.SIMILARITY):
    """Smallest id reachable by pairs at or above the threshold, by comparing all pairs."""
    weights = weights_of([t for _, t, _ in rows])
    sets = [weights.of(words) for words in hash_words([t for _, t, _ in rows])]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if nd.similarity(sets[a], sets[b]) >= threshold:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {rows[i][0]: rows[find(i)][0] for i in range(len(rows))}


def test_classes_agree_with_all_pairs(documents, scratch):
    rows = corpus()
    found = nd.near_duplicates(documents(rows), scratch).collect()
    assert {r["doc_id"]: r["class_id"] for r in found} == brute(rows)
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in found)


def test_large_group_of_near_copies(documents, scratch):
    rng = random.Random(5)
    words = [f"w{rng.randrange(900)}" for _ in range(300)]
    rows = []
    for i in range(150):
        changed = list(words)
        for _ in range(i % 9):
            changed[rng.randrange(300)] = f"x{rng.randrange(900)}"
        rows.append((i, " ".join(changed), "s"))
    found = nd.near_duplicates(documents(rows), scratch).collect()
    assert {r["doc_id"]: r["class_id"] for r in found} == brute(rows)


def test_samples_agree_as_often_as_sets_are_similar():
    weights = weights_of([])
    weights.idf = 1 + np.random.default_rng(0).random(1 << nd.CLASS_BITS) * 5
    rng = random.Random(2)
    a = [f"w{rng.randrange(5000)}" for _ in range(300)]
    b = [w if rng.random() > 0.02 else "zz" for w in a]
    x, y = [weights.of(w) for w in hash_words([" ".join(a), " ".join(b)])]
    agree = (nd.sample(*x, 2000) == nd.sample(*y, 2000)).mean()
    assert abs(agree - nd.similarity(x, y)) < 0.04


def test_odd_rows(odd, scratch):
    found = nd.near_duplicates(odd, scratch)
    assert set(odd.columns) < set(found.columns)
    rows = found.collect()
    assert len(rows) == odd.count()
    ones = [r for r in rows if r["text"] == "one"]
    assert sorted(r["kept"] for r in ones) == [False, True] and {r["class_size"] for r in ones} == {2}
    assert all(r["kept"] for r in rows if r["text"] != "one")  # texts without words stay apart


def test_one_of_each_keeps_columns(documents, odd, scratch):
    kept = nd.one_of_each(odd, scratch)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 1
    same = documents([(i, "Same text, of some words here!" if i % 2 else "same TEXT of some words here", "s") for i in range(40)])
    assert [r["doc_id"] for r in nd.one_of_each(same, scratch).collect()] == [0]


def test_empty_table(documents, scratch):
    assert nd.near_duplicates(documents([(1, "a", "s")]).where("false"), scratch).count() == 0


def test_components_of_chains_and_stars(spark, scratch):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(3, 3), (None, 4), (210, 6)]
    found = components(spark.createDataFrame(links, "a bigint, b bigint"), scratch).collect()
    by_node = {r["node"]: r["component"] for r in found}
    assert len(found) == len(by_node)
    assert all(by_node[i] == 100 for i in range(100, 141))
    assert all(by_node[i] == 6 for i in (6, 7, *range(200, 260)))


def grouped_weights(texts):
    """Frequencies in which a document in a group of many equal smallest hashes counts as its share of it."""
    sets = [np.unique(nd.shingles(w, nd.WORDS)) for w in hash_words(texts) if len(w)]
    bands = [nd.group_keys(keys).tolist() for keys in sets]
    sizes = Counter(key for own in bands for key in own)
    least = max(2, len(texts) * nd.LARGE_SHARE)
    counts, seen = np.zeros(1 << nd.CLASS_BITS, dtype=np.int64), 0
    for keys, own in zip(sets, bands):
        share = max(1, nd.UNIT // max([sizes[key] if sizes[key] >= least else 1 for key in own]))
        np.add.at(counts, nd.class_of(keys), share)
        seen += share
    return nd.Weights(counts / nd.UNIT, seen / nd.UNIT, counts.sum() / nd.UNIT)


def test_a_group_of_a_third_of_all_rows_stays_one_class(documents, scratch, monkeypatch):
    """Members that differ by a word or two, at a plain similarity above 0.8, are one class however many they are."""
    rng = random.Random(12)
    base = [f"w{rng.randrange(5000)}" for _ in range(100)]
    rows = []
    for i in range(400):
        if i % 3 == 0:
            words = list(base)
            words[rng.randrange(8, 92)] = f"x{i}"
        else:
            words = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(60, 140))]
        rows.append((i, " ".join(words), "s"))
    plain = nd.near_duplicates(documents(rows), scratch).where("kept").count()
    found = nd.near_duplicates(documents(rows), scratch, by_group=True).collect()
    monkeypatch.setitem(globals(), "weights_of", grouped_weights)
    assert {r["doc_id"]: r["class_id"] for r in found} == brute(rows)
    assert {r["class_id"] for r in found if r["doc_id"] % 3 == 0} == {0}
    assert plain > sum(r["kept"] for r in found) == 400 - 133


def test_classes_by_group_agree_with_all_pairs(documents, scratch, monkeypatch):
    rows = corpus(4)
    found = nd.near_duplicates(documents(rows), scratch, by_group=True).collect()
    monkeypatch.setitem(globals(), "weights_of", grouped_weights)
    assert {r["doc_id"]: r["class_id"] for r in found} == brute(rows)


def test_registered_query_agrees_with_all_pairs(spark, monkeypatch):
    folder = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"], "s") for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    found = {r["doc_id"]: r["class_id"] for r in nd.op9_icws_near_dedup(spark, folder).collect()}
    monkeypatch.setitem(globals(), "weights_of", grouped_weights)
    assert found == brute(rows)


def test_hot_copies_are_looked_up_by_broadcast(spark, documents, scratch, capsys):
    rows = documents([(i, "the very same text of some words" if i % 3 else f"text number {i} of its own", "s") for i in range(300)])
    groups = rows.groupBy("text").count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = nd.with_groups(rows, groups, ["text"], "count")
        joined.explain("formatted")
        assert joined.where("count = 200").count() == 200 and joined.count() == 300
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))
    assert "BroadcastHashJoin" in capsys.readouterr().out


def test_joined_links_are_not_gone_through_again(spark, scratch, monkeypatch):
    given = []

    def counted(links, own):
        given.append(links.where("a <> b").count())
        return components(links, own)

    monkeypatch.setattr(nd, "components", counted)
    linker = nd.Linker(spark.createDataFrame([], "row bigint, text string"), "row", "text", None, nd.SIMILARITY, scratch)
    for links in ([(i, i + 1) for i in range(10)] + [(40, 41)], [(3, 8), (9, 20), (12, 30), (30, 31)], [(5, 31), (41, 2)]):
        linker.add(spark.createDataFrame(links, "a bigint, b bigint"))
    assert given == [11, 3, 2]
    parts = [tuple(r) for r in linker.parts.select("node", "component").collect()]
    assert sorted(parts) == [(i, 0) for i in [*range(11), 12, 20, 30, 31, 40, 41]]


def test_weights_are_sent_once(spark, scratch, documents, monkeypatch):
    sent, broadcast = [], type(spark.sparkContext).broadcast
    monkeypatch.setattr(
        type(spark.sparkContext), "broadcast", lambda self, value: (sent.append(type(value)), broadcast(self, value))[1]
    )
    nd.near_duplicates(documents(corpus()), scratch).count()
    assert sent.count(nd.Weights) == 1

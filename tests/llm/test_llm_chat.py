from __future__ import annotations

import hashlib
import random
import time
from collections import defaultdict

from pyspark.sql import functions as F

from funnelmart.llm.chat import as_replies, conversations, escape, read_back, text_under_loss, unescape
from funnelmart.llm.queries import QUERIES

MESSAGES = "node bigint, parent bigint, role string, text string, score double, leaf string, depth int"


def messages(spark, rows):
    return spark.createDataFrame([(*r, "x", 9) for r in rows], MESSAGES).repartition(3)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def best_paths(rows, keep=1):
    """Per root the best branches as lists of nodes, by walking every path."""
    by_node = {r[0]: r for r in rows}
    children = defaultdict(list)
    roots = []
    for node, parent, *_ in rows:
        if parent is None or parent not in by_node or parent == node:
            roots.append(node)
        else:
            children[parent].append(node)
    out = {}

    def walk(path):
        if not children[path[-1]]:
            yield path
        for child in children[path[-1]]:
            yield from walk([*path, child])

    for root in roots:
        paths = [(-sum(by_node[n][4] or 0 for n in p) / len(p), p[-1], p) for p in walk([root])]
        out[root] = [p for *_, p in sorted(paths)[:keep]]
    return out


def test_best_branches_agree_with_walking_all_paths(spark, scratch):
    rng = random.Random(3)
    rows = []
    for i in range(200):
        parent = rng.choice(rows)[0] if rows and rng.random() < 0.93 else None
        role = "assistant" if rng.random() < 0.5 else "user"
        rows.append((i, parent, role, f"t{i} </turn> \\e <turn > é𝒳" if i % 3 else None, rng.randrange(64) / 64))
    expected = best_paths(rows, 2)
    found = conversations(messages(spark, rows), scratch, keep=2).withColumn("turns", read_back(F.col("formatted"))) \
        .withColumn("learned", text_under_loss(F.col("formatted"), F.col("loss"))).collect()
    got = defaultdict(dict)
    for r in found:
        got[r["root"]][r["rank"]] = r
    assert set(got) == set(expected)
    for root, paths in expected.items():
        assert len(got[root]) == len(paths)
        for rank, path in enumerate(paths, 1):
            r = got[root][rank]
            assert r["leaf"] == path[-1] and r["n_turns"] == len(path)
            assert [(t["role"], t["text"]) for t in r["turns"]] == [(rows[n][2], rows[n][3] or "") for n in path]
            assert r["learned"] == "".join(rows[n][3] or "" for n in path if rows[n][2] == "assistant")


def test_deep_chain(spark, scratch):
    rows = [(i, i - 1 if i else None, "assistant", f"{i} ", 1.0) for i in range(1000)]
    found = conversations(messages(spark, rows), scratch).select(
        "n_turns", text_under_loss(F.col("formatted"), F.col("loss")).alias("learned")).collect()
    assert [(r["n_turns"], r["learned"]) for r in found] == [(1000, "".join(f"{i} " for i in range(1000)))]


def test_odd_messages(spark, scratch):
    rows = [
        (None, 1, "user", "left out", 1.0), (1, None, None, None, None), (2, 1, "a>b\\", "x", 0.0), (3, 99, "user", "orphan", 0.0),
        (4, 4, "user", "own parent", 0.0), (5, 6, "user", "cycle", 0.0), (6, 5, "user", "cycle", 0.0), (7, 6, "user", "below", 0.0),
        (8, None, "assistant", "y" * 300_000, 0.0), (2, 1, "a>b\\", "x", 0.0),
    ]
    found = conversations(messages(spark, rows), scratch).withColumn("turns", read_back(F.col("formatted"))).collect()
    assert {r["root"]: r["n_turns"] for r in found} == {1: 2, 3: 1, 4: 1, 8: 1}
    first = next(r for r in found if r["root"] == 1)
    assert [(t["role"], t["text"]) for t in first["turns"]] == [("", ""), ("a>b\\", "x")]
    assert conversations(messages(spark, rows).where("false"), scratch).count() == 0


def test_escape_is_reversible(spark):
    texts = ["", "\\", "\\\\e", "\\e", "\\</turn>", "<turn <turn ", "</turn></turn>\n", "\\\\\\s\\g>", "a\\", "</tur", "</</turn>turn>"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, e, back in df.select("t", escape(F.col("t")), unescape(escape(F.col("t")))).collect():
        assert back == t and "</turn>" not in e and "<turn " not in e


def test_replies_follow_turns(spark, scratch):
    rows = [(1, 2, "user", "c"), (1, 0, "user", "a"), (1, 0, "user", "b"), (None, 1, "user", "n"), (None, None, "user", "m"), (2, 5, None, None)]
    found = as_replies(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"), scratch).collect()
    text = {r["node"]: r["text"] for r in found}
    assert {(r["text"], text.get(r["parent"])) for r in found} == {
        ("a", None), ("b", "a"), ("c", "b"), ("m", None), ("n", "m"), (None, None)}


def test_query_reads_back_what_the_table_holds(spark):
    folder = "/root/testdata/sf0.001"
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{folder}/conversations.parquet").collect():
        turns[r["conv_id"]].append((r["turn"], r["role"], r["text"] or ""))
    odd = "\\### Assistant: </turn> ok"
    turns[-7] = [(0, "user", odd), (1, "assistant", odd)]
    found = QUERIES["op1_reply_tree_chat"](spark, folder).collect()
    assert len(found) == len(turns)
    for r in found:
        rows = sorted(turns[r["conv_id"]])
        learned = "".join(t for _, role, t in rows if role == "assistant")
        assert r["n_turns"] == len(rows)
        assert r["turns_sha256"] == sha("".join(f"{role}\n{t}\n" for _, role, t in rows))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(learned), sha(learned))


def test_loss_texts_of_a_very_long_conversation(spark):
    """One pass over the text, whatever the number of turns; places count code points, not bytes or surrogates."""
    turns = 160_000
    rows = spark.range(turns).select(F.col("id"), F.concat(F.lit("é𝒳 "), F.col("id"), F.lit("\\e x" + "y" * 80)).alias("body"))
    one = rows.groupBy().agg(F.array_sort(F.collect_list(F.struct("id", "body"))).alias("all")).select(F.col("all.body").alias("bodies"))
    head = "<turn assistant>"
    # every body has as many code points, but for the digits of its number
    width = [len("é𝒳 \\e x") + 80 + len(str(i)) for i in range(turns)]
    places, at = [], 0
    for w in width:
        places.append((at + len(head), at + len(head) + w))
        at += len(head) + w + len("</turn>\n")
    loss = spark.createDataFrame([(places,)], "loss array<struct<start:bigint,end:bigint>>")
    whole = one.select(F.array_join(F.transform("bodies", lambda b: F.concat(F.lit(head), b, F.lit("</turn>\n"))), "").alias("formatted"))
    started = time.time()
    found = whole.crossJoin(loss).select(F.sha2(text_under_loss(F.col("formatted"), F.col("loss")), 256)).first()[0]
    assert time.time() - started < 60
    text = "".join(f"é𝒳 {i}</turn> x" + "y" * 80 for i in range(turns))
    assert found == hashlib.sha256(text.encode()).hexdigest()

"""Conversation repair, against all cheapest edit sequences kept as whole strings."""

from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from funnelmart.llm import conversation_repair as cr

SCHEMA = "conv_id bigint, turn bigint, role string, text string, place int, row int, edit string, cost double, conversation int"
SPACE = " \t\n\x0b\x0c\r"
FOLLOW = {"": "su", "s": "u", "u": "a", "a": "u"}


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x", 0.5, 3) for r in rows], SCHEMA).repartition(4)


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.strip(SPACE)
        if not bare:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows):
    """Cost, edits and lines: the least of all ways, each kept in full, by last role initial."""
    kinds = faults(rows)
    ways = {"": (0, "", ())}

    def inserted(known):
        out = dict(known)
        for _ in range(4):
            for last, (cost, audit, lines) in list(out.items()):
                for role in ("user", "assistant"):
                    if role[0] in FOLLOW[last]:
                        way = (cost + 2, audit + "I", (*lines, (role, "")))
                        out[role[0]] = min(out.get(role[0], way), way)
        return out

    for (role, text), kind in zip(rows, kinds):
        after = {}

        def offer(last, way):
            after[last] = min(after.get(last, way), way)

        for last, (cost, audit, lines) in inserted(ways).items():
            offer(last, (cost + 3, audit + "D", lines))
            if kind in ("", "truncated"):
                more = cost + (kind == "truncated")
                if role[:1] and role[0] in FOLLOW[last]:
                    offer(role[0], (more, audit + "K", (*lines, (role, text))))
                for new in ("user", "assistant"):
                    if new[0] in FOLLOW[last]:
                        offer(new[0], (more + 2, audit + "R", (*lines, (new, text))))
        ways = after
    return min(way for last, way in inserted(ways).items() if last in ("", "a"))


def ordered(rows):
    def key(r):
        digest = hashlib.sha256(f"{len(r[2])}:{r[2]}:{r[3]}".encode()).hexdigest()
        return (r[1] is not None, r[1] or 0, digest)

    return sorted(rows, key=key)


def summary(rows):
    turns = [r[1] for r in rows if r[1] is not None]
    pairs = [(r[2], r[3]) for r in rows]
    kinds = faults(pairs)
    cost, audit, lines = cheapest(pairs)
    legal = ("su", "ua", "au")
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, kinds.count("blank"), kinds.count("duplicate"),
        kinds.count("truncated"), sum(a[0][:1] + b[0][:1] not in legal for a, b in zip(pairs, pairs[1:])), cost, audit,
        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest(),
    )


def brute(rows):
    out = {}
    for conversation in {r[0] for r in rows}:
        kept = []
        for c, turn, role, text in rows:
            if c != conversation:
                continue
            role, text = (" " if x is None else x for x in (role, text))
            chance = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            text = {1: "", 2: text.translate({ord(x): None for x in ".!?"})}.get(chance, text)
            role = "user" if chance == 4 else role
            kept += [(c, turn, role, text)] * {0: 0, 3: 2}.get(chance, 1)
        out[conversation] = summary(ordered(kept))
    return out


def answer(spark, scratch, rows):
    found = cr.repaired_digests(table(spark, rows), scratch).collect()
    return {r["conv_id"]: tuple(r)[1:] for r in found}


def made(rng, conversation, n):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "usher"]
    texts = ["Yes.", "Well", "", " \n", None, "What?", "Go on! ", "é.", "no "]
    return [(conversation, rng.choice([i, i, i, None, i // 2]), rng.choice(roles), rng.choice(texts)) for i in range(n)]


def test_agrees_with_all_edits(spark, scratch):
    rng = random.Random(3)
    rows = [row for c in range(120) for row in made(rng, rng.choice([c, None]), rng.randrange(1, 12))]
    assert answer(spark, scratch, rows) == brute(rows)


def test_odd_rows(spark, scratch):
    rows = [
        (1, None, None, None), (2, 1, "user", "word " * 60_000), (2, 2, "assistant", "é" * 300_000), (3, 5, "user", "Hi."), (3, 5, "user", "Hi."),
        (None, None, "assistant", "." + " " * 200_000 + "x"), (None, 3, "user", "x."), (4, -(1 << 63), "user", "a."), (4, (1 << 63) - 1, "assistant", "b."),
        (5, 9, "\x00", "\x00"), (6, 1, "system", "Rules."),
    ]
    found, wanted = answer(spark, scratch, rows), brute(rows)
    assert found.pop(4)[0] == cr.MOST and found == {k: v for k, v in wanted.items() if k != 4}
    assert answer(spark, scratch, []) == {}


def test_a_conversation_may_lose_all_rows(spark, scratch):
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    nothing = hashlib.sha256().hexdigest()
    assert answer(spark, scratch, [(lost, 0, "user", "Hi.")]) == {lost: (0, 0, 0, 0, 0, 0, "", nothing)}


def test_giant_conversation_spills(spark, scratch):
    rng = random.Random(9)
    rows = [(7, i, rng.choice(["user", "assistant"]), f"text {i}" + rng.choice([".", ""])) for i in range(6_000)]
    rows += made(rng, 8, 40) + made(rng, None, 300)
    edited, counts = cr.repair(table(spark, rows), scratch, held=100)
    got = {}
    for r in sorted(edited.collect(), key=lambda r: (r["place"], r["part"])):
        got.setdefault(r["conversation"], []).append((r["edit"], r["role"], r["text"]))
    costs = {r["conversation"]: r["cost"] for r in counts.collect()}
    for c in (7, 8, None):
        mine = ordered([(a, b, " " if r is None else r, " " if t is None else t) for a, b, r, t in rows if a == c])
        name = None if c is None else str(c)
        cost, audit, lines = cheapest([r[2:] for r in mine])
        assert (costs[name], "".join(e for e, _, _ in got[name])) == (cost, audit)
        assert [(r, t) for _, r, t in got[name] if r is not None] == list(lines)


def test_states_stay_few():
    cr.advance.cache_clear()
    rng = random.Random(1)
    state = cr.State()
    for _ in range(50_000):
        state = cr.advance(state, rng.choice("suat"), rng.randrange(4))[0]
    assert cr.advance.cache_info().currsize < 2_000


def test_registered_query_agrees_with_its_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{folder}/conversations.parquet'")
    found = [tuple(r) for r in cr.op11_conversation_repair(spark, folder).collect()]
    assert sorted(found) == sorted(con.execute(cr.OP11_SQL).fetchall())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool"]), st.sampled_from(["a.", "b.", "c", ""])), max_size=9))
def test_walk_agrees_with_all_edits(rows):
    kinds = {"": cr.CLEAN, "truncated": cr.TRUNCATED, "duplicate": cr.DUPLICATE, "blank": cr.BLANK}
    walk = cr.Walk("c")
    for i, ((role, _), kind) in enumerate(zip(rows, faults(rows))):
        walk.add(i, i, role[:1], kinds[kind])
    out = walk.end()
    audit = "".join(row[4][::2] for row in out)
    assert (out[-1][11], audit) == cheapest(rows)[:2]

"""Repair of the role structure of conversations, streamed in secondary-sorted order.

A conversation in order has the role initials ``(s?(ua)+)?``. Rows are kept, given another role or deleted and empty
turns are inserted; a dynamic program over the rows finds the cheapest edits, among equally cheap ones those whose
initials come first in ASCII. Its state is small: for each of four states of the pattern the least cost, and the order
of the best edits so far among each other. Rows without their texts are dealt by conversation and sorted by turn,
and the state is carried from one Arrow batch to the next, so a conversation of any length takes the same memory.

Only going back over the decisions needs more: 24 bits a row. They are held for MOST_ROWS rows; a longer conversation
spills them, one number beside each row, into the stored table that the pass writes, and a second pass reads it
in reverse order, carrying one state. Texts join the decisions by row at the end, however long their conversation.

Inserts are made right before a row or at the end. That loses nothing: an insert after a deletion costs what it
costs before it, and D comes before I.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelmart.llm.store import Scratch, bounded_batches, col

START, SYSTEM, USER, ASSISTANT = range(4)  # what the pattern has seen last
ACCEPTED = (START, ASSISTANT)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
WANTED = "uuau"  # the role that may follow each state, but for a first system row
LEGAL = ("su", "ua", "au")
ROLES = {"u": "user", "a": "assistant"}
DELETE, KEEP, REROLE = "DKR"
INSERT_COST, REROLE_COST, DELETE_COST, TRUNCATED_COST = 2, 2, 3, 1
NEVER = 1 << 30
CLEAN, TRUNCATED, DUPLICATE, BLANK = range(4)
MOST_ROWS = 1 << 16  # rows of a conversation whose decisions are held in memory
MOST = (1 << 63) - 1
EMIT = 1 << 14  # rows handed on at a time

PASS = ("kind string, conversation string, place bigint, row bigint, edits string, pointers int, gaps bigint, blank bigint, "
        "duplicate bigint, truncated bigint, illegal bigint, cost bigint, state int")
NAMES = [field.split()[0] for field in PASS.split(", ")]
STEP = "conversation string, place bigint, row bigint, edits string"


@dataclass(frozen=True)
class State:
    """Costs by state of the pattern, over the least of them, and the rank of each state's edits in ASCII order."""

    costs: tuple[int, ...] = (0, NEVER, NEVER, NEVER)
    ranks: tuple[int, ...] = (0, 0, 0, 0)


def after_inserts(state: int, inserts: int) -> int:
    for _ in range(inserts):
        state = NEXT[state, WANTED[state]]
    return state


@lru_cache(maxsize=1 << 16)
def advance(state: State, initial: str, fault: int) -> tuple[State, int, int]:
    """The state after a row, what the least cost grew by, and where each state's best edits came from, 6 bits each.

    States that can't lead to a cheapest repair any more are given up, so there are few different ``State``.
    """
    best: dict[int, tuple] = {}
    for before in range(4):
        if state.costs[before] >= NEVER:
            continue
        for inserts in range(3):
            at = after_inserts(before, inserts)
            base = state.costs[before] + inserts * INSERT_COST
            choices = [(DELETE, at, DELETE_COST)]
            if fault in (CLEAN, TRUNCATED):
                more = TRUNCATED_COST if fault == TRUNCATED else 0
                if (at, initial) in NEXT:
                    choices.append((KEEP, NEXT[at, initial], more))
                choices.append((REROLE, NEXT[at, WANTED[at]], REROLE_COST + more))
            for edit, to, cost in choices:
                way = (base + cost, state.ranks[before], "I" * inserts + edit, before)
                best[to] = min(best.get(to, way), way)
    costs = [best[s][0] if s in best else NEVER for s in range(4)]
    if costs[START] > costs[ASSISTANT] + DELETE_COST:
        costs[START] = NEVER
    if costs[SYSTEM] > costs[ASSISTANT]:
        costs[SYSTEM] = NEVER
    least = min(costs)
    ranks, pointers = [0] * 4, 0
    for rank, s in enumerate(sorted((s for s in best if costs[s] < NEVER), key=lambda s: best[s][1:3])):
        ranks[s] = rank
        tail, before = best[s][2:]
        pointers |= (before | (len(tail) - 1) << 2 | "DKR".index(tail[-1]) << 4) << 6 * s
    return State(tuple(c if c >= NEVER else c - least for c in costs), tuple(ranks)), least, pointers


def finish(state: State) -> tuple[int, int, int]:
    """The state whose edits are the best of all, how many inserts end the conversation, and the cost over the least."""
    ways = []
    for s in range(4):
        for inserts in range(3):
            if state.costs[s] < NEVER and after_inserts(s, inserts) in ACCEPTED:
                ways.append((state.costs[s] + inserts * INSERT_COST, state.ranks[s], inserts, s))
    cost, _, inserts, s = min(ways)
    return s, inserts, cost


def spelled(state: int, inserts: int, edit: str) -> str:
    """Edits as pairs of an initial and the role it makes, '-' where it makes none."""
    out = ""
    for _ in range(inserts):
        out += "I" + WANTED[state]
        state = after_inserts(state, 1)
    return out + (edit and edit + (WANTED[state] if edit == REROLE else "-"))


def back(pointers: int, state: int) -> tuple[int, str]:
    """The state before a row that led to ``state``, and the row's edits."""
    bits = pointers >> 6 * state
    before, inserts, edit = bits & 3, bits >> 2 & 3, "DKR"[bits >> 4 & 3]
    return before, spelled(before, inserts, edit)


class Walk:
    """One conversation on its way through the rows."""

    def __init__(self, name: str | None):
        self.name, self.state, self.cost = name, State(), 0
        self.faults, self.illegal = [0, 0, 0, 0], 0
        self.first = self.last = self.initial = None
        self.turns = self.place = 0
        self.held: list[tuple[int, int]] = []  # row and pointers
        self.spilled = False

    def add(self, row: int, turn: int | None, initial: str, fault: int) -> None:
        if turn is not None:
            if self.first is None:
                self.first = turn
            if turn != self.last:
                self.turns, self.last = self.turns + 1, turn
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.initial = initial
        self.faults[fault] += 1
        self.state, grown, pointers = advance(self.state, initial, fault)
        self.cost += grown
        self.held.append((row, pointers))

    def spill(self) -> list[tuple]:
        self.spilled = True
        out = [
            ("pending", self.name, self.place + i, row, None, pointers, *[None] * 7) for i, (row, pointers) in enumerate(self.held)
        ]
        self.place += len(self.held)
        self.held = []
        return out

    def end(self) -> list[tuple]:
        state, inserts, more = finish(self.state)
        out = self.spill() if self.spilled else []
        at, rows = state, []
        for i, (row, pointers) in reversed(list(enumerate(self.held))):
            at, edits = back(pointers, at)
            rows.append(("step", self.name, i, row, edits, *[None] * 8))
        self.place += len(self.held)
        out += rows[::-1]
        gaps = 0 if self.first is None else min(self.last - self.first + 1 - self.turns, MOST)
        counts = (self.faults[BLANK], self.faults[DUPLICATE], self.faults[TRUNCATED], self.illegal, self.cost + more)
        out.append(("end", self.name, self.place, None, spelled(state, inserts, ""), None, gaps, *counts, state))
        return out


def frame(rows: list[tuple]) -> pd.DataFrame:
    whole = [n for n in NAMES if n not in ("kind", "conversation", "edits")]
    return pd.DataFrame(rows, columns=NAMES, dtype=object).astype(dict.fromkeys(whole, "Int64"))


def walk_rows(batches: Iterator[pd.DataFrame], held: int) -> Iterator[pd.DataFrame]:
    """Rows of whole conversations in order; gives the decisions on each row, and a summary per conversation."""
    walk, ready = None, []
    for pdf in batches:
        turns = [None if t is None else int(t) for t in pdf["turn"]]  # sent as text: null longs would come as doubles
        for name, row, turn, initial, fault in zip(pdf["conversation"], pdf["row"], turns, pdf["initial"], pdf["fault"]):
            if walk is None or walk.name != name:
                ready += walk.end() if walk else []
                walk = Walk(name)
            walk.add(row, turn, initial, fault)
            if len(walk.held) >= held:
                ready += walk.spill()
            if len(ready) >= EMIT:
                yield frame(ready)
                ready = []
    ready += walk.end() if walk else []
    if ready:
        yield frame(ready)


def walk_back(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Spilled rows of whole conversations, last first, each after its summary; gives the decisions on each row."""
    state = START
    for pdf in batches:
        out = []
        for kind, end, pointers in zip(pdf["kind"], pdf["state"], pdf["pointers"]):
            if kind == "end":
                state = int(end)
                out.append(None)
            else:
                state, edits = back(int(pointers), state)
                out.append(edits)
        done = pdf.assign(edits=out)[["conversation", "place", "row", "edits"]]
        yield done[pdf["kind"] == "pending"]


def with_faults(rows: DataFrame, scratch: Scratch, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows as stored: ``row``, ``conversation``, ``turn``, ``role``, ``text``, ``initial``, ``digest`` and ``own_fault``."""
    plain = rows.select(
        col(conversation).cast("string").alias("conversation"), col(turn).cast("bigint").alias("turn"),
        F.coalesce(col(role).cast("string"), F.lit(" ")).alias("role"), F.coalesce(col(text).cast("string"), F.lit(" ")).alias("text"),
    )
    sentence = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*+\z")
    return scratch.keep(plain.select(
        F.monotonically_increasing_id().alias("row"), "*", F.substring("role", 1, 1).alias("initial"),
        F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256).alias("digest"),
        F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK).when(~sentence, TRUNCATED).otherwise(CLEAN).alias("own_fault"),
    ), "rows")


def repair(rows: DataFrame, scratch: Scratch, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text", held: int = MOST_ROWS) -> tuple[DataFrame, DataFrame]:
    """Edited rows and a summary per conversation.

    Edited rows: ``conversation`` (as string), ``place`` and ``part`` (their order), ``edit`` (K, R, D or I), ``role`` and
    ``text`` as repaired, null where deleted. Summary: ``conversation``, ``gaps``, ``blank``, ``duplicate``, ``truncated``,
    ``illegal``, ``cost``. Rows go by turn, null turns first; rows of one turn by a digest of role and text, so the answer
    does not depend on how rows are stored, and repeated rows stand next to each other. Null roles and texts count as one
    space; a role counts by its first character, so any role that begins with s, u or a can be kept, and others, empty
    ones included, can't. ``held`` rows of a conversation are decided in memory, more are spilled. Null conversations are one conversation. Repeated rows are duplicates but for the first. An empty
    table gives two empty ones; other columns are ignored.
    """
    spark = rows.sparkSession
    bounded_batches(spark)
    base = with_faults(rows, scratch, conversation, turn, role, text)
    # the first row of each text is found by a minimum that is taken on the map side, so one text in a
    # third of all rows costs its task a row per map task
    firsts = base.groupBy("conversation", "digest").agg(F.min(F.struct("turn", "row")).alias("first")).select("first.row")
    narrow = base.select("row", "conversation", "turn", "digest", "initial", "own_fault")
    known = narrow.join(firsts.withColumn("is_first", F.lit(True)), "row", "left")
    fault = F.when((F.col("own_fault") != BLANK) & F.col("is_first").isNull(), DUPLICATE).otherwise(F.col("own_fault"))
    ordered = (
        known.withColumn("fault", fault).repartition("conversation")
        .sortWithinPartitions("conversation", F.asc_nulls_first("turn"), "digest", F.col("is_first").isNull(), "row")
    )
    ordered = ordered.select("conversation", "row", F.col("turn").cast("string").alias("turn"), "initial", "fault")
    walked = scratch.keep(ordered.mapInPandas(lambda batches: walk_rows(batches, held), PASS), "walked")
    ends = walked.where("kind = 'end'")
    steps = walked.where("kind = 'step'").select("conversation", "place", "row", "edits")
    pending = walked.where("kind = 'pending'")
    if not pending.isEmpty():
        giants = pending.select("conversation").distinct().withColumn("giant", F.lit(True))
        giant_ends = ends.join(giants, ends["conversation"].eqNullSafe(giants["conversation"]), "left_semi")
        spilled = pending.unionAll(giant_ends).repartition("conversation").sortWithinPartitions("conversation", F.desc("place"))
        steps = steps.unionAll(scratch.keep(
            spilled.select("kind", "conversation", "place", "row", "pointers", "state").mapInPandas(walk_back, STEP), "unspilled"
        ))
    last = ends.select("conversation", "place", F.lit(None).cast("bigint").alias("row"), "edits")
    made = steps.join(base.select("row", "role", "text"), "row").unionByName(
        last.select("*", F.lit("").alias("role"), F.lit("").alias("text"))
    )
    one = made.select(
        "conversation", "place", "role", "text", F.posexplode(F.regexp_extract_all("edits", F.lit("(..)"), F.lit(1))).alias("part", "pair")
    )
    edit, given = F.substring("pair", 1, 1), F.substring("pair", 2, 1)
    edited = one.select(
        "conversation", "place", "part", edit.alias("edit"),
        F.when(given == "u", ROLES["u"]).when(given == "a", ROLES["a"]).when(edit == KEEP, F.col("role")).alias("role"),
        F.when(edit == "I", "").when(edit != DELETE, F.col("text")).alias("text"),
    )
    return edited, ends.select("conversation", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def digest_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edited rows of whole conversations in order; gives the edits' initials and the hash of the lines left."""
    name, edits, lines, any_line, started = None, [], hashlib.sha256(), False, False
    for pdf in batches:
        out = []
        for own, edit, role, text in zip(pdf["conversation"], pdf["edit"], pdf["role"], pdf["text"]):
            if not started or own != name:
                if started:
                    out.append((name, "".join(edits), lines.hexdigest()))
                name, edits, lines, any_line, started = own, [], hashlib.sha256(), False, True
            edits.append(edit)
            if role is not None:
                lines.update((f"\n{role}:" if any_line else f"{role}:").encode())
                lines.update(text.encode())
                any_line = True
        if out:
            yield pd.DataFrame(out, columns=["conversation", "audit", "repaired_sha256"])
    if started:
        yield pd.DataFrame([(name, "".join(edits), lines.hexdigest())], columns=["conversation", "audit", "repaired_sha256"])


def chance(*columns: str) -> Column:
    """crc32 of these columns' values, joined by colons, modulo 20; a null value is one space."""
    values = [F.coalesce(col(c).cast("string"), F.lit(" ")) for c in columns]
    return F.crc32(F.concat_ws(":", *values).cast("binary")) % 20


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults planted by crc32 of ``conv_id:turn``; null roles and texts become one space."""
    plain = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        chance("conv_id", "turn").alias("chance"),
    )
    text = F.when(F.col("chance") == 1, "").when(F.col("chance") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return plain.where("chance <> 0").select(
        "conv_id", "turn", F.when(F.col("chance") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.when(F.col("chance") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def repaired_digests(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per conversation of ``conversations``: its faults after damage, the cost, edits and hash of the repair."""
    edited, summary = repair(damaged(conversations), scratch)
    in_order = edited.repartition("conversation").sortWithinPartitions("conversation", "place", "part")
    digests = in_order.select("conversation", "edit", "role", "text").mapInPandas(
        digest_rows, "conversation string, audit string, repaired_sha256 string"
    )
    every = conversations.select("conv_id").distinct().withColumn("conversation", F.col("conv_id").cast("string"))

    def with_rows(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.withColumnRenamed("conversation", "of")
        return left.join(right, F.col("conversation").eqNullSafe(F.col("of")), "left").drop("of")

    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    nothing = hashlib.sha256().hexdigest()
    return with_rows(with_rows(every, summary), digests).select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Damage to all conversations, and their cheapest repair."""
    conversations = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return repaired_digests(conversations, Scratch(spark))


OP11_SQL = r"""
with recursive bits(byte, value, step) as (
    select range, range, 0 from range(256)
    union all
    select byte, case when value & 1 = 1 then xor(value >> 1, 3988292384) else value >> 1 end, step + 1 from bits where step < 8
), crc as (select list(value order by byte) as steps from bits where step = 8),
keyed as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda c: ord(c)::bigint) as codes
    from conversations
), chances as (
    select conv_id, turn, role, text, xor(list_reduce([4294967295] || codes,
        lambda sum, code: xor(sum >> 8, steps[(xor(sum, code) & 255) + 1])), 4294967295) % 20 as chance
    from keyed, crc
), damaged as (
    select conv_id, turn, case when chance = 4 then 'user' else role end as role,
        case when chance = 1 then '' when chance = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
        unnest(case when chance = 3 then [1, 2] else [1] end) as copy
    from chances where chance <> 0
), placed as (
    select *, row_number() over (partition by conv_id order by turn nulls first, digest, copy) as place,
        row_number() over (partition by conv_id, role, text order by turn nulls first, copy) as seen,
        left(role, 1) as initial
    from (select *, sha256(length(role)::varchar || ':' || role || ':' || text) as digest from damaged)
), rows as (
    select *, lag(initial) over (partition by conv_id order by place) || initial as pair, case
        when not regexp_matches(text, '[^\x20\x09-\x0d]') then 'blank' when seen > 1 then 'duplicate'
        when not regexp_matches(text, '[.!?][\x20\x09-\x0d]*$') then 'truncated' else '' end as fault
    from placed
), inserts(before, state, audit, lines, cost) as (values
    (0, 0, '', '', 0), (1, 1, '', '', 0), (2, 2, '', '', 0), (3, 3, '', '', 0),
    (0, 2, 'I', chr(10) || 'user:', 2), (1, 2, 'I', chr(10) || 'user:', 2), (3, 2, 'I', chr(10) || 'user:', 2),
    (2, 3, 'I', chr(10) || 'assistant:', 2), (1, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:', 4)
), edits(state, edit, initial, after, role, cost) as (values
    (0, 'D', null, 0, null, 3), (1, 'D', null, 1, null, 3), (2, 'D', null, 2, null, 3), (3, 'D', null, 3, null, 3),
    (0, 'K', 's', 1, null, 0), (0, 'K', 'u', 2, null, 0), (1, 'K', 'u', 2, null, 0), (2, 'K', 'a', 3, null, 0), (3, 'K', 'u', 2, null, 0),
    (0, 'R', null, 2, 'user', 2), (1, 'R', null, 2, 'user', 2), (2, 'R', null, 3, 'assistant', 2), (3, 'R', null, 2, 'user', 2)
), moves as (
    select i.before, e.after, i.audit || e.edit as audit, i.lines, i.cost + e.cost as cost, e.edit, e.initial, e.role
    from inserts i join edits e using (state)
), walk(conv_id, place, state, best) as (
    select distinct conv_id, 0::bigint, 0, {'cost': 0, 'audit': '', 'lines': ''} from rows
    union all
    select r.conv_id, r.place, m.after, min({
        'cost': w.best.cost + m.cost + case when m.edit <> 'D' and r.fault = 'truncated' then 1 else 0 end,
        'audit': w.best.audit || m.audit,
        'lines': w.best.lines || m.lines || case when m.edit = 'D' then '' else chr(10) || coalesce(m.role, r.role) || ':' || r.text end
    })
    from walk w join rows r on r.conv_id is not distinct from w.conv_id and r.place = w.place + 1
    join moves m on m.before = w.state and (m.edit = 'D' or r.fault not in ('blank', 'duplicate')) and (m.initial is null or m.initial = r.initial)
    group by r.conv_id, r.place, m.after
), counted as (
    select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) as n,
        count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
        count(*) filter (fault = 'truncated') as truncated, count(*) filter (pair not in ('su', 'ua', 'au')) as illegal
    from rows group by conv_id
), ended as (
    select c.conv_id, min({'cost': w.best.cost + i.cost, 'audit': w.best.audit || i.audit, 'lines': w.best.lines || i.lines}) as best
    from counted c join walk w on w.conv_id is not distinct from c.conv_id and w.place = c.n
    join inserts i on i.before = w.state and i.state in (0, 3) group by c.conv_id
)
select e.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
    coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(best.cost, 0)::bigint as cost,
    coalesce(best.audit, '') as audit, sha256(coalesce(substr(best.lines, 2), '')) as repaired_sha256
from (select distinct conv_id from conversations) e
left join counted c on c.conv_id is not distinct from e.conv_id left join ended d on d.conv_id is not distinct from e.conv_id
"""

"""Conversations from reply trees.

Messages reply to messages, so they form trees. Self-joins that double the distance they cover at each
round tell every message its root and what stands before it on the path. The best branches of a tree are
chosen by score, and their paths, found by walking the same joins back down, are each formatted as
one conversation. Everything is DataFrame code.

A formatted turn is ``<turn ROLE>TEXT</turn>`` and a line break. Within roles and texts a backslash is
doubled and control strings are replaced by a backslash and a letter, so the marks stand for themselves
only and reading back gives the texts as they were.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from funnelmart.llm.store import Scratch, col, text_of
from funnelmart.operators.dense_key import with_dense_key
from funnelmart.operators.latest import first_per_group

OPEN, CLOSE, END = "<turn ", ">", "</turn>\n"
WIDE = "UTF-32"  # big-endian, four bytes a code point
ESCAPES = (("</turn>", "\\e"), ("<turn ", "\\s"))
ROLE_ESCAPES = (*ESCAPES, (">", "\\g"))
LEARNED = "assistant"  # the role whose texts are under the loss mask


def escape(text: Column, escapes=ESCAPES) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control, code in escapes:
        text = F.replace(text, F.lit(control), F.lit(code))
    return text


def unescape(text: Column, escapes=ESCAPES) -> Column:
    """The text before ``escape``: doubled backslashes part it, codes are replaced in the parts."""

    def decoded(part: Column) -> Column:
        for control, code in reversed(escapes):
            part = F.replace(part, F.lit(code), F.lit(control))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\"), decoded), "\\")


def ancestors(nodes: DataFrame, scratch: Scratch) -> tuple[DataFrame, list[DataFrame]]:
    """What lies above each node, and the jump tables that found it.

    ``nodes`` has ``node`` (unique), ``parent`` (null for a root, else a node), ``score`` and ``chars``. The
    result has ``node``, ``root``, ``depth``, and the sums of ``score`` and ``chars`` over all
    ancestors. Jump table k has ``node`` and ``anc``, its ancestor 2**k levels up. Nodes on or below a
    cycle have no root and are left out.
    """
    above = nodes.select(
        F.col("node").alias("anc"), "score", "chars", F.col("parent").isNotNull().alias("open")
    )
    state = scratch.keep(
        nodes.where("parent is not null").select("node", F.col("parent").alias("anc")).join(above, "anc")
        .select("node", "anc", F.lit(1).cast("bigint").alias("depth"), "score", "chars", "open"), "jump",
    )
    jumps, reach, most = [], 1, nodes.count()
    while True:
        jumps.append(state.where(F.col("depth") == reach).select("node", "anc"))
        if reach > most or state.where("open").isEmpty():
            break
        upper = state.select(F.col("node").alias("anc"), F.struct("anc", "depth", "score", "chars", "open").alias("up"))
        advanced = state.where("open").join(upper, "anc").select(
            "node", F.col("up.anc").alias("anc"),
            *[(F.col(c) + F.col(f"up.{c}")).alias(c) for c in ("depth", "score", "chars")],
            F.col("up.open").alias("open"),
        )
        state = scratch.keep(state.where("not open").unionAll(advanced), "jump")
        reach *= 2
    roots = nodes.where("parent is null").select(
        "node", F.col("node").alias("root"), F.lit(0).cast("bigint").alias("depth"),
        F.lit(0.0).alias("score"), F.lit(0).cast("bigint").alias("chars"),
    )
    below = state.where("not open").select("node", F.col("anc").alias("root"), "depth", "score", "chars")
    return roots.unionAll(below), jumps


def conversations(messages: DataFrame, scratch: Scratch, keep: int = 1, node: str = "node", parent: str = "parent",
                  role: str = "role", text: str = "text", score: str = "score") -> DataFrame:
    """The ``keep`` best branches of each tree, each formatted as one conversation.

    A branch is the path from a root to a message without replies; it ranks by the mean score of its
    messages, then by the smaller id of its last. Result: ``root``, ``leaf``, ``rank`` (from 1), ``n_turns``,
    ``mean_score``, ``formatted``, and ``loss``, the places (start, end; code points) of the assistant's
    texts in it.

    A null role or text reads as empty, a null score as 0. Messages without an id are left out; of rows
    with the same id the first by parent, role and text counts. A message whose parent is null, missing or itself
    is a root. Messages on or below a cycle belong to no tree. Empty input gives no rows; further columns are ignored.
    """
    rows = messages.select(
        col(node).alias("node"), col(parent).alias("parent"), text_of(role).alias("role"),
        text_of(text).alias("text"), F.coalesce(col(score).cast("double"), F.lit(0.0)).alias("score"),
    ).where("node is not null")
    rows = first_per_group(rows, [F.col("node")], [F.asc("parent"), F.asc("role"), F.asc("text"), F.desc("score")])
    head = F.concat(F.lit(OPEN), escape(F.col("role"), ROLE_ESCAPES), F.lit(CLOSE))
    body = escape(F.col("text"))
    turns = scratch.keep(
        rows.withColumn("head", head).withColumn("body", body).withColumn("learned", F.col("role") == LEARNED)
        .withColumn("chars", F.length("head") + F.length("body") + F.lit(len(END))).drop("role", "text"), "turns",
    )
    known = turns.select(F.col("node").alias("known"))
    wanted = F.when(F.col("parent") != F.col("node"), F.col("parent"))
    links = turns.select("node", wanted.alias("parent"), "score", F.col("chars").cast("bigint").alias("chars"))
    linked = links.where("parent is not null").join(known, F.col("parent") == F.col("known"), "left").select(
        "node", F.col("known").alias("parent"), "score", "chars"
    )
    nodes = scratch.keep(links.where("parent is null").unionAll(linked), "nodes")
    found, jumps = ancestors(nodes, scratch)
    placed = scratch.keep(
        found.join(nodes.select("node", F.col("score").alias("own")), "node").select(
            "node", "root", "depth", "chars", ((F.col("score") + F.col("own")) / (F.col("depth") + 1)).alias("mean_score")
        ), "placed",
    )
    replied = nodes.where("parent is not null").select(F.col("parent").alias("node")).distinct()
    rank = F.row_number().over(W.partitionBy("root").orderBy(F.desc("mean_score"), "node"))
    chosen = scratch.keep(
        placed.join(replied, "node", "left_anti").withColumn("rank", rank).where(F.col("rank") <= keep), "chosen"
    )
    on_path = chosen.select(F.col("node").alias("leaf"), "node")
    for jump in reversed(jumps):
        up = on_path.join(jump, "node").select("leaf", F.col("anc").alias("node"))
        on_path = scratch.keep(on_path.unionAll(up), "on_path")

    chunk = F.struct(
        "depth", F.concat("head", "body", F.lit(END)).alias("chunk"), "learned",
        (F.col("before") + F.length("head")).alias("start"),
        (F.col("before") + F.length("head") + F.length("body")).alias("end"),
    )
    parts = (
        on_path.join(placed.select("node", "depth", F.col("chars").alias("before")), "node")
        .join(turns.select("node", "learned", "head", "body"), "node")
        .groupBy("leaf").agg(F.sort_array(F.collect_list(chunk)).alias("turns"))
    )
    learned = F.filter("turns", lambda t: t["learned"])
    loss = F.transform(learned, lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end")))
    return parts.join(chosen.select(F.col("node").alias("leaf"), "root", "rank", "mean_score"), "leaf").select(
        "root", "leaf", "rank", F.size("turns").cast("bigint").alias("n_turns"), "mean_score",
        F.array_join(F.col("turns.chunk"), "").alias("formatted"), loss.alias("loss"),
    )


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    pieces = F.slice(F.split(formatted, END), F.lit(1), F.size(F.split(formatted, END)) - 1)

    def turn(piece: Column) -> Column:
        close = F.instr(piece, CLOSE)
        role = F.substring(piece, F.lit(len(OPEN) + 1), close - len(OPEN) - 1)
        body = F.substring(piece, close + 1, F.length(piece))
        return F.struct(unescape(role, ROLE_ESCAPES).alias("role"), unescape(body).alias("text"))

    return F.transform(pieces, turn)


def text_under_loss(formatted: Column, loss: Column) -> Column:
    """The texts at the places of a loss mask, as they were before formatting, joined.

    Places count code points, and a text's code points can only be counted from its start. So the text is first
    made wide, four bytes each; there every place is reached at once, and any number of turns costs one pass.
    """

    def texts(wide: Column) -> Column:
        def span(place: Column) -> Column:
            found = F.substring(wide, (4 * place["start"] + 1).cast("int"), (4 * (place["end"] - place["start"])).cast("int"))
            return unescape(F.decode(found, WIDE))

        return F.array_join(F.transform(loss, span), "")

    # within a lambda the wide text is a value, not an expression that each turn would evaluate again
    return F.get(F.transform(F.array(F.encode(formatted, WIDE)), texts), F.lit(0))


def as_replies(turns: DataFrame, scratch: Scratch, key: str = "conv_id") -> DataFrame:
    """Rows of ``key``, turn, role and text as messages in which each replies to the turn before it.

    Turns are numbered over the whole table in one distributed sort, so a conversation of any length is
    nobody's single task. Equal turns are ordered by role and text, nulls first.
    """
    ordered = turns.select(col(key).alias("conv_id"), "turn", "role", "text")
    numbered = with_dense_key(ordered, "node", ["conv_id", "turn", "role", "text"], scratch.path("ordered"))
    before = numbered.select((F.col("node") + 1).alias("next"), F.col("conv_id").alias("of"), F.col("node").alias("above"))
    return numbered.join(before, F.col("node") == F.col("next"), "left").select(
        "conv_id", "node", F.when(F.col("conv_id").eqNullSafe(F.col("of")), F.col("above")).alias("parent"),
        "role", "text", F.length(text_of("text")).cast("double").alias("score"),
    )


def op1_reply_tree_chat(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, formatted and read back; conversation -7 tests the escapes."""
    scratch = Scratch(spark)
    rows = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    tricky = "\\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], rows.schema)
    messages = as_replies(rows.unionAll(own), scratch)
    formatted = conversations(messages, scratch)
    told = formatted.select(
        "root", "formatted", read_back(F.col("formatted")).alias("turns"),
        text_under_loss(F.col("formatted"), F.col("loss")).alias("learned"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return told.join(messages.select(F.col("node").alias("root"), "conv_id"), "root").select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


OP1_SQL = r"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text,
           role as r, text as t
    from (select conv_id, turn, role, text from conversations
          union all values (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))
), marked as (
    select *, replace(replace(replace(text, '\', '\\'), '</turn>', '\e'), '<turn ', '\s') as body,
           replace(replace(replace(replace(role, '\', '\\'), '</turn>', '\e'), '<turn ', '\s'), '>', '\g') as head
    from turns
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, r nulls first, t nulls first)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, r nulls first, t nulls first) filter (role = 'assistant'), '')) as loss_sha256,
       cast(sum(length(head) + length(body) + 15) as bigint) as formatted_chars
from marked group by conv_id
"""

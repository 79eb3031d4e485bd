"""Mixing sources to target weights by entropy balancing.

Each document gets a rate, the expected number of its copies in the mix. Among all rates between 0 and a
cap that meet the word targets of the sources, entropy balancing takes those closest to 1 in relative
entropy. They have the form ``min(cap, exp(dual * size))`` with one dual value per source, found by
Newton steps on the convex dual problem, each step one aggregate over the table. Rates are rounded to
whole copies so that the words taken stay near the target. Everything is DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from funnelmart.llm.store import Rounds, Scratch, col, free_name, text_of
from funnelmart.operators.dense_key import with_dense_key

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)  # by place of the source, repeating
CAP = 3  # most copies of a document, and most words of a target by words of its source
TOLERANCE = 1e-9  # relative error of a source's expected words at which Newton steps end
ROUNDS = 100
REPAIRS = 3  # passes that give the rest of a source's target to single documents
BROADCAST_ROWS = 200_000  # size classes sent whole to every executor


def with_targets(totals: DataFrame, weights: tuple[float, ...], cap: int, scratch: Scratch) -> DataFrame:
    """``totals`` (source, words) with ``target``: all words shared by weight, within ``cap`` times a source.

    Sources are ordered by code point, null last, and take the weights in turn. What a source cannot take
    is shared by weight among the others, until no target is above its cap.
    """
    ordered = totals.withColumn("last", F.col("source").isNull())
    numbered = with_dense_key(ordered, "place", ["last", "source"], scratch.path("sources"))
    weight = F.element_at(
        F.array(*map(F.lit, weights)), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int")
    )
    sources = scratch.keep(
        numbered.select("source", "words", weight.alias("weight"), (F.col("words") * float(cap)).alias("most")),
        "weights",
    )
    rate, full = 0.0, -1
    while True:  # the sources at their cap only become more
        capped = F.col("weight") * rate >= F.col("most")
        sums = sources.agg(
            F.sum("words").alias("words"),
            F.sum(F.when(capped, F.col("most")).otherwise(0.0)).alias("most"),
            F.sum(F.when(~capped, F.col("weight")).otherwise(0.0)).alias("weight"),
            F.sum(capped.cast("int")).alias("full"),
        ).first()
        if sums["full"] is None or sums["full"] == full or not sums["weight"]:
            break
        full = sums["full"]
        rate = max(0.0, sums["words"] - sums["most"]) / sums["weight"]
    return sources.select(
        "source", "words", F.least(F.col("most"), F.col("weight") * rate).cast("double").alias("target")
    )


def rate_of(dual: Column, size: Column, cap: int) -> Column:
    return F.least(F.lit(float(cap)), F.exp(F.least(dual * size, F.lit(50.0))))


def solve_duals(classes: DataFrame, targets: DataFrame, cap: int, scratch: Scratch) -> DataFrame:
    """One dual value per source, as (source, dual).

    ``classes`` are (source, size, n): documents of equal source and size share a rate, so a step is a
    sum over size classes. A step that leaves the bracket around the root is replaced by bisection.
    A target at the cap or at zero has its root at infinity; it gets a value that is as good.
    """
    rounds = Rounds(scratch, "duals")
    scale = classes.groupBy(F.col("source").alias("key")).agg(F.min("size").alias("least"))
    span = 60.0 / F.col("least")
    state = rounds.keep(
        targets.where("words > 0").join(scale, F.col("source").eqNullSafe(F.col("key")))
        .select("source", "words", "target", F.lit(0.0).alias("dual"), (-span).alias("low"), span.alias("high"))
    )
    for _ in range(ROUNDS):
        s = state.select(F.col("source").alias("key"), "words", "target", "dual", "low", "high")
        rate = rate_of(F.col("dual"), F.col("size"), cap)
        mass = F.col("n") * F.col("size") * rate
        step = (
            classes.join(s, F.col("source").eqNullSafe(F.col("key")))
            .groupBy("key", "words", "target", "dual", "low", "high")
            .agg(
                F.sum(mass).alias("got"),
                F.sum(F.when(rate < cap, mass * F.col("size")).otherwise(0.0)).alias("slope"),
            )
        )
        over = F.col("got") > F.col("target")
        done = F.abs(F.col("got") - F.col("target")) <= TOLERANCE * F.col("words")
        low = F.when(over, F.col("low")).otherwise(F.col("dual"))
        high = F.when(over, F.col("dual")).otherwise(F.col("high"))
        newton = F.col("dual") + F.try_divide(F.col("target") - F.col("got"), F.col("slope"))
        inside = newton.isNotNull() & (newton > F.col("low2")) & (newton < F.col("high2"))
        state = rounds.keep(
            step.withColumn("low2", low).withColumn("high2", high).select(
                F.col("key").alias("source"), "words", "target",
                F.when(done, F.col("dual")).when(inside, newton)
                .otherwise((F.col("low2") + F.col("high2")) / 2).alias("dual"),
                F.col("low2").alias("low"), F.col("high2").alias("high"), done.alias("done"),
            )
        )
        left = state.where("not done and high - low > 1e-15 * abs(high)").limit(1).count()
        state = state.drop("done")
        if not left:
            break
    # sums of doubles have no fixed order in a shuffle; what that leaves in the last digits must not decide a rounding
    return state.select("source", F.format_string("%.10e", F.col("dual")).cast("double").alias("dual"))


def class_copies(classes: DataFrame, targets: DataFrame, duals: DataFrame, cap: int) -> DataFrame:
    """``classes`` with ``copies``, the whole number of copies that all documents of the class get together.

    Expected copies are added up by size within a source and rounded there, so no running sum is off by
    more than one and the words taken are off by less than the longest document. What is then missing
    or too much goes to single documents, in passes from small to large classes.
    """
    t = targets.select(F.col("source").alias("key"), "target")
    d = duals.select(F.col("source").alias("dual_key"), "dual")
    rated = (
        classes.join(t, F.col("source").eqNullSafe(F.col("key"))).drop("key")
        .join(d, F.col("source").eqNullSafe(F.col("dual_key")), "left").drop("dual_key")
    )
    expected = F.when(F.col("target") > 0, F.col("n") * rate_of(F.col("dual"), F.col("size"), cap)).otherwise(0.0)
    by_size = W.partitionBy("source").orderBy("size")
    running = F.sum("expected").over(by_size.rowsBetween(W.unboundedPreceding, 0))
    rounded = F.floor(F.col("running") + 0.5)
    before = F.coalesce(F.lag("rounded").over(by_size), F.lit(0))
    out = (
        rated.withColumn("expected", expected).withColumn("running", running).withColumn("rounded", rounded)
        .withColumn("copies", F.least(F.col("rounded") - before, F.col("n") * cap).cast("bigint"))
        .select("source", "size", "n", "target", "copies")
    )
    whole = W.partitionBy("source")
    for _ in range(REPAIRS):
        out = out.withColumn("gap", F.col("target") - F.sum(F.col("copies") * F.col("size")).over(whole))
        room = F.when(F.col("gap") > 0, F.col("n") * cap - F.col("copies")).otherwise(F.col("copies"))
        room = F.when(F.col("size") > F.abs("gap"), F.lit(0)).otherwise(room)
        largest = W.partitionBy("source").orderBy(F.desc("size"))
        used = F.sum(F.col("room") * F.col("size")).over(largest.rowsBetween(W.unboundedPreceding, -1))
        left = F.greatest(F.abs("gap") - F.coalesce(used, F.lit(0.0)), F.lit(0.0))
        out = (
            out.withColumn("room", room)
            .withColumn("move", F.least(F.col("room"), F.floor(F.try_divide(left, F.col("size")))))
            .withColumn("copies", F.col("copies") + F.when(F.col("gap") > 0, F.col("move")).otherwise(-F.col("move")))
            .select("source", "size", "n", "target", F.col("copies").cast("bigint").alias("copies"))
        )
    return out


def mix(documents: DataFrame, scratch: Scratch, text: str = "text", source: str = "source",
        identity: str = "doc_id", weights: tuple[float, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``documents`` with ``copies`` (0 to ``cap``), ``size``, ``source_size`` and ``target``.

    Which documents of a class get one copy more is decided by a hash of id and text, so reruns agree.
    Rows that agree in both are taken alike, so a source may be off its target by as many words as its
    largest set of repeated rows has. A null source is a source of its own, a null text is empty, texts without
    words get one copy and take no words. Empty input gives no rows. Input columns named like an added one
    are replaced.
    """
    added = ("copies", "size", "source_size", "target")
    kept = [c for c in documents.columns if c.lower() not in added]
    names = {n: free_name(documents, n) for n in ("_size", "_hash")}
    measured = documents.select(
        *map(col, kept),
        F.regexp_count(text_of(text), F.lit(WORD)).cast("bigint").alias(names["_size"]),
        F.xxhash64(col(identity), col(text)).alias(names["_hash"]),
    )
    narrow = scratch.keep(
        measured.select(
            col(source).cast("string").alias("source"), F.col(names["_size"]).alias("size"),
            F.col(names["_hash"]).alias("hash"),
        ), "sizes",
    )
    classes = scratch.keep(narrow.groupBy("source", "size").agg(F.count("*").alias("n")), "classes")
    totals = classes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words"))
    targets = scratch.keep(with_targets(totals, weights, cap, scratch), "targets")
    filled = classes.where("size > 0")
    duals = solve_duals(filled, targets, cap, scratch)
    taken = scratch.keep(class_copies(filled, targets, duals, cap), "taken")

    ordered = with_dense_key(
        narrow.where("size > 0").withColumn("last", F.col("source").isNull()), "place",
        ["last", "source", "size", "hash"], scratch.path("ordered"),
    )
    starts = ordered.groupBy("source", "size").agg(F.min("place").alias("start"))
    cuts = taken.select(
        F.col("source").alias("key"), F.col("size").alias("key_size"), "copies", "n",
        F.expr("copies div n").alias("base"), F.expr("copies % n").alias("extra"),
    )
    same = F.col("source").eqNullSafe(F.col("key")) & (F.col("size") == F.col("key_size"))
    at = starts.join(cuts, same).select("key", "key_size", "base", (F.col("start") + F.col("extra") - 1).alias("cut"),
                                        "extra")
    limits = ordered.select(F.col("place").alias("cut"), F.col("hash").alias("limit"))
    classed = at.join(limits, "cut", "left").select(
        F.col("key"), F.col("key_size"), "base", F.when(F.col("extra") > 0, F.col("limit")).alias("limit")
    )
    classed, sized = scratch.keep(classed, "limits"), targets.select(
        F.col("source").alias("key"), F.col("words").alias("source_size"), "target"
    )
    extra = {c: free_name(documents, f"_{c}") for c in ("key", "key_size", "base", "limit", "of")}
    classed = classed.withColumnsRenamed(extra)
    sized = sized.withColumnRenamed("key", extra["of"])
    if classed.count() <= BROADCAST_ROWS:  # at least one class per source, so targets are no more
        classed, sized = F.broadcast(classed), F.broadcast(sized)
    origin, size = col(source).cast("string"), F.col(names["_size"])
    one_more = F.coalesce((F.col(names["_hash"]) <= F.col(extra["limit"])).cast("int"), F.lit(0))
    copies = F.coalesce(F.col(extra["base"]) + one_more, F.lit(1))
    rows = measured.join(sized, origin.eqNullSafe(F.col(extra["of"])), "left")
    rows = rows.join(
        classed, origin.eqNullSafe(F.col(extra["key"])) & (size == F.col(extra["key_size"])), "left"
    )
    return rows.select(
        *map(col, kept), copies.cast("int").alias("copies"), size.alias("size"), "source_size", "target"
    )


def expand(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """Each document as often as the mix takes it."""
    copy = free_name(mixed, "_copy")
    repeated = mixed.where("copies > 0").withColumn(copy, F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.select(*map(col, columns))


def op2_entropy_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """What the mix of all documents takes of each."""
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source")
    return mix(documents, Scratch(spark)).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).cast("bigint").alias("taken"), "source", "copies",
    )

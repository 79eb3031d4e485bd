"""Personal data by weak supervision.

Four kinds of spans are defined by exact patterns and always kept. Further candidates, spelled-out
addresses, numbers and names, are proposed widely, and labelers vote on every candidate: patterns, word
lists, the words before it, checksums. Nobody labels any of it by hand: expectation-maximisation over all
votes in the corpus estimates how reliable each labeler is, and the probabilities it gives train a logistic
classifier of spans, which decides which candidates are added. The classifier sees more than the votes: the span's shape
and length, its first and last word and the words around it, hashed.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right, insort
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from funnelmart.llm.labelled import MOST_LABELLED, logistic
from funnelmart.llm.store import Scratch, bounded_batches, col, free_name, text_of

BASE = ("email", "ip", "card", "phone")
ADDED = ("spelled_email", "number", "name")
KINDS = (*BASE, *ADDED)

# The base patterns as stated, but so that no run of characters is gone over once per character of it. An address can
# only start at the start of a run, or where the span before it ended; a number only at its first digit.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+@?")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

AT = re.compile(r"(?=(\[at\]|\(at\)| at ))", re.I)
SPELLED_LOCAL = re.compile(r"[A-Za-z0-9._-]+")
SPELLED_DOMAIN = re.compile(r" ?[A-Za-z0-9-]+ ?(?:\[dot\]|\(dot\)| dot ) ?[A-Za-z]{2,}", re.I)
NUMBER = re.compile(r"(?<![\w.+-])[0-9(][0-9 ().-]{5,24}[0-9](?![\w-])")


def characters(holds: Callable[[str], bool]) -> str:
    """The characters of the basic plane for which this holds, as the inside of a character class."""
    found = [c for c in map(chr, range(0xD800)) if c.isalpha() and holds(c)]
    return "".join(map(re.escape, found))


# every pair of capitalised words, also where pairs overlap
NAME = re.compile(r"(?<!\w)(?=([{0}][{1}]+ [{0}][{1}]+)(?!\w))".format(characters(str.isupper), characters(str.islower)))
DIGIT = re.compile(r"[0-9]")

# Word lists: fixed values.
FIRST_NAMES = frozenset(
    "james john robert michael william david richard joseph thomas charles mary patricia jennifer linda elizabeth "
    "barbara susan jessica sarah karen hans peter klaus anna maria pierre jean marie luc carlos jose juan carmen "
    "daniel matthew anthony mark donald steven paul andrew joshua kenneth kevin brian george edward ronald timothy jason "
    "jeffrey ryan jacob gary nicholas eric jonathan stephen larry justin scott brandon benjamin samuel frank gregory "
    "lisa nancy betty margaret sandra ashley kimberly emily donna michelle carol amanda dorothy melissa deborah "
    "stephanie rebecca sharon laura cynthia kathleen amy angela shirley emma brenda pamela nicole helen samantha "
    "katherine christine rachel olivia sophia julia jürgen wolfgang heinz helmut werner günter dieter manfred uwe "
    "ursula monika petra sabine renate helga karin brigitte ingrid claudia andreas stefan markus christian matthias "
    "philippe michel alain bernard jacques françois nicolas laurent sylvie nathalie isabelle catherine françoise monique "
    "antonio manuel francisco javier miguel pedro alejandro fernando pablo luis ana isabel dolores pilar lucía elena "
    "teresa rosa cristina".split()
)
CUES = frozenset(
    "email mail e-mail contact call phone tel telephone mobile fax cell reach card account iban ssn passport name "
    "mr mrs ms dr herr frau monsieur madame senor senora".split()
)
CALM = frozenset(
    "version license page chapter figure isbn issue section copyright token password sha order year vol no".split()
)
LABELERS = ("base", "shape", "list", "cue", "calm", "checksum")
YES, NO, ABSTAIN = "+", "-", "0"
ACCEPT = 0.5
ROUNDS = 50
TRAITS = 256  # hashed features of a span besides its votes
SPANS_A_PATTERN = 200  # spans of each kind and votes that the classifier is fitted on, each counting for its share
RIDGE = 1e-4  # on the weights of traits, for the mean loss of a span
FIRM = 100.0  # votes are written this large, so that the ridge does not hold their weights back
SPAN = "struct<kind: string, start: int, end: int, pattern: string, traits: array<int>>"
RATED = "struct<kind: string, start: int, end: int, chance: double>"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(DIGIT.findall(text))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses that don't overlap: a run of characters before each @, and a domain behind it."""
    free = 0
    for run in LOCAL.finditer(text):
        start, at = max(run.start(), free), run.end() - 1
        if text[at] == "@" and start < at:
            domain = DOMAIN.match(text, at + 1)
            if domain:
                free = domain.end()
                yield start, free


def spelled_emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost spelled-out addresses that don't overlap; looked for around each "at"."""
    runs = SPELLED_LOCAL.finditer(text)
    run, free = next(runs, None), 0
    for at in AT.finditer(text):
        while run and run.end() < at.start() - 1:
            run = next(runs, None)
        for end in (at.start() - 1, at.start()):  # a space may stand between
            while run and run.end() < end:
                run = next(runs, None)
            if run and run.end() == end and (end == at.start() or text[end] == " "):
                start = max(run.start(), free)
                domain = SPELLED_DOMAIN.match(text, at.end(1)) if end - start >= 2 else None
                if domain:
                    free = domain.end()
                    yield start, free
                    break


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the four fixed kinds, by start and then by kind."""
    out = []
    if "@" in text:
        out += [("email", *span) for span in emails(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                out.append(("ip", *m.span()))
        for m in CARD.finditer(text):
            found = digits_of(m.group())
            if 12 <= len(found) <= 19 and luhn(found):
                out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m.group())) <= 15]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Further spans, apart from the base spans; they may overlap one another."""
    found = []
    low = text.lower()
    if "at" in low and "dot" in low:
        found += [("spelled_email", *span) for span in spelled_emails(text)]
    if DIGIT.search(text):
        found += [("number", *m.span()) for m in NUMBER.finditer(text)]
    found += [("name", *m.span(1)) for m in NAME.finditer(text)]
    starts, ends = [], []  # of the stretches that base spans cover
    for start, end in sorted((s, e) for _, s, e in base):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    out = []
    for kind, start, end in found:
        at = bisect_right(starts, end - 1)
        if not at or ends[at - 1] <= start:
            out.append((kind, start, end))
    return out


def apart(spans: list[tuple[float, int, int, int]]) -> list[int]:
    """Places in ``spans`` (probability, rank of kind, start, end) of those kept, so that none overlap.

    The more probable span goes first, then the earlier kind, then the one that starts first.
    """
    taken: list[tuple[int, int]] = []
    out = []
    for i in sorted(range(len(spans)), key=lambda i: (-spans[i][0], *spans[i][1:])):
        start, end = spans[i][2:]
        at = bisect_right(taken, (start, end))
        if (not at or taken[at - 1][1] <= start) and (at == len(taken) or taken[at][0] >= end):
            insort(taken, (start, end))
            out.append(i)
    return sorted(out)


def traits(text: str, kind: str, start: int, end: int) -> list[int]:
    """Hashed features of a span and its surroundings, whatever the labelers make of it."""
    span = text[start: min(end, start + 200)]
    shape = re.sub(r"[0-9]", "9", re.sub(r"[^\W\d_]+", lambda m: "Aa" if m[0][0].isupper() else "a", span))
    parts = span.lower().split()
    before = re.findall(r"\w+", text[max(0, start - 40): start].lower())[-2:]
    after = re.findall(r"\w+", text[end: end + 40].lower())[:1]
    found = [f"shape {shape[:24]}", f"size {min(end - start, 200).bit_length()}", f"next {text[end: end + 1]}", f"close {text[max(0, start - 1): start]}"]
    found += [f"first {parts[0][:20]}", f"last {parts[-1][:20]}"] if parts else []
    found += [f"before {w[:20]}" for w in before] + [f"after {w[:20]}" for w in after]
    return sorted({zlib.crc32(f"{kind} {x}".encode()) % TRAITS for x in found})


def votes(text: str, kind: str, start: int, end: int, first_names: frozenset[str] = FIRST_NAMES) -> str:
    """One vote per labeler on a span: yes, no or abstain."""
    span = text[start:end]
    digits = digits_of(span)
    before = re.findall(r"[\w-]+", text[max(0, start - 40): start].lower())[-3:]
    shape = ABSTAIN
    if kind in ("phone", "number"):
        shape = YES if re.fullmatch(r"\+?[0-9]{0,3}[ .-]?\(?[0-9]{2,4}\)?[ .-][0-9]{3}[ .-][0-9]{3,4}|[0-9]{3}-[0-9]{2}-[0-9]{4}", span) else NO
    elif kind in ("email", "spelled_email"):
        shape = YES if len(span) < 80 else NO
    listed = ABSTAIN
    if kind == "name":
        listed = YES if span.split()[0].lower() in first_names else NO
    elif kind in ("email", "spelled_email"):
        listed = YES if span.lower().rsplit("." if "." in span else " ", 1)[-1] in ("com", "org", "net", "edu", "de", "fr", "es") else ABSTAIN
    checked = ABSTAIN
    if kind == "card" or (kind == "number" and len(digits) >= 12):
        checked = YES if luhn(digits) else NO
    elif kind == "number" and (len(digits) < 7 or len(set(digits)) <= 2):
        checked = NO
    return "".join((
        YES if kind in BASE else ABSTAIN, shape, listed,
        YES if CUES.intersection(before) else ABSTAIN, NO if CALM.intersection(before) else ABSTAIN, checked,
    ))


def reliabilities(patterns: list[tuple[str, str, int]]) -> np.ndarray:
    """Probability of being personal for each (kind, votes, count), by expectation-maximisation.

    Each labeler has a chance of voting yes, no or not at all on personal spans and on others, alike for all kinds;
    labelers are independent given the truth. Starts from the majority; one pseudo-vote of each sort.
    """
    weight = np.array([n for *_, n in patterns], dtype=float)
    marks = np.array([[(YES, NO, ABSTAIN).index(v) for v in p] for _, p, _ in patterns], dtype=int)
    belief = np.clip(0.5 + 0.2 * ((marks == 0).sum(axis=1) - (marks == 1).sum(axis=1)), 0.05, 0.95)
    for _ in range(ROUNDS):
        prior = (belief @ weight + 1) / (weight.sum() + 2)
        logs = np.full((2, len(patterns)), np.log([[1 - prior], [prior]]))
        for j in range(marks.shape[1]):
            for truth, held in ((0, 1 - belief), (1, belief)):
                share = np.bincount(marks[:, j], weights=held * weight, minlength=3) + 1
                logs[truth] += np.log(share / share.sum())[marks[:, j]]
        belief = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -30, 30)))
    return belief


def beliefs(patterns: list[tuple[str, str, int]]) -> np.ndarray:
    """Reliabilities of names and of all other kinds apart.

    Names are proposed so widely that most spans of a corpus are names and nearly all of those are not personal. Estimated
    together, "is a name" and "is not personal" would come out as the same thing.
    """
    out = np.zeros(len(patterns))
    for names in (True, False):
        places = [i for i, (kind, *_) in enumerate(patterns) if (kind == "name") == names]
        if places:
            out[places] = reliabilities([patterns[i] for i in places])
    return out


def describe(kind: str, pattern: str) -> list[float]:
    """Features of a span for the classifier: its kind and every vote."""
    return [1.0, *[float(kind == k) for k in KINDS], *[float(v == s) for v in pattern for s in (YES, NO)]]


def accepted(patterns: list[tuple[str, str, int]]) -> list[tuple[str, str]]:
    """The (kind, votes) that the classifier takes as personal."""
    return [(kind, votes) for (kind, votes, _), p in zip(patterns, probabilities(patterns)) if p >= ACCEPT]


def probabilities(patterns: list[tuple[str, str, int]]) -> list[float]:
    """Of each (kind, votes, count), by the classifier trained on the estimated probabilities."""
    if not patterns:
        return []
    belief = beliefs(patterns)
    x = np.array([describe(kind, votes) for kind, votes, _ in patterns])
    n = np.array([n for *_, n in patterns], dtype=float)
    # each pattern counts once as personal and once as not, weighted by its probability
    both = np.concatenate([x, x])
    truth = np.concatenate([np.ones(len(x)), np.zeros(len(x))])
    w = logistic(both, truth, ridge=1 / n.sum(), weight=np.concatenate([belief * n, (1 - belief) * n]))
    return (1 / (1 + np.exp(-x @ w))).tolist()


@dataclass(frozen=True)
class Spans:
    """A classifier of spans: a part of its logit by (kind, votes), and weights of hashed traits."""

    by_votes: dict[tuple[str, str], float]
    weights: np.ndarray

    def chance(self, spans: str) -> Column:
        """``spans`` of ADDED kinds rated natively, those below ACCEPT left out."""
        known = {key: logit for key, logit in self.by_votes.items() if key[0] in ADDED}
        logits = F.create_map(*[F.lit(x) for (kind, pattern), logit in known.items() for x in (f"{kind} {pattern}", logit)])
        weights = F.array(*[F.lit(float(w)) for w in self.weights])

        def rated(s: Column) -> Column:
            own = F.aggregate(s["traits"], F.lit(0.0), lambda sum_, t: sum_ + F.element_at(weights, t + 1))
            logit = F.coalesce(F.element_at(logits, F.concat_ws(" ", s["kind"], s["pattern"])), F.lit(-30.0)) + own
            return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), (1 / (1 + F.exp(-logit))).alias("chance"))

        return F.filter(F.transform(F.filter(spans, lambda s: s["kind"].isin(*ADDED)), rated), lambda s: s["chance"] >= ACCEPT)


def fit_spans(rows: list[tuple[str, str, int]], sample: list[tuple[str, str, list[int]]]) -> Spans:
    """Fitted to the probabilities of (kind, votes, count) on spans (kind, votes, traits) that stand for them.

    Every pattern weighs as its count says, however many of its spans are in the sample.
    """
    belief = {(kind, votes_): p for (kind, votes_, _), p in zip(rows, beliefs(rows))}
    count = {(kind, votes_): n for kind, votes_, n in rows}
    drawn = Counter((kind, votes_) for kind, votes_, _ in sample)
    x = np.zeros((len(sample), len(describe(KINDS[0], ABSTAIN * len(LABELERS))) + TRAITS))
    for line, (kind, votes_, own) in zip(x, sample):
        base = describe(kind, votes_)
        line[: len(base)] = FIRM * np.array(base)
        line[len(base) + np.array(own, dtype=int)] = 1.0
    n = np.array([count[k, v] / drawn[k, v] for k, v, _ in sample])
    truth = np.array([belief[k, v] for k, v, _ in sample])
    both = np.concatenate([np.ones(len(x)), np.zeros(len(x))])
    w = logistic(np.concatenate([x, x]), both, ridge=RIDGE, weight=np.concatenate([truth * n, (1 - truth) * n]))
    base = len(w) - TRAITS
    return Spans({(kind, v): FIRM * float(np.dot(describe(kind, v), w[:base])) for kind, v, _ in rows}, w[base:])


def spans_column(text: Column, first_names: frozenset[str] = FIRST_NAMES) -> Column:
    """Base spans and candidates of a text, in one pass; each with the votes on it and its traits."""

    @F.pandas_udf(f"array<{SPAN}>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names = ("kind", "start", "end", "pattern", "traits")
        for texts in batches:
            out = []
            for t in texts:
                base = base_spans(t)
                out.append([dict(zip(names, (*s, votes(t, *s, first_names), traits(t, *s)))) for s in [*base, *candidates(t, base)]])
            yield pd.Series(out, dtype=object)

    return find(text)


def apart_column(spans: Column) -> Column:
    """``spans`` (all accepted) without those that overlap a better one."""

    @F.pandas_udf(f"array<{RATED}>")
    def resolve(rows: pd.Series) -> pd.Series:
        out = []
        for found in rows:
            found = [s if isinstance(s, dict) else s.asDict() for s in found]
            kept = apart([(s["chance"], KINDS.index(s["kind"]), s["start"], s["end"]) for s in found])
            out.append([found[i] for i in kept])
        return pd.Series(out, dtype=object)

    return resolve(spans)


def with_personal_data(documents: DataFrame, scratch: Scratch, text: str = "text", name: str = "spans",
                       columns: list[str] | None = None, first_names: frozenset[str] = FIRST_NAMES) -> DataFrame:
    """``documents`` (or these ``columns`` of it) with ``name``: the personal spans of each, by start and kind.

    A span is (start, rank of its kind, end, kind); places are code points, the end exclusive. Base spans are all there; added spans
    overlap no base span and, the likelier going first, not one another.
    Null and empty texts have none; repeated rows have the same. The votes of all spans in all documents
    are counted by pattern, of which there are at most 7 kinds times 3 to the power of the labelers. The classifier is fitted on
    at most SPANS_A_PATTERN spans of each pattern and MOST_LABELLED in all, chosen by a hash; ``first_names`` is the list of names. A
    column of ``documents`` with that name is replaced; empty input gives no rows.
    """
    bounded_batches(documents.sparkSession)
    kept = [c for c in (documents.columns if columns is None else columns) if c.lower() != name.lower()]
    own = free_name(documents, "_spans")
    found = scratch.keep(documents.select(*map(col, kept), spans_column(text_of(text), first_names).alias(own)), "spans")
    every = found.select(F.explode(own).alias("s")).select("s.*")
    counted = every.groupBy("kind", "pattern").agg(F.count("*").alias("n"))
    rows = sorted((r["kind"], r["pattern"], r["n"]) for r in counted.collect())
    place = F.array(*map(F.lit, KINDS))
    chosen = F.transform(F.filter(own, lambda s: s["kind"].isin(*BASE)), plain_span)
    if any(kind in ADDED for kind, *_ in rows):
        order = W.partitionBy("kind", "pattern").orderBy(F.xxhash64("start", "end", "traits"), "start", "end", "traits")
        most = max(1, min(SPANS_A_PATTERN, MOST_LABELLED // len(rows)))
        taken = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
        sample = sorted((r["kind"], r["pattern"], list(r["traits"])) for r in taken.select("kind", "pattern", "traits").collect())
        added = apart_column(fit_spans(rows, sample).chance(own))
        chosen = F.concat(chosen, F.transform(added, plain_span))
    ordered = F.array_sort(F.transform(chosen, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(place, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")
    )))
    return found.select(*map(col, kept), ordered.alias(name))


def plain_span(s: Column) -> Column:
    return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))


def of_kinds(spans: str, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def listed(spans: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op10_weak_supervision_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document."""
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    found = with_personal_data(documents, Scratch(spark), columns=["doc_id"])
    base = of_kinds("spans", *BASE)
    counts = [F.size(of_kinds("spans", kind)).cast("bigint").alias(f"n_{kind}") for kind in BASE]
    return found.select(
        "doc_id", *counts, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )

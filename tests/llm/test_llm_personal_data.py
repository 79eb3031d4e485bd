from __future__ import annotations

import hashlib
import math
import random
import re
import time

from funnelmart.llm import personal_data as pd
from funnelmart.llm.queries import QUERIES

TEXT = ("Mail bob.x@mail8.example.com, call +1 (988) 555-2485; card 4041894974608795 at 42.144.35.254 or 1.2.3.999. "
        "Version 2.0.1.7, john at host dot com; phone 555-123-4567 😀 +49 30 1234567 a@b 4111-1111-1111-1111 x@y.z.")


def naive(text):
    """The four kinds as stated, one after the other."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if max(map(int, m.group().split("."))) <= 255:
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c.isdigit()]
        double = [d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits[::-1])]
        if 12 <= len(digits) <= 19 and sum(double) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return [(pd.BASE[k], s, e) for s, k, e in sorted(out)]


def test_base_spans_agree_with_their_definition():
    assert pd.base_spans(TEXT) == naive(TEXT)
    assert [k for k, *_ in pd.base_spans(TEXT)] == ["email", "phone", "card", "ip", "ip", "phone", "card", "email"]


def test_query_agrees_on_all_documents(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = QUERIES["op10_weak_supervision_pii"](spark, folder).collect()
    assert len(found) == len(texts)
    for r in found:
        base = naive(texts[r["doc_id"]])
        written = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r["base_sha256"] == hashlib.sha256(written.encode()).hexdigest()
        for kind in pd.BASE:
            assert r[f"n_{kind}"] == sum(k == kind for k, *_ in base)
        spans = [x for x in r["spans"].split(",") if x]
        assert [x for x in spans if x.split(":")[0] in pd.BASE] == [x for x in written.split(",") if x]


def test_added_spans_keep_away_from_base_spans():
    base = pd.base_spans(TEXT)
    added = pd.candidates(TEXT, base)
    assert {k for k, *_ in added} == {"spelled_email", "number"}
    for k, s, e in added:
        assert all(e <= a or s >= b for _, a, b in base)
    places = sorted((s, e) for _, s, e in added)
    assert all(a[1] <= b[0] for a, b in zip(places, places[1:]))


def test_reliabilities_find_the_good_labeler():
    # yes from the first two goes with truth, the checksum says no on the rest
    patterns = [("phone", "++0+00", 300), ("number", "0+0+00", 80), ("number", "0-00--", 200), ("number", "0-0000", 150), ("number", "0+0000", 20)]
    belief = pd.reliabilities(patterns)
    assert belief[0] > 0.9 and belief[1] > 0.5 and belief[2] < 0.1 and belief[3] < 0.5
    assert ("number", "0+0+00") in pd.accepted(patterns) and ("number", "0-00--") not in pd.accepted(patterns)


def test_odd_rows(odd, documents, scratch):
    docs = odd.unionByName(documents([(20, TEXT, "s"), (20, TEXT, "s"), (21, "a@b.c " * 20_000, "s")]))
    found = pd.with_personal_data(docs, scratch).collect()
    assert len(found) == docs.count()
    by_id = {r["doc_id"]: r["spans"] for r in found}
    assert not by_id[1] and not by_id[2] and len(by_id[21]) == 20_000
    assert [(s["kind"], s["start"], s["end"]) for s in by_id[20] if s["kind"] in pd.BASE] == naive(TEXT)
    assert pd.with_personal_data(docs.where("false"), scratch).count() == 0


def test_every_capitalised_pair_is_a_candidate():
    for text, names in (
        ("see Mr John Smith there", {"Mr John", "John Smith"}), ("Contact John Smith", {"Contact John", "John Smith"}),
        ("bei Élodie Müßig.", {"Élodie Müßig"}), ("Wanda Kowalska, SMITH Jones, a1John Smith", {"Wanda Kowalska"}),
    ):
        found = pd.candidates(text, [])
        assert {k for k, *_ in found} == {"name"} and {text[s:e] for _, s, e in found} == names
    text = "Mr John Smith"
    assert pd.votes(text, "name", 3, 13)[2:4] == "++" and pd.votes(text, "name", 0, 7)[2] == "-"


def test_accepted_names_do_not_overlap(documents, scratch):
    rows = [(i, f"call Mr John Smith Road or Mail Maria Gomez; fine words {i}", "s") for i in range(20)]
    rows += [(100 + i, f"Green Field and Blue Water were Quite Nice in {i}", "s") for i in range(60)]
    rows += [(200 + i, f"write to a{i}@b.com or phone +1 (988) 555-2485", "s") for i in range(20)]
    for r in pd.with_personal_data(documents(rows), scratch).collect():
        names = [r["text"][s["start"]:s["end"]] for s in r["spans"] if s["kind"] == "name"]
        assert names == (["John Smith", "Maria Gomez"] if r["doc_id"] < 100 else [])


def test_overlaps_are_left_to_the_likelier_span():
    assert pd.apart([(0.6, 6, 0, 7), (0.9, 6, 3, 13), (0.6, 6, 8, 20), (0.7, 6, 20, 30)]) == [1, 3]
    assert pd.apart([(0.5, 6, 0, 7), (0.5, 4, 3, 13), (0.6, 5, 13, 14)]) == [1, 2]


def test_rare_patterns_count_however_large_the_corpus():
    few = [("phone", "++0+00", 900), ("number", "0+0+00", 800), ("number", "0-00--", 900), ("number", "0-0000", 700)]
    patterns = [("email", "+++000", 50_000_000), *few]
    belief = pd.reliabilities(patterns)
    assert min(belief) < 0.1 and max(belief) > 0.9
    assert pd.accepted(patterns) == [(kind, votes) for (kind, votes, _), p in zip(patterns, belief) if p >= pd.ACCEPT]


def test_many_names_do_not_decide_about_numbers():
    patterns = [("phone", "++0+00", 300), ("number", "0+0+00", 80), ("number", "0-00--", 200), ("number", "0-0000", 150)]
    names = [("name", "00-000", 30_000), ("name", "00++00", 100)]
    assert pd.accepted(patterns + names) == [*pd.accepted(patterns), ("name", "00++00")]


SPELLED = re.compile(r"[A-Za-z0-9._-]{2,} ?(?:\[at\]|\(at\)| at ) ?[A-Za-z0-9-]+ ?(?:\[dot\]|\(dot\)| dot ) ?[A-Za-z]{2,}", re.I)


def test_scans_agree_with_the_patterns_on_random_strings():
    """The patterns as stated, tried from every character, against the scans that try each run once."""
    rng = random.Random(6)
    pieces = ["a", "b1", "@", "@", ".", ".", "_", "-", "%", "1", "23", "255", "256", " ", "+", "(", "4111111111111111", "é"]
    spelled = ["ab", "a", "b1", "x.y", " at ", "[at]", "(AT)", " ", "at", " dot ", "(dot)", "[DOT]", "com", ".", " At "]
    seen = {kind: 0 for kind in pd.BASE}
    for _ in range(30_000):
        text = "".join(rng.choice(rng.choice([pieces, ["1", "23", "255", "256", ".", ".", ". "]])) for _ in range(rng.randrange(30)))
        if rng.random() < 0.3:
            text = "".join(rng.choice(["1", "23", "255", "256", ".", ".", ".", " "]) for _ in range(rng.randrange(30)))
        wanted = naive(text)
        assert pd.base_spans(text) == wanted, text
        for kind, *_ in wanted:
            seen[kind] += 1
        text = "".join(rng.choice(spelled) for _ in range(rng.randrange(14)))
        assert list(pd.spelled_emails(text)) == [m.span() for m in SPELLED.finditer(text)], text
    assert min(seen.values()) > 30


def test_very_long_runs_take_seconds():
    n = 1_000_000
    long = [
        "1" * n, " " + "a" * n + " x@", "a" * n + " at dot", "1." * (n // 2), " at " * (n // 4), "a@" * (n // 2), "a@b." * (n // 4), "+1(" * (n // 3),
        "Ab " * (n // 3), "A" + "b" * n + "1", "a@1.at dot+(" * (n // 12), "ab at " + "c" * n + " dot", "." * n + "@" + "-" * n,
    ]
    started = time.time()
    for text in long:
        pd.candidates(text, pd.base_spans(text))
    assert time.time() - started < 60


def test_long_runs_are_odd_rows_like_others(spark, documents, scratch):
    rows = [(1, "1" * 200_000, "a"), (2, "a" * 200_000 + " x@b.cd", "a"), (3, "z" * 200_000 + " at dot", "a")]
    found = {r["doc_id"]: r["spans"] for r in pd.with_personal_data(documents(rows), scratch).collect()}
    assert not found[1] and not found[3]
    assert [(s["kind"], s["start"], s["end"]) for s in found[2]] == [("email", 200_001, 200_007)]


def test_classifier_learns_from_what_stands_around():
    """Two sorts of numbers on which no labeler votes alike are told apart by the words before them, seen with votes elsewhere."""
    phone = [("number", "0+0+00", pd.traits(f"call me at 555-0{i:02d}-1234 now", "number", 11, 23)) for i in range(80)]
    other = [("number", "0-00--", pd.traits(f"see page no {i:02d}-000 there", "number", 12, 18)) for i in range(80)]
    unsure = [("number", "000000", pd.traits(f"call me at 555-7{i:02d}-1234 now", "number", 11, 23)) for i in range(40)]
    rows = [("number", "0+0+00", 800), ("number", "0-00--", 800), ("number", "000000", 40), ("phone", "++0+00", 500)]
    base = [("phone", "++0+00", pd.traits(f"call me at +1 (988) 555-24{i:02d}", "phone", 11, 28)) for i in range(80)]
    model = pd.fit_spans(rows, phone + other + unsure + base)

    def chance(kind, votes, own):
        return 1 / (1 + math.exp(-model.by_votes[kind, votes] - sum(model.weights[t] for t in own)))

    assert min(chance(*x) for x in phone) > 0.5 > max(chance(*x) for x in other)
    page = pd.traits("see page no 55-000 there", "number", 12, 18)
    assert chance("number", "000000", unsure[0][2]) > chance("number", "000000", page)


def test_the_list_of_names_is_a_parameter(documents, scratch):
    rows = [(i, f"call Mr Zorblax Quux; fine words {i}", "s") for i in range(30)]
    rows += [(100 + i, f"Green Field and Blue Water were Quite Nice in {i}", "s") for i in range(60)]
    rows += [(200 + i, f"write to a{i}@b.com or phone +1 (988) 555-2485", "s") for i in range(20)]
    found = pd.with_personal_data(documents(rows), scratch, first_names=frozenset(["zorblax"])).collect()
    for r in found:
        names = [r["text"][s["start"]:s["end"]] for s in r["spans"] if s["kind"] == "name"]
        assert names == (["Zorblax Quux"] if r["doc_id"] < 100 else [])

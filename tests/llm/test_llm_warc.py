from __future__ import annotations

import base64
import gzip
import hashlib

import numpy as np
import pytest

from funnelmart.llm import warc
from funnelmart.llm.queries import QUERIES

PAGES = "page_id bigint, url string, html string, payload string, run int, position string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], PAGES).repartition(3)


def expected(rows, least=0):
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        last = max(same, default=None)
        revisit = len(data) >= least and last is not None and page != last
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response",
                    last if revisit else None))
    return out


def plain(found):
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return [tuple(r[n] for n in names) for r in found]


ROWS = [
    (1, "http://b.example.com/x", "<p>é𝒳</p>"), (2, "http://a.example.com/", "same"), (3, "http://a.example.com/", "same"),
    (4, None, None), (5, "", ""), (6, "http://a.example.com/\r\nEvil: 1", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n"),
    (None, "http://c.example.com/", "no id"), (7, "http://a.example.com/b c", "z" * 700_000), (2, "http://a.example.com/", "same"),
    (9007199254740993, "http://[bad", "same"), (8, "HTTP://WWW.A.example.com:80/Q?b=1#f", "\r\n\r\n"),
]


def test_round_trip_of_odd_pages(spark, scratch):
    found = warc.archived(pages(spark, ROWS), scratch).collect()
    assert sorted(map(str, plain(found))) == sorted(map(str, expected(ROWS)))
    assert all(r["intact"] for r in found)
    ordered = sorted(found, key=lambda r: r["position"])
    assert [r["position"] for r in ordered] == list(range(1, len(ROWS) + 1))
    keys = [warc.order_of(r["url_key"], r["captured"], None if r["page_id"] is None else str(r["page_id"])) for r in ordered]
    assert keys == sorted(keys)


def test_small_payloads_are_not_revisited(spark, scratch):
    found = warc.archived(pages(spark, ROWS), scratch, least_bytes=5).collect()
    assert sorted(map(str, plain(found))) == sorted(map(str, expected(ROWS, 5)))


def test_slices_merge_to_one_order(spark, scratch, monkeypatch):
    monkeypatch.setattr(warc, "SLICE_ROWS", 40)
    rows = [(i, f"http://h{i % 5}.example.com/{i % 3}" if i % 2 else "http://hot.example.com/", f"p{i % 200}") for i in range(500)]
    found = sorted(warc.archived(pages(spark, rows), scratch).collect(), key=lambda r: r["position"])
    assert [r["position"] for r in found] == list(range(1, 501))
    keys = [(r["url_key"], r["captured"], r["page_id"]) for r in found]
    assert keys == sorted(keys)


def test_empty_table(spark, scratch):
    assert warc.archived(pages(spark, []), scratch).count() == 0


@pytest.mark.parametrize("k", range(9))
def test_loser_tree_merges(k):
    rng = np.random.default_rng(k)
    runs = [sorted(rng.integers(0, 30, rng.integers(0, 12)).tolist()) for _ in range(k)]
    assert list(warc.LoserTree(runs)) == sorted(x for run in runs for x in run)


def test_reader_takes_archives_of_others():
    head = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    body = b"HTTP/1.1 200 OK\r\n\r\nhi"
    record = b"WARC/1.0\r\nWarc-Type: response\r\ncontent-length: %d\r\n\r\n%s\r\n\r\n" % (len(body), body)
    packed = gzip.compress(head) + gzip.compress(record)  # one member per record
    found = list(warc.records(packed))
    assert [(place, headers["warc-type"], block) for place, headers, block in found] == [
        (0, "warcinfo", b"abc"), (len(head), "response", body)]
    assert found == list(warc.records(head + record))


def test_query_covers_every_page(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(f"{folder}/pages.parquet").collect()]
    found = QUERIES["op7_warc_index_merge"](spark, folder).collect()
    assert sorted(map(str, plain(found))) == sorted(map(str, expected(rows)))


def test_many_parts_merge_in_rounds(monkeypatch):
    monkeypatch.setattr(warc, "FAN_IN", 3)
    rng = np.random.default_rng(1)
    parts = [[(x, run) for x in sorted(rng.integers(0, 9, rng.integers(0, 6)).tolist())] for run in range(40)]
    keyed = [[(x, run * 100 + i) for i, (x, _) in enumerate(part)] for run, part in enumerate(parts)]
    assert warc.merge_parts(keyed) == sorted(x for part in keyed for x in part)
    assert warc.merge_parts([]) == []


def test_rows_of_one_key_are_split_and_keep_their_order(spark, scratch, monkeypatch):
    monkeypatch.setattr(warc, "SLICE_ROWS", 30)
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 25)
    rows = [(1, "http://hot.example.com/", "same") for _ in range(300)]
    found = warc.archived(pages(spark, rows), scratch).collect()
    assert sorted(r["position"] for r in found) == list(range(1, 301))
    ordered = [(r["run"], r["seq"]) for r in sorted(found, key=lambda r: r["position"])]
    assert ordered == sorted(ordered) and len({run for run, _ in ordered}) > 3


def test_runs_are_numbered_in_order(spark, scratch):
    runs = warc.read_runs(spark, warc.write_archives(warc.captures(pages(spark, ROWS)), scratch.path("archives")))
    kept = scratch.keep(runs, "runs")
    for run in {r["run"] for r in kept.collect()}:
        own = sorted((r for r in kept.collect() if r["run"] == run), key=lambda r: r["seq"])
        keys = [warc.order_of(r["url_key"], r["captured"], r["page_id"]) for r in own]
        assert keys == sorted(keys) and [r["seq"] for r in own] == list(range(len(own)))


def test_many_repeated_payloads_join_without_a_hot_one(spark, monkeypatch):
    rows = [(i, "u", "" if i % 3 == 0 else f"p{i % 50}") for i in range(300)] + [(1000, "u", "alone")]
    names = ("page_id", "record_type", "refers_to")
    wanted = sorted(map(str, ([r[n] for n in names] for r in warc.captures(pages(spark, rows)).collect())))
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 5)
    monkeypatch.setattr(warc, "HOT_SHARE", 1 / 20)
    assert sorted(map(str, ([r[n] for n in names] for r in warc.captures(pages(spark, rows)).collect()))) == wanted

"""Web archives: writing them, reading them back, and a globally ordered index of their captures.

Records are written by Spark's text writer with the record terminator as line separator, so archives can lie in
any store that Spark reaches. Of captures with equal payloads one is a response, the others revisit it.
Reading goes by Content-Length, and gives one run of index rows per archive, sorted by URL key and time.
Runs are cut at common boundaries, and each slice of the key space is merged from its parts of all runs
by a loser tree. The parts arrive run by run and in the order their run has, by the number that each row was given there, so
nothing is sorted by key again; more parts than FAN_IN are merged in rounds.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from funnelmart.llm.store import Scratch, bounded_batches, broadcast_if, col, text_of

EOL = "\r\n"
RECORD_END = EOL + EOL
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:x-page:"
RECORDS_PER_FILE = 1000
LARGE_PAYLOAD = 256 << 10  # longer payloads get an archive each, so no archive is too large to be read
SLICE_ROWS = 50_000  # expected index rows merged in one task
FAN_IN = 256  # parts that one tree merges
HOT_SHARE = 1 / 200  # payloads of more than this share of all captures are looked up in a broadcast
BROADCAST_ROWS = 200_000
EPOCH = 1704067200  # captures without a time are dated by their id, in seconds from 2024 on

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RADIX32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
# ids travel as text: pandas would make doubles of whole numbers with nulls among them
INDEX = ("run string, seq bigint, url_key string, captured string, page_id string, url string, record_type string, "
         "refers_to string, payload_bytes bigint, payload_digest string, intact boolean, place bigint")


def sha1_base32(data: Column) -> Column:
    """SHA-1 in upper-case base 32; five bytes, ten hex digits, are eight base-32 digits."""
    digits = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), RADIX32, BASE32)


def captures(pages: DataFrame, least_bytes: int = 0, page: str = "page_id", url: str = "url",
             html: str = "html") -> DataFrame:
    """Pages as records to write: payload, size, digest, type, and what a revisit refers to.

    Among captures of equal payloads of at least ``least_bytes`` bytes, those with the largest id are responses;
    the others revisit it. Rows that repeat that id are responses too. A null payload is empty, null ids are smaller than all others.
    """
    payload = text_of(html)
    rows = pages.select(
        col(page).cast("bigint").alias("page_id"), text_of(url).alias("url"), payload.alias("payload"),
        F.octet_length(payload).cast("bigint").alias("payload_bytes"), sha1_base32(payload.cast("binary")).alias("payload_digest"),
    )
    same = (
        rows.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest", "payload_bytes")
        .agg(F.max("page_id").alias("response"), F.count("*").alias("n")).where("n > 1")
        .withColumnsRenamed({"payload_digest": "of_digest", "payload_bytes": "of_bytes"})
    )
    joined = with_response(rows, same)
    revisit = F.col("response").isNotNull() & ~F.col("response").eqNullSafe(F.col("page_id"))
    return joined.select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("response")).alias("refers_to"),
    )


def with_response(rows: DataFrame, same: DataFrame) -> DataFrame:
    """``rows`` with the ``response`` of their payload, null where no other capture has it.

    Few payloads that repeat are broadcast. Of many, those of a large share of all captures are, the empty one among them,
    and payloads meet the others in a join that no payload is hot in.
    """
    met = (F.col("payload_digest") == F.col("of_digest")) & (F.col("payload_bytes") == F.col("of_bytes"))
    least = 0 if same.count() <= BROADCAST_ROWS else rows.count() * HOT_SHARE
    hot = F.broadcast(same.where(F.col("n") > least))
    found = rows.join(hot, met, "left" if least == 0 else "inner")
    if least:
        others = rows.join(hot, met, "left_anti").join(same.where(F.col("n") <= least), met, "left")
        found = found.unionByName(others)
    return found.drop("of_digest", "of_bytes", "n")


def record(row: dict[str, Column]) -> Column:
    """The text of a record, without its end."""
    url = row["url"]
    for control, code in (("\r", "%0D"), ("\n", "%0A"), ("\t", "%09"), (" ", "%20")):
        url = F.replace(url, F.lit(control), F.lit(code))
    seconds = F.pmod(F.coalesce(row["page_id"], F.lit(0)), F.lit(10**9)) + EPOCH
    captured = F.date_format(
        F.expr("timestamp_ntz'1970-01-01'") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)")),
        "yyyy-MM-dd'T'HH:mm:ss'Z'",
    )
    revisit = row["record_type"] == "revisit"
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "),
                    row["payload_bytes"].cast("string"), F.lit(RECORD_END))
    length = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(row["payload_bytes"])

    def identity(of: Column) -> Column:
        return F.concat(F.lit(f"<{ID_PREFIX}"), F.coalesce(of.cast("string"), F.lit("")), F.lit(">"))

    return F.concat(
        F.lit("WARC/1.1" + EOL), F.lit("WARC-Type: "), row["record_type"],
        F.lit(EOL + "WARC-Record-ID: "), identity(row["page_id"]),
        F.lit(EOL + "WARC-Target-URI: "), url, F.lit(EOL + "WARC-Date: "), captured,
        F.lit(EOL + "WARC-Payload-Digest: sha1:"), row["payload_digest"],
        F.when(revisit, F.concat(F.lit(f"{EOL}WARC-Profile: {PROFILE}{EOL}WARC-Refers-To: "), identity(row["refers_to"])))
        .otherwise(F.lit("")),
        F.lit(EOL + "Content-Type: application/http; msgtype=response" + EOL + "Content-Length: "),
        length.cast("string"), F.lit(RECORD_END), http, F.when(revisit, F.lit("")).otherwise(row["payload"]),
    )


def write_archives(rows: DataFrame, path: str) -> list[str]:
    """Write captures as compressed archives below ``path``; returns the folders written."""
    folders = []
    for name, part, most in (
        ("records", rows.where(F.col("payload_bytes") <= LARGE_PAYLOAD), RECORDS_PER_FILE),
        ("large", rows.where(F.col("payload_bytes") > LARGE_PAYLOAD), 1),
    ):
        text = part.select(record({c: F.col(c) for c in part.columns}).alias("value"))
        text.write.options(lineSep=RECORD_END, compression="gzip", maxRecordsPerFile=most).text(f"{path}/{name}")
        folders.append(f"{path}/{name}")
    return folders


def url_key(url: str) -> str:
    """The host in reverse order, then path and query, in lower case: captures of a site sort together."""
    try:
        parts = urlsplit(url.strip().lower())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url.strip().lower()
    labels = host.removeprefix("www.").split(".")
    key = ",".join(reversed(labels)) + (f":{port}" if port not in (None, 80, 443) else "")
    return f"{key}){parts.path.rstrip('/') or '/'}" + (f"?{parts.query}" if parts.query else "")


def records(content: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Place, headers and block of each record of an archive, compressed or not."""
    raw = io.BytesIO(content)
    stream = io.BufferedReader(gzip.GzipFile(fileobj=raw)) if content[:2] == b"\x1f\x8b" else raw
    at = 0
    while True:
        line = stream.readline()
        if not line:
            return
        start, at = at, at + len(line)
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record at byte {start}")
        headers = {}
        while True:
            line = stream.readline()
            at += len(line)
            if not line.strip():
                break
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        block = stream.read(int(headers["content-length"]))
        at += len(block)
        yield start, headers, block


def page_of(identity: str) -> str | None:
    return identity.strip("<>").removeprefix(ID_PREFIX) or None


def index_row(run: str, place: int, headers: dict[str, str], block: bytes) -> tuple:
    head, _, payload = block.partition(b"\r\n\r\n")
    stated = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    kind = headers.get("warc-type", "")
    if kind == "revisit":
        size = next((int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")), 0)
        digest, intact = stated, True
    else:
        size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
        intact = digest == stated
    url = headers.get("warc-target-uri", "")
    return (run, 0, url_key(url), headers.get("warc-date", ""), page_of(headers.get("warc-record-id", "")), url, kind,
            page_of(headers["warc-refers-to"]) if "warc-refers-to" in headers else None, size, digest, intact, place)


def read_runs(spark: SparkSession, folders: list[str]) -> DataFrame:
    """The index rows of all archives; those of one archive are a run, sorted by URL key, time and page."""
    names = [x.split()[0] for x in INDEX.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                rows = [index_row(path, *r) for r in records(content)]
                rows.sort(key=lambda r: order_of(*r[2:5]))
                yield pd.DataFrame(rows, columns=names).assign(seq=range(len(rows)))

    return spark.read.format("binaryFile").load(folders).select("path", "content").mapInPandas(read, INDEX)


def order_of(url_key: str, captured: str, page: str | None) -> tuple:
    return url_key.encode("utf-8", "replace"), captured, page is not None, int(page or 0)


class LoserTree:
    """Merges sorted runs. Each inner node holds the run that lost there, so a step replays one path."""

    def __init__(self, runs: list[list]):
        self.runs, self.at = runs, [0] * len(runs)
        self.width = max(1, len(runs))
        self.losers = [-1] * self.width
        for run in range(len(runs)):
            self.replay(run, building=True)

    def head(self, run: int):
        return self.runs[run][self.at[run]] if self.at[run] < len(self.runs[run]) else None

    def wins(self, a: int, b: int) -> bool:
        x, y = self.head(a), self.head(b)
        return y is None or (x is not None and (x, a) <= (y, b))

    def replay(self, run: int, building: bool = False) -> None:
        node = (run + self.width) // 2
        while node > 0:
            other = self.losers[node]
            if building and other < 0:
                self.losers[node] = run
                return
            if not self.wins(run, other):
                self.losers[node], run = run, other
            node //= 2
        self.losers[0] = run

    def __iter__(self) -> Iterator:
        while self.runs:
            run = self.losers[0]
            item = self.head(run)
            if item is None:
                return
            yield item
            self.at[run] += 1
            self.replay(run)


def merge_parts(parts: list[list]) -> list:
    """All items of sorted parts in order; equal ones in the order of their parts. At most FAN_IN parts at a time."""
    while len(parts) > FAN_IN:
        parts = [list(LoserTree(parts[at: at + FAN_IN])) for at in range(0, len(parts), FAN_IN)]
    return list(LoserTree(parts))


def merged_index(runs: DataFrame, scratch: Scratch) -> DataFrame:
    """All index rows with ``position``, their place (from 1) in the order of URL key, time and page.

    Slices of the key space are chosen so that each holds some SLICE_ROWS rows; since time, page, run and the place in it
    are part of the key, one URL may span many, and so may rows that are equal in all three, which keep the order of
    their runs.
    """
    slices = max(1, runs.count() // SLICE_ROWS)
    names = runs.columns

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = [pdf for pdf in batches if len(pdf)]
        if not frames:
            return
        whole = pd.concat(frames, ignore_index=True)
        parts: dict[str, list] = {}
        for i, (run, *key) in enumerate(zip(whole["run"], whole["url_key"], whole["captured"], whole["page_id"])):
            parts.setdefault(run, []).append((order_of(*key), i))
        out = whole.iloc[[i for _, i in merge_parts(list(parts.values()))]]
        yield out.assign(slice=TaskContext.get().partitionId(), rank=range(1, len(out) + 1))

    keys = [F.asc("url_key"), F.asc("captured"), F.col("page_id").cast("bigint").asc_nulls_first(), F.asc("run"), F.asc("seq")]
    dealt = runs.repartitionByRange(slices, *keys).sortWithinPartitions("run", "seq")
    merged = scratch.keep(dealt.mapInPandas(merge, f"{INDEX}, slice int, rank bigint"), "merged")
    before = W.orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    starts = merged.groupBy("slice").agg(F.count("*").alias("n")).select(
        "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    numbers = ("page_id", "refers_to")
    return merged.join(broadcast_if(starts, BROADCAST_ROWS), "slice").select(
        *[F.col(c).cast("bigint").alias(c) if c in numbers else F.col(c) for c in names], (F.col("start") + F.col("rank")).alias("position")
    )


def archived(pages: DataFrame, scratch: Scratch, least_bytes: int = 0, **columns) -> DataFrame:
    """Write ``pages`` as archives, read them back, and return their index in global order.

    One row per page, nulls and repeated rows among them; an empty table gives none. Columns other than
    those named are ignored.
    """
    bounded_batches(pages.sparkSession)
    folders = write_archives(captures(pages, least_bytes, **columns), scratch.path("archives"))
    runs = scratch.keep(read_runs(pages.sparkSession, folders), "runs")
    return merged_index(runs, scratch)


def op7_warc_index_merge(spark: SparkSession, folder: str) -> DataFrame:
    """All pages through archives and back, in order of capture."""
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html")
    return archived(pages, Scratch(spark)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "position"
    )

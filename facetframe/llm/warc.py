"""WARC archives with revisit records, and their capture index merged from sorted runs.

Every page becomes one record. Of pages with equal payloads (SHA-1 of the UTF-8 bytes) of at least
``min_bytes`` the one with the largest id is a ``response``, the others are ``revisit`` records that
name it and leave the payload out. Archives are text files with CRLF CRLF between records, written
and read by Spark in the session's shared folder, at most ``RECORDS_PER_FILE`` records each.

Reading an archive gives its captures sorted by URL key and time: a run. Sampled keys cut all runs
into the same ranges, and each range merges its pieces of k runs with a loser tree, so the ranges
one after another are the captures of all archives in order. A URL with very many captures is cut by
time and id like any other range.

Defined cases: a null payload is empty; a null URL is written as an empty one; line breaks in a URL
are percent-encoded; repeated rows of the page that is the response are responses; with equal times
captures are ordered by id; a null id is written as ``-`` and read back as null; an empty table gives
no captures; extra columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from facetframe.llm.common import partitions
from facetframe.sources.scratch import scratch_path, stored

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RECORD_END = "\r\n\r\n"
RECORDS_PER_FILE = 5000
MOST_BROADCAST = 500_000
RANGE_ROWS = 250_000
SAMPLES_PER_RANGE = 8
CHUNK = 5000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE = (
    "urlkey string, time string, page_id long, record_type string, payload_bytes long, "
    "payload_digest string, refers_to long, file string, offset long, length long"
)


def sha1_base32(raw: Column) -> Column:
    """The SHA-1 of bytes in upper-case base 32, from five hexadecimal digits at a time."""
    digits = F.sha1(raw)
    letters = []
    for first in range(1, 41, 5):
        number = F.conv(F.substring(digits, first, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            place = F.shiftright(number, shift).bitwiseAND(F.lit(31)) + 1
            letters.append(F.substring(F.lit(BASE32), place, F.lit(1)))
    return F.concat(*letters)


def warc_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """The text of one record per row of ``page_id``, ``url``, ``time`` (ISO, UTC) and ``html``."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce("url", F.lit("")).alias("url"),
        "time",
        html.alias("html"),
        F.octet_length(html).alias("bytes"),
        F.sha1(html.cast("binary")).alias("hex"),
    )
    shared = stored(
        rows.filter(F.col("bytes") >= min_bytes)
        .groupBy("hex", "bytes")
        .agg(F.max("page_id").alias("chosen"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("hex", "bytes", "chosen"),
        "shared_payloads",
    )
    if shared.count() <= MOST_BROADCAST:
        shared = F.broadcast(shared)
    rows = rows.join(shared, ["hex", "bytes"], "left").withColumn(
        "revisit", F.col("chosen").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("chosen"))
    )

    def uri(page: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("-")), F.lit(">"))

    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"),
        F.lit("\r\n\r\n"),
    )
    body = F.when(F.col("revisit"), F.lit("")).otherwise(F.col("html"))
    kept = F.when(F.col("revisit"), F.lit(0)).otherwise(F.col("bytes"))
    target = F.replace(
        F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")
    )
    return rows.select(
        F.concat(
            F.lit("WARC/1.1\r\nWARC-Type: "),
            F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response")),
            F.lit("\r\nWARC-Record-ID: "),
            uri(F.col("page_id")),
            F.lit("\r\nWARC-Date: "),
            F.col("time"),
            F.lit("\r\nWARC-Target-URI: "),
            target,
            F.lit("\r\nWARC-Payload-Digest: sha1:"),
            sha1_base32(F.col("html").cast("binary")),
            F.when(
                F.col("revisit"),
                F.concat(
                    F.lit("\r\nWARC-Refers-To: "),
                    uri(F.col("chosen")),
                    F.lit(f"\r\nWARC-Profile: {PROFILE}"),
                ),
            ).otherwise(F.lit("")),
            F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
            (F.octet_length(http) + kept).cast("string"),
            F.lit("\r\n\r\n"),
            http,
            body,
        ).alias("value")
    )


def write_warc(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    (
        warc_records(pages, min_bytes)
        .write.option("lineSep", RECORD_END)
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(path)
    )


def url_key(url: str) -> str:
    """Host labels reversed, then path and query, in lower case and without scheme or fragment."""
    try:
        parts = urlsplit(url.strip().lower())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url
    host = re.sub(r"^www\d*\.", "", host)
    port = "" if port in (None, 80, 443) else f":{port}"
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}{port}){parts.path or '/'}{query}"


def _page_of(uri: str) -> int | None:
    number = uri.removeprefix("<urn:page:").removesuffix(">")
    return None if number == "-" else int(number)


def parse_records(raw: bytes, file: str) -> list[tuple]:
    """The captures of an archive, found by their stated lengths."""
    captures, at = [], 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at) + 4
        lines = raw[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"{file}: no record at {at}")
        head = dict(line.split(": ", 1) for line in lines[1:] if line)
        stop = end + int(head["Content-Length"])
        payload = raw.index(b"\r\n\r\n", end, stop) + 4
        http = raw[end:payload].decode().split("\r\n")
        size = int(next(x for x in http if x.startswith("Content-Length: "))[16:])
        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
        if head["WARC-Type"] == "response":
            read = base64.b32encode(hashlib.sha1(raw[payload:stop]).digest()).decode()
            if (read, stop - payload) != (digest, size):
                raise ValueError(f"{file}: payload at {payload} differs from its header")
        refers = head.get("WARC-Refers-To")
        captures.append(
            (
                url_key(head["WARC-Target-URI"]),
                re.sub(r"\D", "", head["WARC-Date"]),
                _page_of(head["WARC-Record-ID"]),
                head["WARC-Type"],
                size,
                digest,
                _page_of(refers) if refers else None,
                file,
                at,
                stop - at,
            )
        )
        at = stop + len(RECORD_END)
    return captures


def _order(capture: tuple) -> tuple:
    page = capture[2]
    return capture[0], capture[1], page is not None, page or 0, capture[7], capture[8]


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """The captures of all archives below a path; those of one archive are sorted and stay so."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, raw in zip(batch.column(0), batch.column(1)):
                found = sorted(parse_records(raw.as_py(), name.as_py()), key=_order)
                for first in range(0, len(found), CHUNK):
                    yield _captures(found[first : first + CHUNK])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(read, CAPTURE)


_TYPES = {"string": pa.string(), "long": pa.int64()}
_FIELDS = [(n, _TYPES[t]) for n, t in (x.split() for x in CAPTURE.split(", "))]


def _captures(rows: list[tuple], **more: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in _FIELDS]
    arrays = [pa.array(c, t) for c, (_, t) in zip(columns, _FIELDS)]
    return pa.RecordBatch.from_arrays(
        [*arrays, *(pa.array(v, pa.int64()) for v in more.values())],
        names=[*(n for n, _ in _FIELDS), *more],
    )


class LoserTree:
    """Merges sorted lists: every inner node remembers the loser of its match."""

    def __init__(self, runs: list[list[tuple]]) -> None:
        self.runs = runs
        self.at = [0] * len(runs)
        self.heads = [_order(run[0]) if run else None for run in runs]
        k = max(len(runs), 1)
        self.tree = [-1] * k
        for i in range(len(runs)):
            self._replay(i, building=True)

    def _before(self, i: int, j: int) -> bool:
        a, b = self.heads[i], self.heads[j]
        if a is None or b is None:
            return b is None and a is not None
        return (a, i) < (b, j)

    def _replay(self, winner: int, building: bool = False) -> None:
        node = (winner + len(self.tree)) // 2
        while node > 0:
            other = self.tree[node]
            if other < 0 and building:
                self.tree[node] = winner
                return
            if self._before(other, winner):
                self.tree[node], winner = winner, other
            node //= 2
        self.tree[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.runs and self.heads[self.tree[0]] is not None:
            i = self.tree[0]
            run = self.runs[i]
            yield run[self.at[i]]
            self.at[i] += 1
            self.heads[i] = _order(run[self.at[i]]) if self.at[i] < len(run) else None
            self._replay(i)


def merge_captures(captures: DataFrame) -> DataFrame:
    """All captures with ``range`` and ``rank``, which together are their global order.

    ``captures`` holds sorted runs, one per file, and is stored: it is counted, sampled and read.
    """
    spark = captures.sparkSession
    count = captures.count()
    ranges = max(-(-count // RANGE_ROWS), min(partitions(spark), count), 1)
    wanted = min(1.0, ranges * SAMPLES_PER_RANGE * 4 / max(count, 1))
    # About 32 keys a range: a few hundred thousand for ten billion captures.
    keys = sorted(
        tuple(r)
        for r in captures.select("urlkey", "time", F.coalesce("page_id", F.lit(-1)))
        .sample(fraction=wanted, seed=5)
        .collect()
    )
    cuts = [keys[len(keys) * k // ranges] for k in range(1, ranges)] if keys else []

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns)))
            where = [
                bisect.bisect_right(cuts, (r[0], r[1], -1 if r[2] is None else r[2])) for r in rows
            ]
            yield _captures(rows, range=where)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple]] = {}
        last = None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[-1] != last and held:
                    yield from merged(held, last)
                    held = {}
                last = row[-1]
                held.setdefault(row[7], []).append(row[:-1])
        if held:
            yield from merged(held, last)

    def merged(runs: dict[str, list[tuple]], number: int) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        done = 0
        for row in LoserTree(list(runs.values())):
            rows.append(row)
            if len(rows) == CHUNK:
                yield _captures(rows, range=[number] * len(rows), rank=list(range(done, done + CHUNK)))
                done += len(rows)
                rows = []
        yield _captures(rows, range=[number] * len(rows), rank=list(range(done, done + len(rows))))

    # The pieces of a run keep their order: file and offset in the run are its place, and sorting by
    # them only lines the runs up again after the exchange.
    placed = captures.mapInArrow(cut, f"{CAPTURE}, range long")
    return (
        placed.repartition(ranges, "range")
        .sortWithinPartitions("range", "file", "urlkey", "time", "page_id", "offset")
        .mapInArrow(merge, f"{CAPTURE}, range long, rank long")
    )


def archive_and_index(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write the pages as WARC archives, read them back and merge their index."""
    spark = pages.sparkSession
    path = scratch_path(spark, "archives")
    write_warc(pages, path, min_bytes)
    return merge_captures(stored(read_captures(spark, path), "capture_runs"))

"""WARC archives with a two-level capture index.

Writing: every capture becomes a gzip member of its own in a ``.warc.gz`` file, so a reader can start at
its offset. Captures with equal payloads are written once; later ones are ``revisit`` records that
keep the HTTP headers and refer to the first.

Index: captures are sorted by their URL with the host reversed (``com,example,www)/path``). The sorted
lines are cut into compressed blocks; a sparse directory holds the first and last key of each block.
Both are files per key range. A search first finds the key ranges (a list with one entry per range),
then bisects the directory of a range, inflates the blocks that can hold the key, bisects
their lines, and reads the bytes of just those captures.

Files are written by tasks under names of their own; only files named in a written table count, so a
task that is run again leaves an unused file and no wrong row.

Cases: a null payload counts as empty; a null URL has the key ``-``; a null capture id is written
as an empty one, sorts first and never stands in for other captures; rows repeated with one id and
payload are all responses; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import store
from riskloom.session import materialise, scratch_dir

# Payloads under this size are not worth a reference.
MIN_REVISIT_BYTES = 100
# An archive file is closed after so many bytes.
FILE_BYTES = 1 << 30
LINES_PER_BLOCK = 1000
# Key ranges of an index are its write partitions; the driver holds one pair of keys for each.
MAX_RANGES = 20_000
# Neighbouring captures are read in one go up to this gap and size.
_READ_GAP, _READ_BYTES = 1 << 16, 1 << 23

_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels reversed, then port, path and query; scheme and fragment do not count."""
    if url is None:
        return "-"
    rest = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*://", "", url.strip()).partition("#")[0]
    cut = re.search(r"[/?]", rest)
    host, path = (rest[: cut.start()], rest[cut.start() :]) if cut else (rest, "/")
    host = host.rpartition("@")[2].lower()
    name, colon, port = host.partition(":")
    key = ",".join(reversed(name.split("."))) + (f":{port}" if colon and port not in ("80", "443") else "") + ")" + path
    return re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", key)


def _record(kind: str, url: str | None, capture: int | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    http = _HTTP % len(payload)
    block = http + payload if kind == "response" else http
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:capture:{'' if capture is None else capture}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {'' if url is None else re.sub(r'[\r\n]+', '%0A', url)}",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if kind == "revisit":
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:capture:{refers_to}>",
        ]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode("utf-8") + block + b"\r\n\r\n"


@dataclass(frozen=True)
class Capture:
    """What a record says of its capture."""

    capture: int | None
    kind: str
    payload: bytes | None
    payload_bytes: int
    digest: str
    refers_to: int | None


def parse_record(raw: bytes) -> Capture:
    """Read one record; the digest of a response is taken from its payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    kind = fields["WARC-Type"]
    stated = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response" and (len(body) != size or hashlib.sha256(body).hexdigest() != stated):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")

    def number(name: str) -> int | None:
        digits = fields.get(name, "").removeprefix("<urn:capture:").rstrip(">")
        return int(digits) if digits else None

    return Capture(number("WARC-Record-ID"), kind, body if kind == "response" else None, size, stated, number("WARC-Refers-To"))


def _capture_order(capture: int | None) -> str:
    """Text that sorts like the id, null first."""
    return "" if capture is None else f"{capture + (1 << 63):020d}"


def write_archives(captures: DataFrame, folder: str) -> DataFrame:
    """Write ``capture, url, payload`` rows as WARC files; returns one index row per record.

    Payload digests are folded to their smallest capture id before they meet the payloads, so a payload
    that a third of all captures share is one row there, and its captures may be split over tasks.
    """
    captures = captures.select("capture", "url", F.coalesce(F.col("payload"), F.lit(b"")).alias("payload"))
    keyed = captures.withColumn("digest", F.sha2("payload", 256))
    large = F.octet_length("payload") >= MIN_REVISIT_BYTES
    shared = (
        keyed.filter(large & F.col("capture").isNotNull()).groupBy("digest")
        .agg(F.min("capture").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    )
    marked = keyed.join(shared, "digest", "left").select("capture", "url", "payload", "digest", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = store.filesystem(folder)
        system.create_dir(root, recursive=True)
        out = name = None
        offset = 0
        try:
            for batch in batches:
                rows = []
                for row in batch.to_pylist():
                    if out is None or offset >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = system.open_output_stream(f"{root}/{name}", compression=None)
                    revisit = row["first"] is not None and row["capture"] is not None and row["capture"] != row["first"]
                    kind = "revisit" if revisit else "response"
                    raw = _record(kind, row["url"], row["capture"], row["payload"], row["digest"], row["first"])
                    member = gzip.compress(raw, 4, mtime=0)
                    out.write(member)
                    rows.append({"key": url_key(row["url"]), "capture": row["capture"], "file": name, "offset": offset, "length": len(member)})
                    offset += len(member)
                yield pa.RecordBatch.from_pylist(rows, schema=_ENTRY)
        finally:
            if out is not None:
                out.close()

    return materialise(marked.mapInArrow(run, _ENTRY_SQL), "captures")


_ENTRY = pa.schema([("key", pa.string()), ("capture", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
_ENTRY_SQL = "key string, capture bigint, file string, offset bigint, length bigint"


@dataclass(frozen=True)
class CaptureIndex:
    """Key ranges of a written index, in key order: (first key, last key, file stem)."""

    folder: str
    ranges: list[tuple[str, str, str]]


def build_index(entries: DataFrame, folder: str) -> CaptureIndex:
    """Sort index rows by key and capture; write blocks and their directory for each range.

    Captures of one URL are ordered by id, so a URL with a third of all captures spans ranges and blocks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = store.filesystem(folder)
        system.create_dir(root, recursive=True)
        stem, directory, held, offset, out = uuid.uuid4().hex, [], [], 0, None

        def close_block() -> None:
            nonlocal offset
            data = zlib.compress("\n".join(" ".join(line) for line in held).encode("utf-8"))
            out.write(data)
            directory.append(f"{held[0][0]} {held[-1][0]} {offset} {len(data)}")
            offset += len(data)
            held.clear()

        for batch in batches:
            for key, _, *place in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if out is None:
                    out = system.open_output_stream(f"{root}/{stem}.cdx", compression=None)
                held.append((key, *map(str, place)))
                if len(held) == LINES_PER_BLOCK:
                    close_block()
        if out is None:
            return
        if held:
            close_block()
        out.close()
        with system.open_output_stream(f"{root}/{stem}.idx", compression=None) as listing:
            listing.write("\n".join(directory).encode("utf-8"))
        first, last = directory[0].split(" ")[0], directory[-1].split(" ")[1]
        yield pa.RecordBatch.from_pylist([{"first": first, "last": last, "stem": stem}])

    order = ["key", F.asc_nulls_first("capture"), "file", "offset"]
    ranges = materialise(
        entries.repartitionByRange("key", F.asc_nulls_first("capture")).sortWithinPartitions(*order).mapInArrow(
            run, "first string, last string, stem string"
        ),
        "ranges",
    )
    rows = ranges.limit(MAX_RANGES + 1).collect()  # one per write partition
    if len(rows) > MAX_RANGES:
        raise ValueError(f"an index has at most {MAX_RANGES} ranges; write it with fewer partitions")
    return CaptureIndex(folder, sorted((r["first"], r["last"], r["stem"]) for r in rows))


class _Range:
    """Directory of one key range and the block inflated last."""

    def __init__(self, folder: str, stem: str) -> None:
        system, root = store.filesystem(folder)
        with system.open_input_file(f"{root}/{stem}.idx") as file:
            lines = [line.split(" ") for line in file.read().decode("utf-8").split("\n")]
        self.first, self.last = [x[0] for x in lines], [x[1] for x in lines]
        self.place = [(int(x[2]), int(x[3])) for x in lines]
        self._file = system.open_input_file(f"{root}/{stem}.cdx")
        self._block, self._lines, self._keys = -1, [], []

    def find(self, key: str) -> Iterator[list[str]]:
        """Lines of all captures with the key."""
        for block in range(bisect_left(self.last, key), bisect_right(self.first, key)):
            if block != self._block:
                offset, length = self.place[block]
                self._lines = zlib.decompress(self._file.read_at(length, offset)).decode("utf-8").split("\n")
                self._keys, self._block = [line.split(" ", 1)[0] for line in self._lines], block
            for at in range(bisect_left(self._keys, key), bisect_right(self._keys, key)):
                yield self._lines[at].split(" ")


def lookup(index: CaptureIndex, urls: DataFrame) -> DataFrame:
    """Where the captures of each distinct ``url`` lie: key, file, offset, length."""
    firsts, lasts = [r[0] for r in index.ranges], [r[1] for r in index.ranges]
    stems, folder = [r[2] for r in index.ranges], index.folder

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [url_key(u) for u in batch.column(0).to_pylist()]
            hits = [(k, r) for k in keys for r in range(bisect_left(lasts, k), bisect_right(firsts, k))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in hits], pa.string()), pa.array([r for _, r in hits], pa.int32())], names=["key", "place"]
            )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, opened = None, None
        for batch in batches:
            rows = []
            for key, place in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if place != at:
                    at, opened = place, _Range(folder, stems[place])
                for _, file, offset, length in opened.find(key):
                    rows.append({"key": key, "file": file, "offset": int(offset), "length": int(length)})
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_pylist(rows, schema=_FOUND)
                        rows = []
            yield pa.RecordBatch.from_pylist(rows, schema=_FOUND)

    wanted = urls.select("url").distinct().mapInArrow(spread, "key string, place int").distinct()
    near = wanted.repartitionByRange("place", "key").sortWithinPartitions("place", "key")
    return near.mapInArrow(search, "key string, file string, offset bigint, length bigint")


_FOUND = pa.schema([("key", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
_READ = pa.schema([("capture", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
_READ_SQL = "capture bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"


def read_captures(found: DataFrame, folder: str, payload: bool = True) -> DataFrame:
    """Read the records at the places found. Places are dealt by file and offset, so near ones are read together."""

    def read(places: list[tuple[str, int, int]], system, root: str, opened: list) -> Iterator[bytes]:
        at = 0
        while at < len(places):
            name, start, length = places[at]
            upto, end = at + 1, start + length
            while upto < len(places) and places[upto][0] == name and places[upto][1] - end <= _READ_GAP and places[upto][1] + places[upto][2] - start <= _READ_BYTES:
                end = max(end, places[upto][1] + places[upto][2])
                upto += 1
            if not opened or opened[0] != name:
                opened[:] = [name, system.open_input_file(f"{root}/{name}")]
            data = opened[1].read_at(end - start, start)
            for _, offset, size in places[at:upto]:
                yield gzip.GzipFile(fileobj=io.BytesIO(data[offset - start : offset - start + size])).read()
            at = upto

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = store.filesystem(folder)
        opened: list = []
        for batch in batches:
            places = list(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True))
            for start in range(0, len(places), 500):
                rows = []
                for raw in read(places[start : start + 500], system, root, opened):
                    c = parse_record(raw)
                    rows.append({"capture": c.capture, "payload_bytes": c.payload_bytes, "payload_digest": c.digest, "record_type": c.kind,
                                 "refers_to": c.refers_to, "payload": c.payload if payload else None})
                yield pa.RecordBatch.from_pylist(rows, schema=_READ)

    dealt = found.select("file", "offset", "length").repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(run, _READ_SQL)


def op1_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    folder = scratch_dir(spark, "warc")
    captures = pages.select(
        F.col("page_id").cast("long").alias("capture"), F.col("url").cast("string").alias("url"), F.encode("html", "UTF-8").alias("payload")
    )
    index = build_index(write_archives(captures, f"{folder}/archive"), f"{folder}/index")
    read = read_captures(lookup(index, captures), f"{folder}/archive", payload=False)
    return read.select(F.col("capture").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


OP1_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS h FROM p),
f AS (SELECT h, min(page_id) AS first FROM d WHERE n >= 100 GROUP BY h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, h AS payload_digest,
  CASE WHEN first IS NOT NULL AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first IS NOT NULL AND page_id <> first THEN first END AS refers_to
FROM d LEFT JOIN f USING (h)
"""

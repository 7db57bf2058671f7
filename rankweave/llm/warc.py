"""WARC archives of pages: a writer that records repeated payloads once, and a
reader that splits files and keeps only records proven by the boundary chain.

Reading is in two passes over byte ranges. The first looks for the record magic
anywhere, payloads included, and emits for each find where its record would end
and where the chain of records from it leaves the range. Pointer jumping over
these exits, from the start of each file, gives the one entry of each range
that is reachable; finds that no chain from the start meets are payload bytes.
The second pass walks each range from its entry.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.runtime import scratch_path

from .common import range_bounds, range_numbers, stored
from .files import open_file, write_file

MAGIC = b"WARC/1.1\r\n"
BREAK = b"\r\n\r\n"
SPLIT_BYTES = 8 << 20
# Payloads under this size are never made revisits.
LEAST_REVISIT = 100
_DATE = "2000-01-01T00:00:00Z"
_STEP = 1 << 16


# -- writing ---------------------------------------------------------------------


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record: a response with its payload, or a revisit with the HTTP head only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    body = http.encode() + (payload if refers_to is None else b"")
    lines = [
        MAGIC.decode().strip(),
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {_DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=_URL_SAFE)}")
    if refers_to is not None:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    return "\r\n".join(lines).encode() + BREAK + body + BREAK


_URL_SAFE = "".join(map(chr, range(33, 127))).replace("%", "")


def write_archives(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write a record per page into files by ranges of page_id.

    Of records with equal payloads of at least 100 bytes, the one with the
    smallest page_id is a response and the rest are revisits of it. A null html
    is an empty payload. A null page_id comes first and is never referred to.
    Repeated rows of one page_id: the first holds the payload. Returns the
    manifest: path and n_bytes of each file. Other columns are not read.
    """
    spark = pages.sparkSession
    root = path or scratch_path(spark, "warc")
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), html.alias("html"))
    keyed = rows.where(F.octet_length("html") >= LEAST_REVISIT).select(
        "page_id", F.unhex(F.sha2(F.col("html").cast("binary"), 256)).alias("digest")
    )
    # Copies are counted before they meet: one row for a payload, whatever its copies.
    groups = keyed.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    repeated = groups.where("n > 1 AND first IS NOT NULL").select("digest", "first")
    later = keyed.join(repeated, "digest").where(F.col("page_id").isNull() | (F.col("page_id") > F.col("first")))
    cuts = np.array(range_bounds(rows, "page_id"), np.int64)

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=9)
        for batch in batches:
            raw = [h.encode("utf-8", "surrogatepass") for h in batch.column(2).to_pylist()]
            yield pa.record_batch({
                "part": pa.array(range_numbers(batch.column(0), cuts)),
                "page_id": batch.column(0),
                "digest": pa.array([hashlib.sha256(x).digest() for x in raw], pa.binary()),
                "first": pa.nulls(batch.num_rows, pa.int64()),
                "url": batch.column(1),
                "payload": pa.array([packer.compress(x) for x in raw], pa.binary()),
            })

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = pa.array(range_numbers(batch.column(0), cuts))
            yield pa.record_batch([part, *batch.columns], ["part", "page_id", "digest", "first"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, records, known = None, [], {}
        seen: tuple = (None, set())
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != part:
                    if records:
                        yield _archive(root, part, records)
                    part, records, known, seen = row[0], [], {}, (None, set())
                _, page_id, digest, first, url, packed = row
                if packed is None:
                    known[page_id, digest] = first
                    continue
                payload = unpacker.decompress(packed) if packed else b""
                refers = known.get((page_id, digest))
                if seen[0] != page_id:
                    seen = (page_id, set())
                if refers is None and digest in seen[1] and page_id is not None and len(payload) >= LEAST_REVISIT:
                    refers = page_id
                seen[1].add(digest)
                records.append(record(page_id, url, payload, digest.hex(), refers))
        if records:
            yield _archive(root, part, records)

    shape = "part int, page_id long, digest binary, first long"
    payloads = rows.mapInArrow(shrink, shape + ", url string, payload binary")
    notes = later.select("page_id", "digest", "first").mapInArrow(place, shape)
    notes = notes.select("*", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"))
    dealt = payloads.unionByName(notes).repartition(len(cuts) + 1, "part")
    sorted_rows = dealt.sortWithinPartitions(
        "part", F.col("page_id").asc_nulls_first(), F.col("first").desc_nulls_last(), "digest", "url"
    )
    return stored(sorted_rows.mapInArrow(write, "path string, n_bytes long"), "warc-manifest")


def _archive(root: str, part: int, records: list[bytes]) -> pa.RecordBatch:
    path = f"{root}/part-{part:08d}.warc"
    return pa.record_batch({"path": [path], "n_bytes": pa.array([write_file(path, records)], pa.int64())})


# -- reading ---------------------------------------------------------------------


class _Range:
    """Bytes of a file, read as far as they are asked for."""

    def __init__(self, source: pa.NativeFile, start: int, end: int):
        self.source, self.start = source, start
        self.size = source.size()
        source.seek(start)
        self.held = source.read(min(end, self.size) - start)

    def get(self, a: int, b: int) -> bytes:
        b = min(b, self.size)
        if b > self.start + len(self.held):
            self.source.seek(self.start + len(self.held))
            self.held += self.source.read(b - self.start - len(self.held))
        return self.held[a - self.start:b - self.start]

    def head(self, at: int) -> tuple[dict[str, str], int] | None:
        """Fields and end of the record head at a place; None where there is none."""
        step = _STEP
        while True:
            raw = self.get(at, at + step)
            if not raw.startswith(MAGIC):
                return None
            end = raw.find(BREAK)
            if end >= 0:
                lines = raw[len(MAGIC):end].decode("utf-8", "replace").split("\r\n")
                fields = dict(line.split(": ", 1) for line in lines if ": " in line)
                return fields, at + end + len(BREAK)
            if at + step >= self.size or step > 1 << 24:
                return None
            step *= 4

    def after(self, at: int) -> int | None:
        """Where the next record would start, if a whole record stands here."""
        head = self.head(at)
        if head is None or not re.fullmatch("[0-9]{1,18}", head[0].get("Content-Length", "")):
            return None
        end = head[1] + int(head[0]["Content-Length"]) + len(BREAK)
        return end if end <= self.size else None


def candidates(held: _Range, start: int, end: int) -> list[tuple[int, int]]:
    """Every find of the magic in a range, and where the chain from it leaves the range."""
    raw = held.get(start, end + len(MAGIC) - 1)
    finds = [m.start() + start for m in re.finditer(re.escape(MAGIC), raw) if m.start() + start < end]
    leaves: dict[int, int | None] = {}
    for at in reversed(finds):
        after = held.after(at)
        leaves[at] = after if after is None or after >= end else leaves.get(after)
    return [(at, leaves[at]) for at in finds if leaves[at] is not None]


def reachable_entries(ranges: DataFrame, jumps: int) -> DataFrame:
    """(path, start, end, entry) of each range that a chain from the file's start enters.

    ``jumps`` doublings reach over 2**jumps ranges.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                with open_file(path) as source:
                    got = candidates(_Range(source, start, end), start, end)
                if got:
                    yield pa.record_batch({
                        "path": [path] * len(got),
                        "at": pa.array([g[0] for g in got], pa.int64()),
                        "leaves": pa.array([g[1] for g in got], pa.int64()),
                    })

    reached = ranges.where("start = 0").select("path", F.lit(0).cast("long").alias("at"))
    if jumps:
        links = stored(ranges.mapInArrow(find, "path string, at long, leaves long"), "warc-links")
        for step in range(jumps):
            onward = reached.join(links, ["path", "at"]).select("path", F.col("leaves").alias("at"))
            reached = stored(reached.union(onward).distinct(), "warc-reached")
            if step + 1 < jumps:
                far = links.select("path", F.col("at").alias("leaves"), F.col("leaves").alias("far"))
                links = stored(
                    links.join(far, ["path", "leaves"], "left")
                    .select("path", "at", F.coalesce("far", "leaves").alias("leaves")), "warc-links",
                )
    inside = ranges.withColumn("slot", F.floor(F.col("start") / SPLIT_BYTES))
    entries = reached.withColumn("slot", F.floor(F.col("at") / SPLIT_BYTES)).withColumnRenamed("at", "entry")
    return inside.join(entries, ["path", "slot"]).select("path", "start", "end", "entry")


def read_archives(manifest: DataFrame) -> DataFrame:
    """A row per record of the files in a manifest (path, n_bytes).

    page_id, payload_bytes, payload_digest, record_type, refers_to. The digest
    of a response is taken from its payload and held against its head; a file
    whose chain breaks raises.
    """
    spark = manifest.sparkSession
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("n_bytes") - 1, F.lit(0)),
                                  F.lit(SPLIT_BYTES).cast("long")))
    ranges = manifest.where("n_bytes > 0").select("path", "n_bytes", starts.alias("start"))
    ranges = ranges.select("path", "start", F.least(F.col("start") + SPLIT_BYTES, "n_bytes").alias("end"))
    ranges = ranges.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "start")
    most = manifest.agg(F.max("n_bytes").alias("n")).first().n or 0
    entries = reachable_entries(ranges, max(0, -(-most // SPLIT_BYTES) - 1).bit_length())

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, end, entry in zip(*(c.to_pylist() for c in batch.columns)):
                rows = []
                with open_file(path) as source:
                    held = _Range(source, start, end)
                    while entry < end:
                        row, entry = _parsed(held, path, entry)
                        rows.append(row)
                yield pa.RecordBatch.from_pylist(rows, _RECORD)

    return entries.mapInArrow(
        walk, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )


_RECORD = pa.schema([
    ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()),
])


def _page(field: str | None) -> int | None:
    found = re.fullmatch("<urn:page:(-?[0-9]+)>", field or "")
    return int(found[1]) if found else None


def _parsed(held: _Range, path: str, at: int) -> tuple[dict, int]:
    after = held.after(at)
    if after is None:
        raise ValueError(f"no record at {at} of {path}")
    fields, begin = held.head(at)
    body = held.get(begin, after - len(BREAK))
    http = body.index(BREAK) + len(BREAK)
    size = int(re.search(rb"\r\nContent-Length: ([0-9]+)", body[:http])[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if fields["WARC-Type"] == "response" and hashlib.sha256(body[http:]).hexdigest() != digest:
        raise ValueError(f"damaged payload at {at} of {path}")
    return {
        "page_id": _page(fields["WARC-Record-ID"]), "payload_bytes": size, "payload_digest": digest,
        "record_type": fields["WARC-Type"], "refers_to": _page(fields.get("WARC-Refers-To")),
    }, after

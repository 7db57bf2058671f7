"""Token files: frequency-ranked ids in byte-aligned variable-length coding.

An id is stored as its rank by corpus frequency, in 1 to 4 bytes. The lengths
stand apart, two bits each, four to a control byte, so that decoding is a table
lookup on the control bytes and a few gathers on the data bytes.

A file: the magic, then little-endian 64-bit numbers of documents, ids and data
bytes; per document its id (64 bit, with a byte for null) and its number of
tokens (64 bit); the control bytes; the data bytes. The rank table is a file of its own:
32-bit ids by rank.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankweave.runtime import scratch_path

from .common import range_bounds, range_numbers, stored, text_or_empty, text_slices
from .files import open_file, write_file
from .tokens import END, encoder

MAGIC = b"FRTOKEN1"
# Lengths of the four values under a control byte, lowest bits first.
_LENGTHS = np.array([[(c >> 2 * j & 3) + 1 for j in range(4)] for c in range(256)], np.uint8)


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of 32-bit ranks."""
    ranks = ranks.astype("<u4")
    sizes = 1 + (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = sizes - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    kept = np.arange(4, dtype=np.uint8) < sizes[:, None]
    return control.astype(np.uint8).tobytes(), ranks.view(np.uint8).reshape(-1, 4)[kept].tobytes()


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ranks again: lengths by table, then one gather per byte place."""
    sizes = _LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n].astype(np.int64)
    at = np.cumsum(sizes) - sizes
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(3, np.uint8)])
    out = raw[at].astype(np.uint32)
    for place in range(1, int(sizes.max(initial=1))):
        rows = np.flatnonzero(sizes > place)
        out[rows] |= raw[at[rows] + place].astype(np.uint32) << np.uint32(8 * place)
    return out


def token_table(docs: DataFrame, tokenizer: str, name: str = "ids") -> DataFrame:
    """doc_id and the ids of each whole text without the end id, as a written table."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = encoder(tokenizer)
        for batch in batches:
            for part in text_slices(batch, 1):
                raw = held.encode(part.column(1).to_pylist())
                yield pa.record_batch({"doc_id": part.column(0), "ids": pa.array(raw, pa.binary())})
        held.rest()

    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    return stored(rows.mapInArrow(encode, "doc_id long, ids binary"), name)


def frequency_ranks(ids: DataFrame, tokenizer: str) -> np.ndarray:
    """Ids of the vocabulary by falling frequency over all documents, ties by id.

    As long as the vocabulary, so it is held by the driver and every task.
    """
    size = encoder(tokenizer).size

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = encoder(tokenizer), np.zeros(size, np.int64)
        for batch in batches:
            for raw in batch.column(0):
                got = np.frombuffer(raw.as_buffer(), held.dtype)
                total += np.bincount(got, minlength=size) if len(got) > size else 0
                if len(got) <= size:
                    np.add.at(total, got, 1)
            total[held.end] += batch.num_rows
        seen = np.flatnonzero(total)
        yield pa.record_batch({"id": pa.array(seen, pa.int64()), "n": pa.array(total[seen], pa.int64())})

    counted = ids.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    times = np.zeros(size, np.int64)
    for row in counted.collect():
        times[row.id] = row.n
    return np.lexsort((np.arange(size), -times)).astype("<u4")


def write_token_files(docs: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    """Encode all documents into token files, in ascending doc_id order over the files.

    Returns the manifest, one row a file: part, path, n_docs, n_ids. The files
    are the ranges of doc_id, so their order is the order of the documents. A
    null text is empty; a null doc_id comes first; rows of equal doc_id follow
    each other in the order of their ids.
    """
    spark = docs.sparkSession
    root = path or scratch_path(spark, "token-files")
    table = token_table(docs, tokenizer)
    order = frequency_ranks(table, tokenizer)
    write_file(f"{root}/ranks.bin", [order.tobytes()])
    rank_of = np.empty(len(order), "<u4")
    rank_of[order] = np.arange(len(order), dtype="<u4")
    cuts = np.array(range_bounds(table, "doc_id"), np.int64)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = encoder(tokenizer)
        for batch in batches:
            coded = []
            for raw in batch.column(1):
                ids = held.ids(raw.as_py())
                coded.append((len(ids), *encode_ranks(rank_of[ids])))
            yield pa.record_batch({
                "part": pa.array(range_numbers(batch.column(0), cuts)),
                "doc_id": batch.column(0),
                "n": pa.array([c[0] for c in coded], pa.int64()),
                "control": pa.array([c[1] for c in coded], pa.binary()),
                "data": pa.array([c[2] for c in coded], pa.binary()),
            })

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows = None, []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in range(5))):
                if row[0] != part and rows:
                    yield _file(root, part, rows)
                    rows = []
                part = row[0]
                rows.append(row[1:])
        if rows:
            yield _file(root, part, rows)

    coded = table.mapInArrow(code, "part int, doc_id long, n long, control binary, data binary")
    dealt = coded.repartition(len(cuts) + 1, "part").sortWithinPartitions(
        "part", F.col("doc_id").asc_nulls_first(), "data", "control"
    )
    return stored(dealt.mapInArrow(write, "part int, path string, n_docs long, n_ids long"), "token-manifest")


def _file(root: str, part: int, rows: list) -> pa.RecordBatch:
    """Write the documents of one range; a document starts at a whole control byte."""
    counts = np.array([r[1] for r in rows], "<i8")
    head = np.array([len(rows), counts.sum(), sum(len(r[3]) for r in rows)], "<i8")
    nulls = np.array([r[0] is None for r in rows], np.uint8)
    names = np.array([r[0] or 0 for r in rows], "<i8")
    path = f"{root}/part-{part:08d}.tok"
    pieces = [MAGIC, head.tobytes(), nulls.tobytes(), names.tobytes(), counts.tobytes()]
    write_file(path, [*pieces, *[r[2] for r in rows], *[r[3] for r in rows]])
    return pa.record_batch({
        "part": pa.array([part], pa.int32()), "path": [path],
        "n_docs": pa.array([len(rows)], pa.int64()), "n_ids": pa.array([int(head[1])], pa.int64()),
    })


def read_token_file(path: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """doc_id and ids of each document of a file, decoded by the rank table beside it."""
    with open_file(f"{path.rpartition('/')[0]}/ranks.bin") as source:
        order = np.frombuffer(source.read(), "<u4")
    with open_file(path) as source:
        if source.read(8) != MAGIC:
            raise ValueError(f"not a token file: {path}")
        n, _, size = np.frombuffer(source.read(24), "<i8")
        nulls = np.frombuffer(source.read(n), np.uint8)
        names = np.frombuffer(source.read(8 * n), "<i8")
        counts = np.frombuffer(source.read(8 * n), "<i8")
        controls = -(-counts // 4)
        control = source.read(int(controls.sum()))
        data = source.read(int(size))
    widths = _LENGTHS[np.frombuffer(control, np.uint8)].sum(axis=1, dtype=np.int64)
    seen = np.concatenate([[0], np.cumsum(widths)])
    a = b = 0
    for i in range(n):
        end = a + int(controls[i])
        # The last control byte of a document counts its empty places as one byte each.
        span = int(seen[end] - seen[a]) - (-int(counts[i]) % 4)
        ranks = decode_ranks(control[a:end], data[b:b + span], int(counts[i]))
        yield (None if nulls[i] else int(names[i])), order[ranks]
        a, b = end, b + span


def read_tokens(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from its file.

    ``start`` counts the ids of all documents before it: those of the files
    before, added up over the manifest, and those before it in its own file.
    """
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.select("path", "part", F.coalesce(F.sum("n_ids").over(ahead), F.lit(0)).alias("base"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                names, starts, counts, sums = [], [], [], []
                for name, ids in read_token_file(path):
                    names.append(name)
                    starts.append(base)
                    counts.append(len(ids))
                    sums.append(zlib.crc32(ids.tobytes()))
                    base += len(ids)
                yield pa.record_batch({
                    "doc_id": pa.array(names, pa.int64()), "start": pa.array(starts, pa.int64()),
                    "n_tokens": pa.array(counts, pa.int64()), "ids_crc32": pa.array(sums, pa.int64()),
                })

    files = based.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "part").select("path", "base")
    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")

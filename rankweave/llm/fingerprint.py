"""Document fingerprints: bottom-k sketches of word-shingle hashes."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import range_bounds, range_bucket, range_numbers, shingle_hashes, text_or_empty

K = 128
WORDS = 5
_LEAST = -(1 << 63)
# A sketch value has 48 bits: 8 characters of base64.
VALUE_BYTES = 6


def _encoded(values: np.ndarray) -> str:
    """Big-endian 48-bit values as text."""
    rows = values.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - VALUE_BYTES:]
    return base64.b64encode(rows.tobytes()).decode()


def decoded(sketch: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(sketch), np.uint8).reshape(-1, VALUE_BYTES)
    full = np.zeros((len(raw), 8), np.uint8)
    full[:, 8 - VALUE_BYTES:] = raw
    return full.view(">u8").ravel().astype(np.uint64)


def bottom_k(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """The k smallest distinct hashes, ascending."""
    return np.unique(hashes >> np.uint64(64 - 8 * VALUE_BYTES))[:k]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """Sketch of the union of two sets, from their sketches."""
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity; exact when both sets have at most k/2 shingles.

    Two empty sets are alike (1.0), an empty and another one are not (0.0).
    """
    both = merge(a, b, k)
    if not len(both):
        return 1.0
    shared = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(both, shared, assume_unique=True).sum() / len(both))


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of the shingles of ``a`` that ``b`` has; 1.0 for an empty ``a``.

    Only values under the smaller of the two sketches' limits can be judged.
    """
    if not len(a):
        return 1.0
    limit = min(a[-1] if len(a) == k else _TOP, b[-1] if len(b) == k else _TOP)
    seen = a[a <= limit]
    return float(np.isin(seen, b).mean()) if len(seen) else 0.0


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact below k."""
    return float(len(a)) if len(a) < k else (k - 1) / (float(a[-1]) / float(_TOP))


_TOP = np.uint64((1 << (8 * VALUE_BYTES)) - 1)


def sketches(texts: list[str], k: int = K, words: int = WORDS) -> list[np.ndarray]:
    hashes, first = shingle_hashes([t.encode("utf-8", "surrogatepass") for t in texts], words)
    return [bottom_k(hashes[a:b], k) for a, b in zip(first[:-1], first[1:])]


def fingerprint(text: Column, k: int = K, words: int = WORDS) -> Column:
    """Sketch of a text column as an Arrow UDF; null is as an empty text."""

    @F.arrow_udf("string")
    def made(batch: pa.Array) -> pa.Array:
        out: list[str] = []
        texts = [t or "" for t in batch.to_pylist()]
        for a in range(0, len(texts), 256):
            out += map(_encoded, sketches(texts[a:a + 256], k, words))
        return pa.array(out, pa.string())

    return made(text)


def merged(k: int = K):
    """Aggregate of sketches: the sketch of the union of all parts."""
    @F.pandas_udf("string")
    def union(parts: pd.Series) -> str:
        total = np.zeros(0, np.uint64)
        for part in parts.dropna():
            total = merge(total, decoded(part), k)
        return _encoded(total)

    return union


EDITED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def edited_pairs(docs: DataFrame, k: int = K, words: int = WORDS) -> DataFrame:
    """Each document's fingerprint next to that of an edited text and of its successor.

    The edited text has the last floor(n/2) code points replaced by the first as
    many of the next document in doc_id order (after the last: the first). Null
    texts are empty; rows of equal doc_id follow each other in text order; a
    single document is its own successor. Other columns are not read.

    Rows are dealt once, by ranges of doc_id; the first row of each range is
    dealt to the range before as well, so every row meets its successor.
    """
    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    cuts = range_bounds(rows, "doc_id")
    # One row per range: its number and its smallest key. As many as there are cuts.
    low = F.min(F.coalesce("doc_id", F.lit(_LEAST))).alias("low")
    ranged = rows.select("doc_id", range_bucket("doc_id", cuts).alias("part"))
    firsts = sorted((r.part, r.low) for r in ranged.groupBy("part").agg(low).collect())
    if not firsts:
        return docs.sparkSession.createDataFrame([], EDITED)
    lows = dict(firsts)
    earlier = {part: firsts[i - 1][0] for i, (part, _) in enumerate(firsts)}
    held_cuts = np.array(cuts, np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = range_numbers(batch.column(0), held_cuts)
            keys = pc.fill_null(batch.column(0), _LEAST).to_pylist()
            ends = [i for i, key in enumerate(keys) if lows[part[i]] == key]
            before = np.array([earlier[part[i]] for i in ends], np.int32)
            for rows, home, peek in ((batch, part, 0), (batch.take(pa.array(ends, pa.int64())), before, 1)):
                if rows.num_rows:
                    flags = pa.array(np.full(rows.num_rows, peek, np.int32))
                    yield pa.record_batch([*rows.columns, pa.array(home), flags], ["doc_id", "text", "part", "peek"])

    dealt = rows.mapInArrow(deal, "doc_id long, text string, part int, peek int")
    parts = len(firsts)
    sorted_rows = dealt.repartition(parts, "part").sortWithinPartitions(
        "part", "peek", F.col("doc_id").asc_nulls_first(), "text"
    )

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row of a range, waiting for its successor
        for batch in batches:
            ids, texts, part, peek = (batch.column(c).to_pylist() for c in range(4))
            for a in range(0, len(ids), 512):
                rows = ([held] if held else []) + list(zip(ids, texts, part, peek))[a:a + 512]
                done = [(x, y) for x, y in zip(rows, rows[1:]) if x[2] == y[2] and not x[3]]
                held = rows[-1]
                if done:
                    yield _compared(done, k, words)

    return sorted_rows.mapInArrow(pairs, EDITED)


def _compared(pairs: list, k: int, words: int) -> pa.RecordBatch:
    edited = []
    for (_, text, _, _), (_, after, _, _) in pairs:
        half = len(text) // 2
        edited.append(text[: len(text) - half] + after[:half])
    own = sketches([x[1] for x, _ in pairs], k, words)
    new = sketches(edited, k, words)
    # Successors are mostly the next pair's own text.
    following = [
        own[i + 1] if i + 1 < len(pairs) and pairs[i + 1][0] is y else sketches([y[1]], k, words)[0]
        for i, (_, y) in enumerate(pairs)
    ]
    return pa.record_batch({
        "doc_id": pa.array([x[0] for x, _ in pairs], pa.int64()),
        "n_chars": pa.array([len(x[1]) for x, _ in pairs], pa.int64()),
        "edited_sha256": [hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited],
        "fingerprint": list(map(_encoded, own)),
        "edited_fingerprint": list(map(_encoded, new)),
        "near_edited": [resemblance(a, b, k) for a, b in zip(own, new)],
        "near_next": [resemblance(a, b, k) for a, b in zip(own, following)],
    })

"""Helpers shared by the operators: tables, ordered offsets, word hashes."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankweave.runtime import scratch_path

# Bytes of text hashed at a time; bounds the arrays of a task.
WINDOW_BYTES = 1 << 19
# Bytes of text of a batch that a task turns into Python texts at a time.
SLICE_BYTES = 1 << 22


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage durably.

    The schema is given to the reader, so that an empty table keeps it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def worker_store() -> dict:
    """A dict that lives as long as the Python worker (or the driver) does."""
    return sys.modules.setdefault("_rankweave_llm_store", types.ModuleType("_rankweave_llm_store")).__dict__


def give_back() -> None:
    """Return freed memory to the machine; an idle worker keeps its heap otherwise."""
    pa.default_memory_pool().release_unused()
    store = worker_store()
    if "trim" not in store:
        try:
            store["trim"] = ctypes.CDLL(None).malloc_trim
        except (OSError, AttributeError, TypeError):  # only glibc has it
            store["trim"] = lambda pad: 0
    store["trim"](0)


def resting(step: Callable) -> Callable:
    """A step over batches, after which the worker gives freed memory back: it may stand idle for the rest of the job."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from step(batches)
        finally:
            give_back()

    return run


def release_encoders() -> None:
    """Give back the word cache that a tokenising task left in this worker."""
    if worker_store().pop("encoders", None) is not None:
        gc.collect()
    give_back()


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


# -- order over the whole table ----------------------------------------------


def range_bounds(df: DataFrame, key: str, parts: int | None = None) -> list[int]:
    """Ascending cut values that deal the rows of an integer key into ranges.

    Only the key is read. The number of cuts is twice the shuffle partitions,
    so the list on the driver does not depend on the rows.
    """
    n = parts or 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / n for i in range(1, n)]
    cuts = df.agg(F.percentile_approx(key, shares, 20 * n).alias("cuts")).first().cuts
    return sorted(set(cuts or []))


def range_bucket(key: str, cuts: list[int]) -> Column:
    """Number of the range a key falls in; a null key is in the first one."""
    held = np.array(cuts, np.int64)

    @F.arrow_udf("int")
    def found(keys: pa.Array) -> pa.Array:
        return pa.array(range_numbers(keys, held), pa.int32())

    return found(F.col(key).cast("long"))


def range_numbers(keys: pa.Array, cuts: np.ndarray) -> np.ndarray:
    low = pc.fill_null(keys.cast(pa.int64()), np.iinfo(np.int64).min)
    return np.searchsorted(cuts, low.to_numpy(zero_copy_only=False), side="left").astype(np.int32)


def running_before(
    df: DataFrame, key: str, amounts: dict[str, str], cuts: list[int], groups: tuple[str, ...] = ()
) -> DataFrame:
    """Add, per row, the sum of each amount over all rows before it in key order.

    ``amounts`` maps a new column to the column it sums. Rows are added up in
    ranges of the key, the small table of range sums is added up in turn, so no
    task sorts the whole table. With ``groups`` the sums restart per group.
    """
    ranged = df.withColumn("_range", range_bucket(key, cuts))
    sums = ranged.groupBy(*groups, "_range").agg(*[F.sum(a).alias(n) for n, a in amounts.items()])
    ahead = Window.partitionBy(*groups or [F.lit(0)]).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(
        *groups, "_range", *[F.coalesce(F.sum(n).over(ahead), F.lit(0)).alias(f"_base_{n}") for n in amounts]
    )
    here = Window.partitionBy(*groups, "_range").orderBy(F.col(key).asc_nulls_first())
    here = here.rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumns(
        {f"_local_{n}": F.coalesce(F.sum(a).over(here), F.lit(0)) for n, a in amounts.items()}
    )
    out = local.join(bases, [*groups, "_range"])
    out = out.withColumns({n: F.col(f"_local_{n}") + F.col(f"_base_{n}") for n in amounts})
    return out.drop("_range", *[f"_local_{n}" for n in amounts], *[f"_base_{n}" for n in amounts])


# -- words and shingles --------------------------------------------------------

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACE = _RNG.integers(1, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    store = worker_store()
    if len(store.get("powers", ((),))[0]) < n:
        made = []
        for base in (_BASE, _BASE_INVERSE):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            made.append(np.cumprod(steps, dtype=np.uint64))
        store["powers"] = tuple(made)
    return store["powers"]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (finaliser of a multiply-xorshift hash)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash_window(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of a byte window that ends with a space."""
    space = _SPACE[raw]
    before = np.empty_like(space)
    before[0] = True
    before[1:] = space[:-1]
    starts = np.flatnonzero(before & ~space)
    ends = np.flatnonzero(space & ~before)
    up, down = _powers(len(raw) + 1)
    total = np.cumsum(_BYTE[_LOWER[raw]] * up[: len(raw)], dtype=np.uint64)
    total = np.concatenate([np.zeros(1, np.uint64), total])
    return starts, mixed((total[ends] - total[starts]) * down[starts])


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z lower-cased, and where each text's words begin.

    Words are runs of bytes other than space and 09 to 0D. Bytes are read in
    windows cut at a space, whatever the length of a text.
    """
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    starts, hashes, at = [], [], 0
    while at < len(raw):
        end = min(at + WINDOW_BYTES, len(raw))
        while not _SPACE[raw[end - 1]]:
            end += 1
        s, h = _hash_window(raw[at:end])
        starts.append(s + at)
        hashes.append(h)
        at = end
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    where = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    return np.concatenate(hashes), np.searchsorted(where, begins)


def shingle_hashes(texts: list[bytes], words: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all word shingles in order, and where each text's begin.

    A text of fewer words has its whole sequence as one; without words, none.
    """
    hashes, begins = word_hashes(texts)
    counts = np.diff(begins)
    made = np.where(counts >= words, counts - words + 1, np.minimum(counts, 1))
    first = np.cumsum(np.concatenate([[0], made]))
    out = np.empty(first[-1], np.uint64)
    if not len(out):
        return out, first
    padded = np.concatenate([hashes, np.zeros(words, np.uint64)])
    at = np.arange(len(out)) - np.repeat(first[:-1] - begins[:-1], made)
    total = np.zeros(len(out), np.uint64)
    room = np.repeat(counts, made)
    for j in range(words):
        part = padded[at + j] * _PLACE[j]
        total += part if j == 0 else np.where(room > j, part, np.uint64(0))
    total += np.minimum(room, words).astype(np.uint64) * _PLACE[7]
    return mixed(total), first


def chunk_home(chunk: int, homes: int) -> int:
    """Which of so many places keeps what belongs to a whole chunk.

    Chunks are numbered from their task's number times 2**24, so both parts count.
    """
    return ((chunk >> 24) * 7919 + (chunk & 0xFFFFFF)) % homes


def text_slices(batch: pa.RecordBatch, column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``most`` bytes of one text column; a long text is one run."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(start, end - start)
        start = end


def text_chunks(texts: Iterable[str | None], most: int = WINDOW_BYTES) -> Iterator[tuple[int, int]]:
    """Cut a list of texts into runs of about ``most`` characters."""
    start = size = i = 0
    for i, text in enumerate(texts, 1):
        size += len(text or "")
        if size >= most:
            yield start, i
            start, size = i, 0
    if start < i:
        yield start, i

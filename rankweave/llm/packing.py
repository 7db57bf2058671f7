"""Packing of documents into fixed-length sequences, as a cutting-stock problem.

Documents over a sequence give full blocks of their own. What is left of each is
an item. A linear program over patterns of item lengths says how often each
pattern is cut; its columns are made on demand by a knapsack over the dual
prices. Patterns are rounded down, the few items left are put first-fit, and
each pattern takes the next documents by rank among those of its length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import range_bounds, running_before, stored, text_or_empty, text_slices
from .tokens import encoder

LENGTH = 4096
# Lengths are taken in steps of so many tokens, rounded up: this bounds the rows
# of the linear program at 512 and costs half a step of padding an item.
STEP = 8
# The program ends when it is proven to be this near its least number of sequences.
NEAR = 5e-4


def _knapsack(sizes: np.ndarray, prices: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern: how many items of each size, by dynamic programming over the room."""
    value = np.zeros(room + 1)
    taken = np.full(room + 1, -1)
    # A price per size of the room, none where there is no item: those that fit meet the values of the room they leave.
    place = np.full(room + 1, -1)
    place[sizes] = np.arange(len(sizes))
    price = np.full(room + 1, -np.inf)
    price[sizes] = prices
    worth = np.empty(room + 1)
    for w in range(1, room + 1):
        held = np.add(value[w - 1::-1], price[1:w + 1], worth[:w])
        best = held.argmax()
        if held[best] > value[w - 1] + 1e-12:
            value[w], taken[w] = held[best], place[best + 1]
        else:
            value[w] = value[w - 1]
    pattern, w = np.zeros(len(sizes)), room
    while w > 0:
        if taken[w] < 0:
            w -= 1
        else:
            pattern[taken[w]] += 1
            w -= int(sizes[taken[w]])
    return float(value[room]), pattern


def solve(sizes: np.ndarray, demand: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and how often each is used, fractional: column generation.

    ``sizes`` ascend and fit the room. The revised simplex method keeps the
    inverse of the basis; the entering column is the knapsack's.
    """
    m = len(sizes)
    basis = np.diag((room // sizes).astype(float))
    inverse = np.diag(1.0 / np.diag(basis))
    # Slightly different demands keep steps from being empty; far below one item.
    x = inverse @ (demand * (1 + 1e-9 * np.arange(1, m + 1)))
    for _ in range(50 * m + 1000):
        prices = inverse.sum(axis=0)
        worth, pattern = _knapsack(sizes, np.maximum(prices, 0), room)
        # Prices over the best pattern's worth are feasible, so they bound the least number.
        if worth <= 1 + 1e-9 or x.sum() <= (np.maximum(prices, 0) @ demand) / worth * (1 + NEAR):
            break
        step = inverse @ pattern
        can = step > 1e-9
        ratios = np.full(m, np.inf)
        ratios[can] = x[can] / step[can]
        out = int(np.argmin(ratios))
        x -= ratios[out] * step
        x[out] = ratios[out]
        basis[:, out] = pattern
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
        np.maximum(x, 0, out=x)
    return basis, x


@dataclass
class Plan:
    """Whole patterns: per class, the ranks each pattern takes and the sequences they go to."""

    begins: dict[int, np.ndarray]
    per_copy: dict[int, np.ndarray]
    first: dict[int, np.ndarray]
    sequences: int


def plan_patterns(counts: dict[int, int], room: int) -> Plan:
    """Patterns for so many items of each class; every item has one place."""
    classes = np.array(sorted(c for c, n in counts.items() if n > 0), np.int64)
    demand = np.array([counts[int(c)] for c in classes], np.int64)
    uses: list[tuple[np.ndarray, int]] = []
    left = demand.copy()
    if len(classes):
        patterns, times = solve(classes, demand.astype(float), room)
        for p in np.argsort(-times, kind="stable"):
            pattern = np.round(patterns[:, p]).astype(np.int64)
            used = pattern > 0
            copies = int(min(np.floor(times[p] + 1e-6), (left[used] // pattern[used]).min()))
            if copies > 0:
                uses.append((pattern, copies))
                left -= copies * pattern
    while left.any():
        # First fit from the largest of the items left; as many copies as they allow.
        pattern, free = np.zeros_like(left), room
        for i in range(len(classes) - 1, -1, -1):
            pattern[i] = min(left[i], free // classes[i])
            free -= pattern[i] * classes[i]
        used = pattern > 0
        copies = int((left[used] // pattern[used]).min())
        uses.append((pattern, copies))
        left -= copies * pattern
    held: dict[int, list[tuple[int, int, int]]] = {int(c): [] for c in classes}
    taken = np.zeros_like(demand)
    sequence = 0
    for pattern, copies in uses:
        for i in np.flatnonzero(pattern):
            held[int(classes[i])].append((int(taken[i]), int(pattern[i]), sequence))
        taken += copies * pattern
        sequence += copies
    columns = {c: np.array(rows, np.int64).T for c, rows in held.items()}
    return Plan({c: v[0] for c, v in columns.items()}, {c: v[1] for c, v in columns.items()},
                {c: v[2] for c, v in columns.items()}, sequence)


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def measured(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """A row per document: tokens with the end id, and the crc32 of every block of ``length`` ids."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = encoder(tokenizer)
        for batch in batches:
            for part in text_slices(batch, 1):
                tokens, sums = [], []
                for raw in held.encode(part.column(1).to_pylist()):
                    ids = held.ids(raw)
                    tokens.append(len(ids))
                    sums.append([zlib.crc32(ids[a:a + length].tobytes()) for a in range(0, len(ids), length)])
                yield pa.record_batch({
                    "doc_id": part.column(0), "tokens": pa.array(tokens, pa.int64()),
                    "sums": pa.array(sums, pa.list_(pa.int64())),
                })
        held.rest()

    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    return stored(rows.mapInArrow(measure, "doc_id long, tokens long, sums array<long>"), "token-counts")


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, step: int = STEP) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every document has at least its end id, null and empty texts too, and every
    id is in one piece. Repeated rows are packed each by itself; a null doc_id
    ranks first. An empty table has no pieces. Other columns are not read.
    """
    sizes = measured(docs, tokenizer, length)
    cuts = range_bounds(sizes, "doc_id")
    rest = F.pmod("tokens", F.lit(length))
    items = sizes.withColumns({
        "class": F.ceil(rest / step).cast("int"), "full": F.floor(F.col("tokens") / length),
        "one": F.lit(1).cast("long"),
    })
    counted = items.where("class > 0").groupBy("class").agg(F.count("*").alias("n"))
    # At most length / step rows.
    plan = plan_patterns({r["class"]: r.n for r in counted.collect()}, length // step)

    whole = running_before(items.where("full > 0"), "doc_id", {"before": "full"}, cuts)
    whole = whole.select("doc_id", "tokens", "before", F.posexplode(F.slice("sums", F.lit(1), F.col("full").cast("int"))).alias("at", "crc"))
    blocks = whole.select(
        "doc_id", (F.col("at").cast("long") * length).alias("start"), F.lit(length).cast("long").alias("length"),
        F.col("crc").alias("ids_crc32"), F.col("tokens").alias("doc_tokens"),
        (F.lit(plan.sequences) + F.col("before") + F.col("at")).cast("long").alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )

    ranked = running_before(items.where("class > 0"), "doc_id", {"rank": "one"}, cuts, ("class",))
    ranked = ranked.select(
        "doc_id", (F.col("full") * length).cast("long").alias("start"), rest.cast("long").alias("length"),
        F.element_at("sums", -1).alias("ids_crc32"), F.col("tokens").alias("doc_tokens"), "class", "rank",
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, ranks = (batch.column(c).to_numpy(zero_copy_only=False) for c in (5, 6))
            sequence = np.empty(len(kinds), np.int64)
            for kind in np.unique(kinds):
                rows = np.flatnonzero(kinds == kind)
                begins = plan.begins[int(kind)]
                at = np.searchsorted(begins, ranks[rows], side="right") - 1
                sequence[rows] = plan.first[int(kind)][at] + (ranks[rows] - begins[at]) // plan.per_copy[int(kind)][at]
            yield pa.record_batch(
                [*batch.columns[:5], pa.array(sequence), batch.column(6)], [*batch.schema.names[:5], "sequence_id", "rank"]
            )

    placed = ranked.mapInArrow(place, PIECES + ", sequence_id long, rank long")
    # A sequence has at most as many pieces as tokens.
    order = Window.partitionBy("sequence_id").orderBy(F.col("length").desc(), "rank").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(order), F.lit(0)).cast("long").alias("offset")
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", offset).unionByName(blocks)

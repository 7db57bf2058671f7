"""Approximate nearest neighbours by inverted lists.

K-means splits the documents into lists; a query looks only into the lists
whose centres are nearest. With as many probes as lists the search is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankweave.operators.dense import (
    MAX_QUERY_ROWS,
    collect_block,
    knn,
    merge_nearest,
    rows_per_block,
    scan_by_list,
    scan_in_blocks,
    scan_with_block,
    vectors_of,
)
from rankweave.operators.filters import Filter, apply_filter
from rankweave.runtime import broadcast_if_small, scratch_path
from rankweave.spec import (
    DEFAULT_K,
    CollectionSpec,
    DistanceStrategy,
    IterativeScanMode,
    IvfParams,
)

# A list number is an index into the centres, which every task holds in memory.
MAX_LISTS = 65_536


@dataclass(frozen=True)
class IvfIndex:
    """Centres of the lists, and the documents with their ``list_id``."""

    centers: np.ndarray
    docs: DataFrame
    params: IvfParams
    spec: CollectionSpec


# Bytes that the centres may take, and cells (vectors x lists) worked on at a time.
MAX_CENTER_BYTES = 256 << 20
CELLS = 1 << 22
# Queries x lists up to which the probed lists are one table that every task holds.
MAX_PROBE_CELLS = 1 << 26
# Numbers of the query copies made at once, one copy for each probed list.
_COPIED_CELLS = 1 << 20
# Copies of a row, on average, up to which blocks of a list meet by copies of their rows.
_FEW_COPIES = 4
ITERATIONS = 10
# Sums of the training are whole numbers of this size, so their order does not matter.
_UNIT = 1 << 24


def _scaled(vectors: np.ndarray, metric: DistanceStrategy) -> np.ndarray:
    """Doubles; scaled to length one unless the metric is Euclidean."""
    vectors = vectors.astype(np.float64)
    if metric is not DistanceStrategy.EUCLIDEAN:
        length = np.linalg.norm(vectors, axis=1, keepdims=True)
        vectors = np.divide(vectors, length, out=vectors.copy(), where=length > 0)
    return vectors


def _nearest_lists(vectors: np.ndarray, centers: np.ndarray, metric: DistanceStrategy, probes: int) -> np.ndarray:
    """Numbers of the ``probes`` lists nearest to each vector, nearest first, ties by number."""
    vectors = _scaled(vectors, metric)
    squares = (centers * centers).sum(axis=1)[None, :]
    out = np.empty((len(vectors), probes), np.int64)
    step = max(1, CELLS // len(centers))
    for a in range(0, len(vectors), step):
        gaps = squares - 2.0 * (vectors[a:a + step] @ centers.T)
        if probes < len(centers):
            chosen = np.argpartition(gaps, probes - 1, axis=1)[:, :probes]
            last = np.take_along_axis(gaps, chosen, axis=1).max(axis=1, keepdims=True)
            # Where the last place is tied the partition may have taken any of them.
            for row in np.flatnonzero((gaps <= last).sum(axis=1) > probes):
                chosen[row] = np.argsort(gaps[row], kind="stable")[:probes]
        else:
            chosen = np.broadcast_to(np.arange(len(centers)), gaps.shape)
        chosen = np.sort(chosen, axis=1)
        order = np.argsort(np.take_along_axis(gaps, chosen, axis=1), axis=1, kind="stable")
        out[a:a + step] = np.take_along_axis(chosen, order, axis=1)
    return out


def _usable(docs: DataFrame, params: IvfParams, spec: CollectionSpec) -> DataFrame:
    if not 1 <= params.lists <= MAX_LISTS:
        raise ValueError(f"lists must be between 1 and {MAX_LISTS}")
    docs = docs.where(F.expr(params.where)) if params.where else docs
    return docs.where(F.col(spec.embedding).isNotNull())


def train_centers(
    docs: DataFrame, params: IvfParams = IvfParams(), spec: CollectionSpec = CollectionSpec()
) -> np.ndarray:
    """Centres of the lists by k-means over all documents.

    It starts from the documents that come first by a seeded hash of their id.
    Each round adds up whole numbers, so the centres do not depend on how the
    table is cut into partitions. Lists that lose all documents keep their centre.
    """
    docs, metric = _usable(docs, params, spec), params.distance_strategy
    seeded = F.md5(F.concat(F.col(spec.id).cast("string"), F.lit(f":{params.seed}")))
    first = docs.select(spec.id, spec.embedding).orderBy(seeded, spec.id).limit(params.lists)
    rows = [r[1] for r in first.collect()]
    if not rows:
        raise ValueError("there are no vectors to train on")
    centers = _scaled(np.array(rows), metric)
    if centers.nbytes > MAX_CENTER_BYTES:
        raise ValueError(f"{params.lists} centres take more than {MAX_CENTER_BYTES} bytes")
    vectors = docs.select(spec.embedding)
    for _ in range(ITERATIONS):
        held = docs.sparkSession.sparkContext.broadcast(centers)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = held.value
            sums, counts = np.zeros(known.shape, np.int64), np.zeros(len(known), np.int64)
            for batch in batches:
                if batch.num_rows:
                    own = vectors_of(batch.column(0))
                    nearest = _nearest_lists(own, known, metric, 1)[:, 0]
                    np.add.at(sums, nearest, np.rint(_scaled(own, metric) * _UNIT).astype(np.int64))
                    counts += np.bincount(nearest, minlength=len(known))
            used = np.flatnonzero(counts)
            yield pa.record_batch({
                "list_id": pa.array(used, pa.int32()), "n": pa.array(counts[used], pa.int64()),
                "sums": pa.array(list(sums[used]), pa.list_(pa.int64())),
            })

        def total(table: pa.Table) -> pa.Table:
            summed = np.sum(np.array(table.column("sums").to_pylist(), np.int64), axis=0)
            return pa.table({
                "list_id": pa.array([table.column("list_id")[0].as_py()], pa.int32()),
                "n": pa.array([sum(table.column("n").to_pylist())], pa.int64()),
                "sums": pa.array([summed], pa.list_(pa.int64())),
            })

        schema = "list_id int, n long, sums array<long>"
        found = vectors.mapInArrow(add, schema).groupBy("list_id").applyInArrow(total, schema).collect()
        moved = centers.copy()
        for r in found:
            moved[r["list_id"]] = np.array(r["sums"], np.float64) / _UNIT / r["n"]
        held.unpersist()
        if np.array_equal(moved, centers):
            break
        centers = moved
    return centers


def assign_lists(
    docs: DataFrame, centers: np.ndarray, params: IvfParams = IvfParams(), spec: CollectionSpec = CollectionSpec()
) -> IvfIndex:
    """Give every document the list of its nearest centre; the centres may be any.

    New documents of an index get their lists in the same way: see ``extend_ivf``.
    """
    docs, metric = _usable(docs, params, spec), params.distance_strategy
    held = docs.sparkSession.sparkContext.broadcast(_scaled(np.asarray(centers), metric))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = vectors_of(batch.column(spec.embedding)) if batch.num_rows else np.zeros((0, held.value.shape[1]))
            nearest = _nearest_lists(own, held.value, metric, 1)[:, 0].astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest)], names=[*batch.schema.names, "list_id"])

    schema = T.StructType([*docs.schema.fields, T.StructField("list_id", T.IntegerType())])
    return IvfIndex(held.value, docs.mapInArrow(assign, schema), params, spec)


def build_ivf(
    docs: DataFrame, params: IvfParams = IvfParams(), spec: CollectionSpec = CollectionSpec()
) -> IvfIndex:
    """Train the list centres on all documents and give every document its list."""
    return assign_lists(docs, train_centers(docs, params, spec), params, spec)


def extend_ivf(index: IvfIndex, changed: DataFrame, gone: DataFrame) -> IvfIndex:
    """The index after documents changed: ``gone`` ids leave it, ``changed`` rows get their lists.

    Replaced documents are in both. Rows that did not change are not assigned anew.
    """
    spec = index.spec
    keys = broadcast_if_small(gone.select(spec.id).distinct(), F.octet_length(F.col(spec.id).cast("string")))
    left = index.docs.join(keys, spec.id, "left_anti").select(index.docs.columns)
    new = assign_lists(changed, index.centers, index.params, spec).docs
    return IvfIndex(index.centers, left.unionByName(new.select(index.docs.columns)), index.params, spec)


def _copies(
    batch: pa.RecordBatch, centers: np.ndarray, metric: DistanceStrategy, probes: int, names: list[str]
) -> Iterator[pa.RecordBatch]:
    """The queries of a batch, once for each probed list, in batches of bounded size."""
    step = max(1, _COPIED_CELLS // (probes * max(1, centers.shape[1])))
    for start in range(0, batch.num_rows, step):
        part = batch.slice(start, step)
        chosen = _nearest_lists(vectors_of(part.column(1)), centers, metric, probes)
        copied = part.take(pa.array(np.repeat(np.arange(part.num_rows), chosen.shape[1])))
        lists = pa.array(chosen.reshape(-1).astype(np.int32))
        yield pa.RecordBatch.from_arrays([*copied.columns, lists], names=names)


def _with_lists(queries: DataFrame, index: IvfIndex, probes: int, copied: bool) -> DataFrame:
    """The queries with the lists they look into, for query sets of any size.

    One row for each list (``list_id``) where they are ``copied``, else one row
    for each query with an array (``lists``).
    """
    metric = index.params.distance_strategy
    centers = queries.sparkSession.sparkContext.broadcast(index.centers)
    lists = T.StructField("list_id", T.IntegerType()) if copied else T.StructField("lists", T.ArrayType(T.IntegerType()))
    schema = T.StructType([*queries.schema.fields, lists])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if copied:
                yield from _copies(batch, centers.value, metric, probes, schema.names)
            elif batch.num_rows:
                chosen = _nearest_lists(vectors_of(batch.column(1)), centers.value, metric, probes)
                ends = np.arange(0, chosen.size + 1, probes, dtype=np.int32)
                arrays = pa.ListArray.from_arrays(ends, pa.array(chosen.reshape(-1).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*batch.columns, arrays], names=schema.names)

    return queries.mapInArrow(probe, schema)


def _scan_lists(
    vectors: DataFrame, queries: DataFrame, index: IvfIndex, k: int, probes: int, products: bool
) -> DataFrame:
    """k nearest documents in the probed lists, for query sets of any size.

    Where the blocks of a list can meet by few copies of their rows they do;
    else blocks of all lists meet, which needs no copies.
    """
    metric = index.params.distance_strategy
    asked = _with_lists(queries, index, probes, copied=False)
    held, looked = (
        {r["list_id"]: r["count"] for r in rows.groupBy("list_id").count().collect()}
        for rows in (vectors, asked.select(F.explode("lists").alias("list_id")))
    )
    per_block, queries_per_block = rows_per_block(vectors)
    copies = sum(
        looked[i] * -(-held[i] // per_block) + held[i] * -(-looked[i] // queries_per_block) for i in held if i in looked
    )
    if copies <= _FEW_COPIES * (sum(held.values()) + sum(looked.values()) // probes):
        copied = _with_lists(queries, index, probes, copied=True)
        return scan_by_list(vectors, copied, k, metric, held, looked, products)
    return scan_in_blocks(vectors, asked, k, metric, products=products, held=held)


def ivf_search(
    index: IvfIndex,
    queries: DataFrame,
    k: int = DEFAULT_K,
    probes: int = 1,
    filter: Filter | Column | None = None,
    iterative_scan: IterativeScanMode = IterativeScanMode.OFF,
    max_broadcast_rows: int = MAX_QUERY_ROWS,
    products: bool = False,
) -> DataFrame:
    """The k nearest documents found in the ``probes`` nearest lists.

    With an iterative scan, queries that got fewer than k rows are searched
    again in all lists, so a selective filter does not shorten the result.
    ``products`` adds the column ``product``, the inner product of each row
    found, as a search without an iterative scan has it at hand.
    """
    if products and iterative_scan is not IterativeScanMode.OFF:
        raise ValueError("products are of a search without an iterative scan")
    metric, spec = index.params.distance_strategy, index.spec
    probes = min(max(1, probes), len(index.centers))
    docs = apply_filter(index.docs, filter, spec.metadata)
    vectors = docs.select(spec.id, spec.embedding, "list_id")
    wanted = queries.select("query_id", "query_embedding").where(
        F.col("query_embedding").isNotNull()
    )
    block = collect_block(wanted, max_rows=max_broadcast_rows)
    if block is None or len(block.ids) * len(index.centers) > MAX_PROBE_CELLS:
        lists = _scan_lists(vectors, wanted, index, k, probes, products)
    else:
        table = np.zeros((len(block.ids), len(index.centers)), dtype=bool)
        if len(block.ids):
            chosen = _nearest_lists(block.vectors, index.centers, metric, probes)
            np.put_along_axis(table, chosen, True, axis=1)
        # Partitions of lists that no query looks into are not read.
        used = np.flatnonzero(table.any(axis=0)).tolist()
        vectors = vectors.where(F.col("list_id").isin(used))
        lists = scan_with_block(vectors, block, wanted, k, metric, probes=table, products=products)
    found = merge_nearest(lists, k, metric)
    if iterative_scan is IterativeScanMode.OFF or probes == len(index.centers):
        return found
    # Written once: what is short is known from it, and the rest is read again.
    path = scratch_path(wanted.sparkSession, "ivf-found")
    found.write.parquet(path)
    first = wanted.sparkSession.read.schema(found.schema).parquet(path)
    full = first.groupBy("query_id").count().where(F.col("count") >= k).select("query_id")
    again = wanted.join(full, "query_id", "left_anti")
    more = knn(docs, again, k, metric, None, spec, max_broadcast_rows)
    return first.join(full, "query_id", "left_semi").unionByName(more)

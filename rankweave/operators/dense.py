"""Exact nearest-neighbour search for a DataFrame of query vectors.

Pairs of query and document are never rows. Each task compares its documents
with a bounded block of queries by matrix product and keeps k rows for each
query; only those travel. A query block is broadcast when the whole query set
passes a size check; otherwise blocks of queries meet blocks of documents. Each
block is one row there, and a task reads the rows it needs from where the
shuffle wrote them once: what is on disk grows with the vectors and the lists
of results, not with the number of block pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from rankweave.operators.filters import Filter, apply_filter
from rankweave.operators.topk import MERGE_GROUPS, RunningTopK, list_schema, merge_lists, task_group
from rankweave.spec import DEFAULT_K, CollectionSpec, DistanceStrategy

# Bounds of a broadcast query block.
MAX_QUERY_ROWS = 8_192
MAX_QUERY_BYTES = 64 * 1024 * 1024
# Numbers held at once by one step of the comparison inside a task; documents of a step that many
# queries are compared with, and keys made at once, which stay in a core's cache.
_CELLS = 4_000_000
_STEP = 2_048
_TILE = 1 << 19
# Numbers of one step of the exact distances, and candidates offered at once: ties may make every pair one.
_EXACT_CELLS = 1 << 20
_CANDIDATES = 1 << 18
# Documents of one shuffled block: a worker holds them and a few copies, whatever the table's size.
_BLOCK_BYTES = 8 * 1024 * 1024
# Queries of one shuffled block, whose lists are held all the time.
_BLOCK_QUERIES = 8_192
# Blocks of documents that one task compares with its block of queries, and tasks a core wanted at least.
_TASK_BLOCKS = 64
_TASKS_PER_CORE = 4


def vectors_of(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Arrow list column as a matrix, one row for each vector."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if rows == 0:
        return flat.reshape(0, 0)
    if flat.size % rows or pc.any(pc.not_equal(pc.list_value_length(column), flat.size // rows)).as_py():
        raise ValueError("vectors of different lengths in one column")
    return flat.reshape(rows, flat.size // rows)


def _places(mask: np.ndarray) -> np.ndarray:
    """Flat places of the few true values of a mask, found by words of eight."""
    flat = mask.reshape(-1)
    whole = len(flat) // 8 * 8
    words = np.flatnonzero(flat[:whole].view(np.uint64))
    some = (words[:, None] * 8 + np.arange(8)).reshape(-1)
    return np.concatenate([some[flat[some]], whole + np.flatnonzero(flat[whole:])])


class NearestRows(RunningTopK):
    """Running k nearest documents of every query of one block.

    A matrix product in single precision picks the candidates, with room for
    its rounding error; their distances are then computed row by row in double
    precision. Equal vectors so get equal distances, and the order (distance,
    id) is the same on every run and for every way to cut the documents. With
    ``products`` the inner product of each kept row is its extra number.
    """

    def __init__(self, queries: np.ndarray, k: int, metric: DistanceStrategy, products: bool = False) -> None:
        super().__init__(len(queries), k)
        self.q = queries.astype(np.float64)
        self.metric = metric
        self.products = products
        self.q_norm = np.sqrt((self.q * self.q).sum(axis=1))

    def add(self, docs: np.ndarray, ids: np.ndarray, only: np.ndarray | None = None) -> None:
        """Compare documents with all queries, or with the queries ``only``."""
        active = np.arange(len(self.q)) if only is None else only
        if len(docs) == 0 or len(active) == 0:
            return
        if docs.shape[1] != self.q.shape[1]:
            raise ValueError(f"documents have {docs.shape[1]} values, queries {self.q.shape[1]}")
        step = max(1, _CELLS // max(min(len(active), _CELLS // _STEP), docs.shape[1]))
        sides: dict[type, tuple[np.ndarray, np.ndarray]] = {}
        for start in range(0, len(docs), step):
            part = slice(start, start + step)
            self._add_part(docs[part], ids[part], active, sides)

    def _add_part(self, docs: np.ndarray, ids: np.ndarray, active: np.ndarray, sides: dict) -> None:
        norm = np.sqrt(np.einsum("ij,ij->i", docs, docs, dtype=np.float64))
        q_norm = self.q_norm[active]
        sizes = np.concatenate([q_norm[q_norm > 0], norm[norm > 0], [1.0]])
        kind = np.float32 if 1e-15 < sizes.min() and sizes.max() < 1e15 else np.float64
        if kind not in sides:
            sides[kind] = self._query_side(active, kind)
        left, shift = sides[kind]
        right, slack = self._doc_side(docs, norm, q_norm, kind)
        cosine = self.metric is DistanceStrategy.COSINE_DISTANCE
        tile = max(1, _TILE // len(docs))
        held = np.empty((min(tile, len(active)), len(docs)), kind)
        queue: list[tuple[np.ndarray, np.ndarray]] = []
        for start in range(0, len(active), tile):
            own = slice(start, start + tile)
            keys = np.matmul(left[own], right, out=held[: len(left[own])])
            if cosine:
                keys[q_norm[own] == 0] = np.inf
                keys[:, norm == 0] = np.inf
            limit = self.bound[active[own]] - shift[own]
            # Once every query has k rows, their bounds alone leave few candidates.
            if len(docs) > self.k and np.isinf(limit).any():
                limit = np.minimum(limit, np.partition(keys, self.k - 1, axis=1)[:, self.k - 1] + slack[own])
            # Rounded up, so that the comparison stays in the keys' precision.
            most = np.nextafter((limit + slack[own]).astype(kind), kind(np.inf))
            near = _places(keys <= most[:, None])
            if len(near):
                queue.append((active[own][near // len(docs)], near % len(docs)))
            if queue and (start + tile >= len(active) or sum(len(q[0]) for q in queue) >= _CANDIDATES):
                self._offer(docs, ids, *map(np.concatenate, zip(*queue)))
                queue = []

    def _offer(self, docs: np.ndarray, ids: np.ndarray, owners: np.ndarray, di: np.ndarray) -> None:
        for start in range(0, len(owners), _CANDIDATES):
            part = slice(start, start + _CANDIDATES)
            owner = owners[part]
            extra = self._exact_products(docs, owner, di[part]) if self.products else None
            self.offer(owner, self._exact_keys(docs, owner, di[part]), ids[di[part]], extra)

    def _query_side(self, active: np.ndarray, kind: type) -> tuple[np.ndarray, np.ndarray]:
        """The left side of the matrix product, and what is to be added to its keys (smaller is nearer)."""
        queries, q_norm = self.q[active], self.q_norm[active]
        if self.metric is DistanceStrategy.COSINE_DISTANCE:
            with np.errstate(divide="ignore", invalid="ignore"):
                return (queries / -q_norm[:, None]).astype(kind), np.ones(len(active))
        if self.metric is DistanceStrategy.INNER_PRODUCT:
            return (-queries).astype(kind), np.zeros(len(active))
        ones = np.ones((len(active), 1))
        return np.concatenate([-2 * queries, ones], axis=1).astype(kind), q_norm**2

    def _doc_side(
        self, docs: np.ndarray, norm: np.ndarray, q_norm: np.ndarray, kind: type
    ) -> tuple[np.ndarray, np.ndarray]:
        """The right side of the matrix product, and a bound of the error of its keys."""
        # Error of a product of rounded vectors, relative to their lengths.
        error = (2 * docs.shape[1] + 64) * float(np.finfo(kind).eps)
        if self.metric is DistanceStrategy.COSINE_DISTANCE:
            with np.errstate(divide="ignore", invalid="ignore"):
                return (docs / norm[:, None]).astype(kind).T, np.full(len(q_norm), 2 * error)
        if self.metric is DistanceStrategy.INNER_PRODUCT:
            return docs.astype(kind, copy=False).T, error * (q_norm * norm.max() + 1e-300)
        right = np.concatenate([docs.astype(kind, copy=False), (norm**2).astype(kind)[:, None]], axis=1)
        return right.T, 2 * error * (q_norm**2 + norm.max() ** 2 + 1e-300)

    def _exact_keys(self, docs: np.ndarray, owner: np.ndarray, di: np.ndarray) -> np.ndarray:
        keys = np.empty(len(owner))
        step = max(1, _EXACT_CELLS // docs.shape[1])
        for start in range(0, len(owner), step):
            part = slice(start, start + step)
            a, b = self.q[owner[part]], docs[di[part]].astype(np.float64)
            if self.metric is DistanceStrategy.EUCLIDEAN:
                gap = a - b
                keys[part] = (gap * gap).sum(axis=1)
                continue
            keys[part] = -(a * b).sum(axis=1)
            if self.metric is DistanceStrategy.COSINE_DISTANCE:
                scale = self.q_norm[owner[part]] * np.sqrt((b * b).sum(axis=1))
                with np.errstate(divide="ignore", invalid="ignore"):
                    keys[part] = np.where(scale > 0, 1.0 + keys[part] / scale, np.inf)
        return keys

    def _exact_products(self, docs: np.ndarray, owner: np.ndarray, di: np.ndarray) -> np.ndarray:
        """Inner products, added up value after value as Spark's ``aggregate`` does."""
        sums = np.zeros(len(owner))
        for j in range(docs.shape[1]):
            sums += self.q[owner, j] * docs[di, j]
        return sums

    def distances(self) -> np.ndarray:
        """Distances of the kept rows; NaN where the metric gives none."""
        if self.metric is DistanceStrategy.EUCLIDEAN:
            return np.sqrt(self.key)
        if self.metric is DistanceStrategy.INNER_PRODUCT:
            return -self.key
        return np.where(np.isinf(self.key), np.nan, self.key)


@dataclass(frozen=True)
class QueryBlock:
    """Query ids and vectors that passed the size check."""

    ids: pa.Array
    vectors: np.ndarray


def collect_block(
    queries: DataFrame, max_rows: int = MAX_QUERY_ROWS, max_bytes: int = MAX_QUERY_BYTES
) -> QueryBlock | None:
    """The query set as one block, or None when it is over the bounds.

    One job checks and fetches: it returns at most ``max_rows + 1`` rows, and
    those only when a first look at one row says that they fit the bytes.
    """
    head = queries.limit(1).toArrow()
    if head.num_rows == 0:
        return QueryBlock(head.column(0).combine_chunks(), np.empty((0, 0)))
    per_row = 8 * max(1, len(head.column(1)[0].as_py() or ())) + 64
    bound = min(max_rows, max_bytes // per_row)
    table = queries.limit(bound + 1).toArrow()
    if table.num_rows > bound:
        return None
    return QueryBlock(table.column(0).combine_chunks(), vectors_of(table.column(1)))


def _lists(queries: DataFrame, docs: DataFrame, products: bool = False) -> T.StructType:
    schema = list_schema(queries.schema[0].dataType, docs.schema[0].dataType, "distance")
    return T.StructType([*schema.fields, T.StructField("product", T.DoubleType())]) if products else schema


def _list_batch(nearest: NearestRows, query_ids: pa.Array, schema: T.StructType, group: int) -> pa.RecordBatch:
    """The kept rows in the columns of ``schema``."""
    id_type = to_arrow_type(schema["id"].dataType)
    batch = nearest.batch(query_ids, id_type, nearest.distances(), group).rename_columns(schema.names[:4])
    if nearest.products:
        batch = pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest.extra)], names=schema.names)
    return batch


def _id_values(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def scan_with_block(
    docs: DataFrame,
    block: QueryBlock,
    queries: DataFrame,
    k: int,
    metric: DistanceStrategy,
    probes: np.ndarray | None = None,
    products: bool = False,
) -> DataFrame:
    """k nearest documents in each partition, for a broadcast query block.

    ``docs`` is (id, vector), or (id, vector, list_id) with ``probes``: a
    boolean matrix (query x list) of the lists that each query looks into.
    """
    schema = _lists(queries, docs, products)
    shared = docs.sparkSession.sparkContext.broadcast((block.ids, block.vectors, probes))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, query_vectors, lists = shared.value
        nearest = NearestRows(query_vectors, k, metric, products)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            vectors, ids = vectors_of(batch.column(1)), _id_values(batch.column(0))
            if lists is None:
                nearest.add(vectors, ids)
                continue
            list_ids = batch.column(2).to_numpy()
            for list_id in np.unique(list_ids):
                rows = list_ids == list_id
                nearest.add(vectors[rows], ids[rows], np.flatnonzero(lists[:, list_id]))
        yield _list_batch(nearest, query_ids, schema, task_group())

    return docs.mapInArrow(scan, schema)


def _packed(rows: DataFrame, per_block: int, names: list[str]) -> DataFrame:
    """(block, part, packed): the rows of each block as Arrow bytes, ``per_block`` rows in one of them at most.

    The last column of ``rows`` is the block; the others are written under ``names``.
    """

    def pack(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        held = part = 0

        def flush() -> pa.RecordBatch:
            nonlocal waiting, held, part
            table = pa.Table.from_batches(waiting).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as writer:
                writer.write_table(table)
            part += 1
            waiting, held = [], 0
            return pa.record_batch({
                "block": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([part], pa.int32()),
                "packed": pa.array([sink.getvalue().to_pybytes()], pa.binary()),
            })

        for batch in batches:
            own = batch.select(list(range(len(names)))).rename_columns(names)
            while own.num_rows:
                some = own.slice(0, per_block - held)
                waiting.append(some)
                held += some.num_rows
                own = own.slice(some.num_rows)
                if held == per_block:
                    yield flush()
        if held:
            yield flush()

    return rows.groupBy(rows.columns[-1]).applyInArrow(pack, "block int, part int, packed binary")


def _unpacked(packed: pa.BinaryScalar) -> pa.RecordBatch:
    return pa.ipc.open_stream(packed.as_buffer()).read_next_batch()


class _QueryBlock:
    """A block of queries inside a task: its ids, its running lists, and who looks into which list."""

    def __init__(self, packed: pa.BinaryScalar, k: int, metric: DistanceStrategy, products: bool) -> None:
        batch = _unpacked(packed)
        self.ids = batch.column(0)
        self.nearest = NearestRows(vectors_of(batch.column(1)), k, metric, products)
        self.owner = None
        if batch.num_columns > 2:
            lists = batch.column(2)
            flat = lists.flatten().to_numpy()
            order = np.argsort(flat, kind="stable")
            self.owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())[order]
            self.lists = flat[order]

    def add(self, docs: pa.RecordBatch) -> None:
        vectors, ids = vectors_of(docs.column(1)), _id_values(docs.column(0))
        if self.owner is None:
            self.nearest.add(vectors, ids)
            return
        list_ids = docs.column(2).to_numpy()
        for list_id in np.unique(list_ids):
            start, end = np.searchsorted(self.lists, [list_id, list_id + 1])
            if start < end:
                rows = list_ids == list_id
                self.nearest.add(vectors[rows], ids[rows], self.owner[start:end])


def _placed_by_list(docs: DataFrame, held: dict[int, int], per_block: int) -> tuple[DataFrame, int]:
    """The documents with the column ``_block``, and the number of blocks.

    Documents of a list lie in as few blocks as its size (``held``) allows;
    small lists that follow each other share a block.
    """
    places, blocks, used = [], 0, per_block
    for list_id, count in sorted(held.items()):
        own = -(-count // per_block)
        if used + count > per_block:
            blocks += own
            used = 0 if own == 1 else per_block
        places.append((list_id, blocks - own, own))
        used += count
    table = docs.sparkSession.createDataFrame(places, "list_id int, _first int, _own int")
    number = F.col("_first") + F.pmod(F.xxhash64(*docs.columns[:2]), F.col("_own")).cast("int")
    placed = docs.join(F.broadcast(table), "list_id").select(*docs.columns, number.alias("_block"))
    return placed, max(1, blocks)


def rows_per_block(docs: DataFrame, block_bytes: int = _BLOCK_BYTES) -> tuple[int, int]:
    """Rows of a block of documents and of a block of queries, for documents (id, vector, ..)."""
    dim = docs.select(F.size(docs.columns[1])).first()
    rows = max(1, block_bytes // (8 * max(1, dim[0] if dim else 1)))
    return rows, min(rows, _BLOCK_QUERIES)


def scan_in_blocks(
    docs: DataFrame,
    queries: DataFrame,
    k: int,
    metric: DistanceStrategy,
    block_bytes: int = _BLOCK_BYTES,
    products: bool = False,
    held: dict[int, int] | None = None,
) -> DataFrame:
    """k nearest documents by blocks, for a query set too large to broadcast.

    Documents and queries are cut into blocks of bounded size by a hash; each
    block is written once by a shuffle, as one row. A task has one block of
    queries and reads some of the documents, block after block, so a query gets
    as many lists as there are such groups. With ``held``, the size of each
    list, both sides have a third column (``list_id`` of a document, an array
    of the lists that a query looks into), and a document meets only the
    queries that look into its list.
    """
    schema = _lists(queries, docs, products)
    per_block, queries_per_block = rows_per_block(docs, block_bytes)
    query_blocks = max(1, -(-queries.count() // queries_per_block))
    if held is not None:
        placed, doc_blocks = _placed_by_list(docs, held, per_block)
    else:
        doc_blocks = max(1, -(-docs.count() // per_block))
        placed = docs.withColumn("_block", F.pmod(F.xxhash64(*docs.columns), F.lit(doc_blocks)).cast("int"))
    hashed = F.pmod(F.xxhash64(*queries.columns[:2]), F.lit(query_blocks)).cast("int")
    cores = docs.sparkSession.sparkContext.defaultParallelism
    groups = max(-(-doc_blocks // _TASK_BLOCKS), min(doc_blocks, -(-_TASKS_PER_CORE * cores // query_blocks)))

    left = _packed(placed, 2 * per_block, ["id", "vector", "list_id"][: len(docs.columns)])
    left = left.select((F.col("block") % groups).alias("doc_group"), F.col("packed").alias("docs"))
    right = _packed(queries.withColumn("_block", hashed), 2 * queries_per_block, ["id", "vector", "lists"][: len(docs.columns)])
    right = right.select(F.col("block").alias("query_block"), F.col("part").alias("query_part"), F.col("packed").alias("queries"))
    # By numbers from 0, so that every partition has the like share of the blocks.
    left = left.repartitionById(groups, "doc_group")
    right = right.repartitionById(query_blocks, "query_block")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[tuple[int, int], _QueryBlock] = {}
        group = 0
        for batch in batches:
            for doc_group, some_docs, number, part, some_queries in zip(*batch.columns):
                key, group = (number.as_py(), part.as_py()), doc_group.as_py()
                if key not in blocks:
                    blocks[key] = _QueryBlock(some_queries, k, metric, products)
                blocks[key].add(_unpacked(some_docs))
        for block in blocks.values():
            yield _list_batch(block.nearest, block.ids, schema, group)

    # Pairs of blocks, not of rows: each side's shuffle is read by many tasks and written once.
    pairs = left.hint("shuffle_replicate_nl").crossJoin(right)
    lists = pairs.mapInArrow(compare, schema)
    return lists if groups > MERGE_GROUPS else lists.drop("merge_group")


def scan_by_list(
    docs: DataFrame,
    queries: DataFrame,
    k: int,
    metric: DistanceStrategy,
    held: dict[int, int],
    looked: dict[int, int],
    products: bool = False,
) -> DataFrame:
    """k nearest documents of each query in the lists it looks into, where few lists are looked into.

    ``docs`` is (id, vector, list_id), ``queries`` (query_id, vector, list_id)
    with one row for each list; ``held`` and ``looked`` are the rows of each
    list. Blocks of the same list meet through a shuffle of copies, each list
    in as many blocks as it needs.
    """
    schema = _lists(queries, docs, products)
    per_block, queries_per_block = rows_per_block(docs)
    table = docs.sparkSession.createDataFrame(
        [(i, -(-held[i] // per_block), -(-looked[i] // queries_per_block)) for i in held if i in looked],
        "list_id int, doc_blocks int, query_blocks int",
    )
    docs, queries = docs.join(F.broadcast(table), "list_id"), queries.join(F.broadcast(table), "list_id")
    doc_id, doc_vec = docs.columns[1:3]
    query_id, query_vec = queries.columns[1:3]

    def block(blocks: str, *columns: str) -> Column:
        return F.pmod(F.xxhash64(*columns), F.col(blocks)).cast("int")

    def every(blocks: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))

    left = docs.select(
        F.col(doc_id).alias("id"), F.col(doc_vec).alias("vector"), "list_id",
        block("doc_blocks", doc_id, doc_vec).alias("doc_block"), every("query_blocks").alias("query_block"),
    )
    right = queries.select(
        F.col(query_id).alias("query_id"), F.col(query_vec).alias("query_vector"), "list_id",
        block("query_blocks", query_id, query_vec).alias("query_block"), every("doc_blocks").alias("doc_block"),
    )
    keys = ["list_id", "doc_block", "query_block"]

    def compare(key: tuple, some_docs: pa.Table, some_queries: pa.Table) -> pa.Table:
        if some_docs.num_rows == 0 or some_queries.num_rows == 0:
            nearest = NearestRows(np.empty((0, 0)), k, metric, products)
            query_ids = some_queries["query_id"].combine_chunks().slice(0, 0)
        else:
            nearest = NearestRows(vectors_of(some_queries["query_vector"]), k, metric, products)
            query_ids = some_queries["query_id"].combine_chunks()
            nearest.add(vectors_of(some_docs["vector"]), _id_values(some_docs["id"].combine_chunks()))
        return pa.Table.from_batches([_list_batch(nearest, query_ids, schema, key[1].as_py())])

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, schema)


def merge_nearest(lists: DataFrame, k: int, metric: DistanceStrategy) -> DataFrame:
    nearest = F.desc_nulls_last if metric.larger_is_nearer else F.asc_nulls_last
    return merge_lists(lists, k, nearest("distance"))


def knn(
    docs: DataFrame,
    queries: DataFrame,
    k: int = DEFAULT_K,
    metric: DistanceStrategy = DistanceStrategy.COSINE_DISTANCE,
    filter: Filter | Column | None = None,
    spec: CollectionSpec = CollectionSpec(),
    max_broadcast_rows: int = MAX_QUERY_ROWS,
) -> DataFrame:
    """The k nearest documents of every query: (query_id, id, distance, rank).

    ``queries`` has the columns ``query_id`` and ``query_embedding``. The
    filter applies before the ranking. Equal distances are ordered by id; a
    document without a distance (cosine of a zero vector) comes last with NULL.
    """
    vectors = apply_filter(docs, filter, spec.metadata).select(spec.id, spec.embedding)
    vectors = vectors.where(F.col(spec.embedding).isNotNull())
    wanted = queries.select("query_id", "query_embedding").where(
        F.col("query_embedding").isNotNull()
    )
    block = collect_block(wanted, max_rows=max_broadcast_rows)
    if block is None:
        return merge_nearest(scan_in_blocks(vectors, wanted, k, metric), k, metric)
    return merge_nearest(scan_with_block(vectors, block, wanted, k, metric), k, metric)

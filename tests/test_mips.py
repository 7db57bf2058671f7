"""Inner product over lists of norm-augmented vectors: exact with every list probed."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from checks.dense import VECTORS
from checks.mips import mixed_lengths
from rankweave.operators import dense, ivf
from rankweave.operators.dense import NearestRows, knn
from rankweave.operators.mips import augmented_search, build_augmented_ivf
from rankweave.spec import DistanceStrategy

SF = "/root/testdata/sf0.001"


def test_all_lists_give_the_exact_products(spark):
    vectors = mixed_lengths(spark, SF)
    queries = vectors.where("vec_id % 7 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_embedding"))
    index = build_augmented_ivf(vectors, 8, VECTORS)
    got = sorted((r.query_id, r.rank, r.id, round(r.distance, 6)) for r in augmented_search(index, queries, 5, 8).collect())
    want = knn(vectors, queries, 5, DistanceStrategy.INNER_PRODUCT, spec=VECTORS)
    want = sorted((r.query_id, r.rank, r.id, round(r.distance, 6)) for r in want.collect())
    assert [g[:3] for g in got] == [w[:3] for w in want] and all(abs(a[3] - b[3]) < 1e-4 for a, b in zip(got, want))


def test_lengths_enter_the_extra_value(spark):
    rows = [(1, [3.0, 4.0]), (2, [0.6, 0.8]), (3, None)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    index = build_augmented_ivf(docs, 1, VECTORS)
    assert abs(index.longest - 5.0) < 1e-9 and index.docs.count() == 2


def test_equal_vectors_do_not_make_all_pairs_at_once():
    """Every pair is a candidate where all vectors are equal; they are ranked in parts."""
    queries, docs = np.ones((1000, 16)), np.ones((3000, 16))
    nearest = NearestRows(queries, 3, DistanceStrategy.INNER_PRODUCT)
    tracemalloc.start()
    nearest.add(docs, np.arange(3000)[::-1])
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 120e6
    assert sorted(nearest.ids.tolist()) == sorted([0, 1, 2] * 1000)


def test_queries_are_copied_for_their_lists_in_bounded_batches():
    vectors = np.random.default_rng(1).normal(size=(5000, 64))
    batch = pa.record_batch({"query_id": np.arange(5000), "query_embedding": pa.array(list(vectors))})
    made = list(ivf._copies(batch, vectors[:16], DistanceStrategy.EUCLIDEAN, 16, ["query_id", "query_embedding", "list_id"]))
    assert max(m.num_rows * 64 for m in made) <= ivf._COPIED_CELLS and sum(m.num_rows for m in made) == 16 * 5000
    got = pa.Table.from_batches(made)
    assert got.column("query_id").to_numpy().tolist() == np.repeat(np.arange(5000), 16).tolist()
    assert sorted(got.column("list_id").to_pylist()[-16:]) == list(range(16))


def test_blocks_of_documents_are_bounded(spark):
    """The documents that meet a block of queries at once stay few, and the result is the exact one."""
    assert dense._BLOCK_BYTES <= 8 << 20
    docs = mixed_lengths(spark, SF).select("vec_id", "embedding")
    queries = docs.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_embedding")).where("vec_id % 9 = 0")
    ip = DistanceStrategy.INNER_PRODUCT
    small = dense.scan_in_blocks(docs, queries, 4, ip, block_bytes=64 * 8 * 50)
    got = sorted(map(tuple, dense.merge_nearest(small, 4, ip).select("query_id", "rank", "id").collect()))
    want = sorted(map(tuple, knn(docs, queries, 4, ip, spec=VECTORS).select("query_id", "rank", "id").collect()))
    assert got == want

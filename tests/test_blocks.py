"""Blocks of queries and documents: exact, bounded, and written once whatever the number of block pairs."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rankweave.operators import dense, ivf
from rankweave.operators.dense import NearestRows, scan_in_blocks
from rankweave.operators.ivf import build_ivf, ivf_search
from rankweave.operators.mips import augmented_search, build_augmented_ivf
from rankweave.spec import CollectionSpec, DistanceStrategy, IvfParams

VECTORS = CollectionSpec(id="vec_id", metadata=None)


def stored(spark, vectors, ids=None):
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(range(len(vectors)) if ids is None else ids, vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)


def asking(docs):
    return docs.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_embedding"))


def small_blocks(monkeypatch, few_copies):
    for module in (dense, ivf):
        monkeypatch.setattr(module, "rows_per_block", lambda docs, block_bytes=0: (9, 5))
    monkeypatch.setattr(ivf, "_FEW_COPIES", few_copies)


def values(found, *more):
    return sorted((r["query_id"], r["rank"], r["id"], round(r["distance"], 9), *[r[m] for m in more]) for r in found.collect())


@pytest.mark.parametrize("metric", list(DistanceStrategy))
@pytest.mark.parametrize("few_copies", [0, 1 << 30])
@pytest.mark.parametrize("probes", [1, 2, 6])
def test_lists_in_blocks_find_what_a_broadcast_finds(spark, monkeypatch, metric, few_copies, probes):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(90, 8))
    vectors[20:50] = vectors[20]  # one list holds most rows, and they tie
    docs = stored(spark, vectors)
    index = build_ivf(docs, IvfParams(lists=6, distance_strategy=metric), VECTORS)
    want = values(ivf_search(index, asking(docs), 5, probes=probes, products=True), "product")
    small_blocks(monkeypatch, few_copies)
    got = values(ivf_search(index, asking(docs), 5, probes=probes, max_broadcast_rows=2, products=True), "product")
    assert got == want
    stored_as = vectors.astype(np.float32).astype(float)
    for query, _, doc, _, product in got:
        assert product == pytest.approx(stored_as[query] @ stored_as[doc], abs=1e-9)


@pytest.mark.parametrize("probes", [None, 6])
def test_a_block_is_written_once_and_not_for_each_block_it_meets(spark, monkeypatch, probes):
    docs = stored(spark, np.random.default_rng(5).normal(size=(90, 8)))
    small_blocks(monkeypatch, 4)
    if probes:
        found = ivf_search(build_ivf(docs, IvfParams(lists=6), VECTORS), asking(docs), 5, probes=probes, max_broadcast_rows=2)
    else:
        found = scan_in_blocks(docs, asking(docs), 5, DistanceStrategy.EUCLIDEAN)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("CartesianProduct") >= 1
    assert found.count() >= 90 * 5


def test_a_packed_row_holds_few_rows_where_an_id_comes_often(spark):
    rows = spark.createDataFrame([(7, [1.0, 2.0])] * 50 + [(8, [1.0, 2.0])] * 3, "id long, v array<float>")
    packed = dense._packed(rows.withColumn("_block", F.lit(0)), 20, ["id", "vector"]).collect()
    sizes = [pa.ipc.open_stream(r["packed"]).read_all().num_rows for r in packed]
    assert sorted(sizes) == [13, 20, 20] and len({r["part"] for r in packed}) == 3


def test_places_of_a_mask():
    rng = np.random.default_rng(6)
    for shape in ((3, 7), (5, 8), (1, 3), (4, 0)):
        mask = rng.random(shape) < 0.3
        assert dense._places(mask).tolist() == np.flatnonzero(mask).tolist()


def test_small_tiles_and_steps_give_the_same_rows(monkeypatch):
    rng = np.random.default_rng(7)
    docs, queries = rng.normal(size=(300, 6)).astype(np.float32), rng.normal(size=(40, 6))
    docs[100:200] = docs[100]
    docs[5] = 0.0

    def run(metric):
        nearest = NearestRows(queries, 7, metric)
        nearest.add(docs, np.arange(300))
        return sorted(zip(nearest.owner.tolist(), nearest.key.tolist(), nearest.ids.tolist()))

    want = [run(metric) for metric in DistanceStrategy]
    for name, value in (("_CELLS", 160), ("_STEP", 4), ("_TILE", 12), ("_CANDIDATES", 5)):
        monkeypatch.setattr(dense, name, value)
    assert [run(metric) for metric in DistanceStrategy] == want


def test_products_of_found_rows_need_no_join(spark):
    docs = stored(spark, np.random.default_rng(8).normal(size=(60, 8)) * np.arange(1, 61)[:, None])
    index = build_augmented_ivf(docs, 4, VECTORS)
    found = augmented_search(index, asking(docs), 5, 4)
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    held = {r["vec_id"]: r["embedding"] for r in docs.collect()}
    for r in found.collect():
        total = 0.0
        for a, b in zip(held[r["query_id"]], held[r["id"]]):
            total += a * b
        assert r["distance"] == total


def test_an_id_of_two_rows_stands_for_both(spark):
    """Each found pair meets every row of its ids, as a join of the ids gives it."""
    vectors = np.random.default_rng(9).normal(size=(12, 4))
    docs = stored(spark, vectors, [*range(10), 0, 1])
    index = build_augmented_ivf(docs, 2, VECTORS)
    found = augmented_search(index, asking(docs).where("query_id = 3"), 12, 2).collect()
    ids, exact = [*range(10), 0, 1], np.float32(vectors).astype(float)
    pairs = [(-float(exact[j] @ exact[3]), ids[j]) for i in range(12) for j in range(12) if ids[i] == ids[j]]
    want = [(r + 1, doc, round(-key, 9)) for r, (key, doc) in enumerate(sorted(pairs)[:12])]
    assert sorted((r["rank"], r["id"], round(r["distance"], 9)) for r in found) == want

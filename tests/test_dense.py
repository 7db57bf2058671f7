import numpy as np
import pytest

from rankweave.operators import dense
from rankweave.operators.dense import knn, scan_in_blocks
from rankweave.operators.topk import RunningTopK
from rankweave.operators.filters import MetadataFilter
from rankweave.operators.ivf import build_ivf, ivf_search, train_centers
from rankweave.plans.search import SearchTarget
from rankweave.operators.mmr import mmr, select_diverse
from rankweave.spec import CollectionSpec, DistanceStrategy, IterativeScanMode, IvfParams

COSINE, L2, IP = DistanceStrategy.COSINE_DISTANCE, DistanceStrategy.EUCLIDEAN, DistanceStrategy.INNER_PRODUCT


def make_docs(spark, vectors, as_text=False):
    data = [
        (f"d{i:04d}" if as_text else i, "t", [float(x) for x in v], '{"g": %d}' % (i % 3))
        for i, v in enumerate(vectors)
    ]
    kind = "string" if as_text else "int"
    return spark.createDataFrame(data, f"id {kind}, content string, embedding array<float>, metadata string").repartition(3)


def make_queries(spark, vectors):
    data = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(data, "query_id int, query_embedding array<float>")


def brute(docs, queries, k, metric, keep=lambda i: True):
    docs, queries = docs.astype(np.float32).astype(float), queries.astype(np.float32).astype(float)
    out = []
    for qi, q in enumerate(queries):
        scored = []
        for i, d in enumerate(docs):
            if not keep(i):
                continue
            if metric is COSINE:
                n = np.linalg.norm(q) * np.linalg.norm(d)
                key = value = 1 - q @ d / n if n else None
                key = np.inf if key is None else key
            elif metric is L2:
                key = value = np.linalg.norm(q - d)
            else:
                value = float(q @ d)
                key = -value
            scored.append((round(key, 9), i, value))
        scored.sort(key=lambda s: s[:2])
        out += [(qi, i, r + 1, v) for r, (_, i, v) in enumerate(scored[:k])]
    return out


def check(found, want):
    got = sorted((r["query_id"], r["rank"], r["id"], r["distance"]) for r in found.collect())
    assert [g[:3] for g in got] == sorted((q, r, i) for q, i, r, _ in want)
    for g, (_, _, _, v) in zip(got, sorted(want, key=lambda w: (w[0], w[2]))):
        assert (g[3] is None) == (v is None)
        if v is not None:
            assert g[3] == pytest.approx(v, abs=1e-9)


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(7)
    docs = rng.normal(size=(200, 12))
    docs[50:120] = docs[50]  # a third of the rows are copies of one vector
    docs[130] = 0.0
    queries = np.vstack([rng.normal(size=(9, 12)), docs[50] + 1e-3])
    return docs, queries


@pytest.mark.parametrize("metric", list(DistanceStrategy))
@pytest.mark.parametrize("limit", [8192, 4])
def test_same_as_brute_force(spark, data, metric, limit):
    docs, queries = data
    found = knn(make_docs(spark, docs), make_queries(spark, queries), 15, metric, max_broadcast_rows=limit)
    check(found, brute(docs, queries, 15, metric))


@pytest.mark.parametrize("metric", list(DistanceStrategy))
def test_many_small_blocks(spark, data, metric):
    docs, queries = data
    left = make_docs(spark, docs).select("id", "embedding")
    lists = scan_in_blocks(left, make_queries(spark, queries), 15, metric, block_bytes=8 * 12 * 7)
    check(dense.merge_nearest(lists, 15, metric), brute(docs, queries, 15, metric))


def test_a_large_query_set_is_one_job_and_not_one_a_block(spark, data):
    docs, _ = data
    counter = spark.sparkContext
    counter.setJobGroup("many-queries", "")
    try:
        found = knn(make_docs(spark, docs), make_queries(spark, docs), 5, COSINE, max_broadcast_rows=2).collect()
        jobs = counter.statusTracker().getJobIdsForGroup("many-queries")
    finally:
        counter.setLocalProperty("spark.jobGroup.id", None)
    assert len({r["query_id"] for r in found}) == len(docs)
    assert len(jobs) < 40


def test_lists_that_get_no_row_stay_as_they_are():
    best = RunningTopK(3, 2)
    best.offer(np.array([0, 0, 1, 2]), np.array([3.0, 1.0, 5.0, 4.0]), np.array([7, 8, 9, 6]))
    before = best.owner
    best.offer(np.array([1, 1]), np.array([6.0, 5.0]), np.array([3, 2]))
    assert sorted(zip(best.owner, best.key, best.ids)) == [(0, 1.0, 8), (0, 3.0, 7), (1, 5.0, 2), (1, 5.0, 9), (2, 4.0, 6)]
    assert before is not best.owner and best.bound.tolist() == [3.0, 5.0, np.inf]


def test_filter_comes_before_the_ranking(spark, data):
    docs, queries = data
    found = knn(make_docs(spark, docs), make_queries(spark, queries), 5, filter=MetadataFilter("g", 1))
    check(found, brute(docs, queries, 5, COSINE, lambda i: i % 3 == 1))


def test_zero_vector_is_last_without_a_distance(spark):
    docs = np.array([[1.0, 0.0], [0.0, 0.0], [0.0, 1.0]])
    found = knn(make_docs(spark, docs), make_queries(spark, [[1.0, 0.0]]), 10)
    assert [(r["id"], r["distance"]) for r in found.orderBy("rank").collect()] == [(0, 0.0), (2, 1.0), (1, None)]


def test_text_ids_and_fewer_rows_than_k(spark):
    docs = np.array([[1.0, 0.0], [1.0, 0.0], [0.0, 1.0]])
    found = knn(make_docs(spark, docs, as_text=True), make_queries(spark, [[1.0, 0.0]]), 10)
    assert [r["id"] for r in found.orderBy("rank").collect()] == ["d0000", "d0001", "d0002"]


def test_no_queries_and_wrong_length(spark, data):
    docs, _ = data
    assert knn(make_docs(spark, docs), make_queries(spark, np.zeros((1, 12))).limit(0), 3).count() == 0
    with pytest.raises(Exception, match="values"):
        knn(make_docs(spark, docs), make_queries(spark, [[1.0, 2.0]]), 3).count()


def test_plan_ships_k_rows_and_reads_two_columns(spark, data, tmp_path):
    path = str(tmp_path / "docs")
    make_docs(spark, data[0]).write.parquet(path)
    plan = knn(spark.read.parquet(path), make_queries(spark, data[1]), 3)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:int,embedding:array<float>>" in plan
    assert "WindowGroupLimit" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("metric", list(DistanceStrategy))
@pytest.mark.parametrize("limit", [8192, 4])
def test_all_probes_are_exact(spark, data, metric, limit):
    docs, queries = data
    index = build_ivf(make_docs(spark, docs), IvfParams(lists=5, distance_strategy=metric))
    found = ivf_search(index, make_queries(spark, queries), 8, probes=5, max_broadcast_rows=limit)
    check(found, brute(docs, queries, 8, metric))


@pytest.mark.parametrize("limit", [8192, 4])
def test_both_paths_probe_the_same_lists(spark, data, limit):
    docs, queries = data
    index = build_ivf(make_docs(spark, docs), IvfParams(lists=5))
    one = ivf_search(index, make_queries(spark, queries), 8, probes=2, max_broadcast_rows=limit)
    two = ivf_search(index, make_queries(spark, queries), 8, probes=2, max_broadcast_rows=8192)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    near = {(r["query_id"], r["id"]) for r in one.collect()}
    exact = {(q, i) for q, i, _, _ in brute(docs, queries, 8, COSINE)}
    assert len(near & exact) > 0


def test_iterative_scan_fills_short_results(spark, data):
    docs, queries = data
    index = build_ivf(make_docs(spark, docs), IvfParams(lists=20))
    only = MetadataFilter("g", 2)
    short = ivf_search(index, make_queries(spark, queries), 40, probes=1, filter=only)
    full = ivf_search(
        index, make_queries(spark, queries), 40, 1, only, IterativeScanMode.STRICT_ORDER
    )
    assert short.count() < 40 * len(queries)
    assert full.count() == 40 * len(queries)


def test_partial_index(spark, data):
    docs, queries = data
    index = build_ivf(make_docs(spark, docs), IvfParams(lists=4, where="id < 60"))
    found = ivf_search(index, make_queries(spark, queries), 5, probes=4)
    check(found, brute(docs, queries, 5, COSINE, lambda i: i < 60))


def greedy(query, docs, k, lam):
    """Plain MMR by the published formula."""
    def cos(a, b):
        n = np.linalg.norm(a) * np.linalg.norm(b)
        return a @ b / n if n else 0.0

    chosen = []
    while len(chosen) < min(k, len(docs)):
        best, best_score = None, -np.inf
        for i, d in enumerate(docs):
            if i in chosen:
                continue
            score = cos(query, d)
            if chosen:
                score = lam * score - (1 - lam) * max(cos(d, docs[j]) for j in chosen)
            if score > best_score + 1e-12:
                best, best_score = i, score
        chosen.append(best)
    return chosen


@pytest.mark.parametrize("lam", [0.0, 0.3, 0.5, 1.0])
def test_mmr_choice(data, lam):
    docs, queries = data
    some = docs[:40]
    for q in queries:
        assert select_diverse(q, some, 6, lam) == greedy(q, some, 6, lam)


def test_mmr_is_listed_by_distance(spark, data):
    docs, queries = data
    found = mmr(make_docs(spark, docs), make_queries(spark, queries), 4, 20, 0.5).collect()
    nearest = brute(docs, queries, 20, COSINE)
    f32 = docs.astype(np.float32).astype(float), queries.astype(np.float32).astype(float)
    for qi in range(len(queries)):
        cand = [i for q, i, _, _ in nearest if q == qi]
        want = [cand[p] for p in greedy(f32[1][qi], f32[0][cand], 4, 0.5)]
        mine = sorted((r for r in found if r["query_id"] == qi), key=lambda r: r["mmr_order"])
        assert [r["id"] for r in mine] == want
        by_rank = sorted(mine, key=lambda r: r["rank"])
        assert [r["id"] for r in by_rank] == [i for i in cand if i in want]


def test_mmr_of_an_empty_collection(spark, data):
    docs = make_docs(spark, data[0]).limit(0)
    assert mmr(docs, make_queries(spark, data[1])).count() == 0
    assert CollectionSpec().columns() == ["id", "content", "embedding", "metadata"]


def test_training_does_not_depend_on_the_layout(spark):
    rng = np.random.default_rng(2)
    docs = make_docs(spark, rng.normal(size=(300, 6)))
    found = [train_centers(docs.repartition(n), IvfParams(lists=7)) for n in (1, 2, 5)]
    assert (found[0] == found[1]).all() and (found[0] == found[2]).all()


def test_a_partial_index_is_not_used_without_its_condition(spark):
    rng = np.random.default_rng(3)
    docs = make_docs(spark, rng.normal(size=(50, 4)))
    index = build_ivf(docs, IvfParams(lists=3, where="id < 30"))
    target = SearchTarget(docs, vectors=index)
    assert target.usable_vectors() is None
    assert SearchTarget(docs, vectors=index, filters_imply_index=True).usable_vectors() is index

import pytest
from pyspark.sql import functions as F

from rankweave.functions.embedders import embed_queries, hash_embedder
from rankweave.operators.filters import MetadataFilter
from rankweave.operators.fusion import reciprocal_rank_fusion, weighted_sum_ranking
from rankweave.plans.search import SearchTarget, ranked, search
from rankweave.spec import DistanceStrategy, SearchConfig

DENSE = "query_id int, id string, distance double, rank int"
SPARSE = "query_id int, id string, bm25_score double, rank int"


def arms(spark, dense, sparse):
    return (
        spark.createDataFrame([(0, i, d, r + 1) for r, (i, d) in enumerate(dense)], DENSE),
        spark.createDataFrame([(0, i, s, r + 1) for r, (i, s) in enumerate(sparse)], SPARSE),
    )


def ordered(df):
    return [(r["id"], round(r["score"], 9)) for r in df.orderBy("rank").collect()]


def test_rrf_by_hand(spark):
    d, s = arms(spark, [("a", 0.1), ("b", 0.2), ("c", 0.3)], [("c", -5.0), ("d", -4.0)])
    assert ordered(reciprocal_rank_fusion(d, s, fetch_top_k=10)) == [
        ("c", round(1 / 63 + 1 / 61, 9)), ("a", round(1 / 61, 9)), ("b", round(1 / 62, 9)), ("d", round(1 / 62, 9)),
    ]
    weighted = reciprocal_rank_fusion(d, s, rrf_k=20, dense_weight=0.7, sparse_weight=0.3, fetch_top_k=2)
    assert ordered(weighted) == [("c", round(0.7 / 23 + 0.3 / 21, 9)), ("a", round(0.7 / 21, 9))]


def test_rrf_of_one_arm_keeps_its_order(spark):
    d, s = arms(spark, [("x", 0.1), ("a", 0.1), ("m", 0.1)], [])
    assert [i for i, _ in ordered(reciprocal_rank_fusion(d, s))] == ["x", "a", "m"]
    d, s = arms(spark, [], [("x", -1.0), ("a", -1.0)])
    assert [i for i, _ in ordered(weighted_sum_ranking(d, s))] == ["x", "a"]


def test_weighted_sum_by_hand(spark):
    d, s = arms(spark, [("a", 0.0), ("b", 0.5), ("c", 1.0)], [("c", -4.0), ("d", -3.0), ("e", -2.0)])
    assert ordered(weighted_sum_ranking(d, s, fetch_top_k=10)) == [
        ("a", 0.5), ("c", 0.5), ("b", 0.25), ("d", 0.25), ("e", 0.0)]
    d, s = arms(spark, [("a", 9.0), ("b", 7.0), ("c", 1.0)], [("c", -4.0)])
    product = weighted_sum_ranking(d, s, 0.7, 0.3, 10, DistanceStrategy.INNER_PRODUCT)
    # A single candidate has no spread; it counts as the best of its arm.
    assert ordered(product) == [("a", 0.7), ("b", 0.525), ("c", 0.3)]


def test_equal_scores_within_an_arm(spark):
    d, s = arms(spark, [("a", 0.4), ("b", 0.4)], [("b", -1.0), ("z", -1.0)])
    assert ordered(weighted_sum_ranking(d, s, fetch_top_k=10)) == [("b", 1.0), ("a", 0.5), ("z", 0.5)]


@pytest.fixture(scope="module")
def target(spark):
    texts = ["red apple", "green apple pie", "blue sea", "red sea", "apple apple", "stone"]
    docs = spark.createDataFrame(
        [(i, t, '{"n": %d}' % i if i else None) for i, t in enumerate(texts)], "id int, content string, metadata string"
    )
    return SearchTarget(docs.withColumn("embedding", hash_embedder(16).documents(F.col("content"))))


@pytest.fixture(scope="module")
def asked(spark):
    queries = spark.createDataFrame([(0, "red apple"), (1, "sea")], "query_id int, query_text string")
    return embed_queries(queries, hash_embedder(16))


@pytest.mark.parametrize("metric", list(DistanceStrategy))
def test_hybrid_search_returns_rows(target, asked, metric):
    found = search(target, asked, SearchConfig(distance_strategy=metric), k=3).collect()
    assert len(found) == 6
    for r in found:
        assert isinstance(r["id"], str) and isinstance(r["score"], float) and r["content"]
        assert r["metadata"] == ("{}" if r["id"] == "0" else '{"n": %s}' % r["id"])
    assert {r["rank"] for r in found} == {1, 2, 3}


def test_each_arm_alone(target, asked):
    sparse = ranked(target, asked, SearchConfig(enable_dense=False, sparse_top_k=2), 10).collect()
    assert {(r["query_id"], r["id"]) for r in sparse if r["query_id"] == 1} == {(1, 2), (1, 3)}
    assert max(r["rank"] for r in sparse) == 2 and all(r["score"] == r["bm25_score"] < 0 for r in sparse)
    dense = ranked(target, asked, SearchConfig(enable_sparse=False), 2).collect()
    assert all(r["score"] == r["distance"] for r in dense)
    exact = [r for r in dense if r["query_id"] == 0 and r["rank"] == 1]
    assert exact[0]["id"] == 0 and exact[0]["score"] == pytest.approx(0, abs=1e-6)


def test_filter_and_projection(target, asked):
    found = search(target, asked, k=10, filter=MetadataFilter("n", 3), with_score=False)
    assert found.columns == ["query_id", "rank", "id", "content", "metadata"]
    assert {r["id"] for r in found.collect()} == {"3"}


def test_own_fusion_gets_weights_and_parameters(target, asked):
    seen = {}

    def first_arm(dense, sparse, **params):
        seen.update(params)
        return reciprocal_rank_fusion(dense, sparse.limit(0), fetch_top_k=params["fetch_top_k"])

    config = SearchConfig(fusion_function=first_arm, fusion_function_parameters={"x": 1}, dense_weight=0.2)
    assert ranked(target, asked, config, 2).count() == 4
    assert seen["x"] == 1 and seen["dense_weight"] == 0.2 and seen["fetch_top_k"] == 2


def test_configuration_errors(target, asked):
    with pytest.raises(ValueError):
        SearchConfig(enable_dense=False, enable_sparse=False)
    with pytest.raises(ValueError):
        SearchConfig(fusion_function_parameters={"dense_weight": 0.7})
    with pytest.raises(TypeError):
        SearchConfig(unknown_option=1)
    with pytest.raises(ValueError):
        ranked(target, asked.drop("query_text"), SearchConfig(enable_dense=False))

import math
import random

import pytest
from pyspark.sql import functions as F

from rankweave.plans import similarity
from rankweave.plans.evaluate import (
    SWEEP,
    evaluate,
    mark_relevant,
    query_metrics,
    relevant_counts,
    summary_table,
    sweep,
)
from rankweave.plans.similarity import (
    length_histogram,
    negative_pairs,
    positive_pairs,
    sample_queries,
    similarity_histogram,
    similarity_stats,
)


def plain(retrieved, relevant, k):
    """The metric definitions, for one query."""
    top = retrieved[:k]
    found = len(set(top) & relevant)
    gain = sum(1 / math.log2(i + 2) for i, d in enumerate(top) if d in relevant)
    ideal = sum(1 / math.log2(i + 2) for i in range(min(len(relevant), k)))
    hits, precisions, first = 0, 0.0, 0.0
    for i, d in enumerate(retrieved):
        if d in relevant:
            hits += 1
            precisions += hits / (i + 1)
            first = first or 1 / (i + 1)
    return (
        found / len(relevant) if relevant else 0.0, found / k, gain / ideal if ideal else 0.0,
        first, precisions / len(relevant) if relevant else 0.0,
    )


@pytest.fixture(scope="module")
def case(spark):
    rng = random.Random(3)
    runs = {}
    for config in ("one", "two"):
        for q in range(8):
            # Lists repeat documents now and then; query 7 finds nothing.
            runs[config, q] = [] if q == 7 else [rng.randrange(12) for _ in range(rng.randrange(1, 20))]
    qrels = {q: {rng.randrange(12) for _ in range(rng.randrange(1, 6))} for q in range(8)}
    results = spark.createDataFrame(
        [(c, q, d, r + 1) for (c, q), docs in runs.items() for r, d in enumerate(docs)],
        "config string, query_id int, id int, rank int",
    )
    pairs = spark.createDataFrame([(q, d) for q, ds in qrels.items() for d in ds] * 2, "query_id int, doc_id int")
    return runs, qrels, results, pairs


def test_every_query_by_definition(case):
    runs, qrels, results, pairs = case
    found = query_metrics(mark_relevant(results, pairs), relevant_counts(pairs), (1, 5, 20)).collect()
    assert len(found) == 2 * 8 * 3
    for r in found:
        want = plain(runs[r["config"], r["query_id"]], qrels[r["query_id"]], r["k"])
        assert (r["recall"], r["precision"], r["ndcg"], r["mrr"], r["ap"]) == pytest.approx(want)


def test_means_and_summary(spark, case):
    runs, qrels, results, pairs = case
    queries = spark.createDataFrame([(q, "t") for q in range(1, 8)], "query_id int, query_text string")
    means = evaluate(results, pairs, queries, (5, 10))
    for r in means.collect():
        each = [plain(runs[r["config"], q], qrels[q], r["k"]) for q in range(1, 8)]
        want = [sum(m[i] for m in each) / 7 for i in range(5)]
        assert [r["recall"], r["precision"], r["ndcg"], r["mrr"], r["map"]] == pytest.approx(want)
    table = summary_table(means, (5, 10))
    assert table.columns == ["config", "R@5", "R@10", "nDCG@5", "nDCG@10", "MRR", "MAP"]
    assert table.count() == 2


def test_by_hand(spark):
    results = spark.createDataFrame([("c", 0, d, r + 1) for r, d in enumerate("xaybz")], "config string, query_id int, id string, rank int")
    pairs = spark.createDataFrame([(0, "a"), (0, "b"), (0, "missing")], "query_id int, doc_id string")
    r = query_metrics(mark_relevant(results, pairs), relevant_counts(pairs), (4,)).first()
    assert r["recall"] == pytest.approx(2 / 3) and r["precision"] == 0.5 and r["mrr"] == 0.5
    assert r["ap"] == pytest.approx((1 / 2 + 2 / 4) / 3)
    assert r["ndcg"] == pytest.approx((1 / math.log2(3) + 1 / math.log2(5)) / (1 + 1 / math.log2(3) + 0.5))


def test_sweep_configurations(spark):
    dense = spark.createDataFrame([(0, i, float(i), i + 1) for i in range(40)], "query_id int, id int, distance double, rank int")
    sparse = spark.createDataFrame([(0, 60 - i, -float(i), i + 1) for i in range(40)], "query_id int, id int, bm25_score double, rank int")
    best = {r["config"]: [] for r in sweep(dense, sparse).select("config").distinct().collect()}
    for r in sweep(dense, sparse).orderBy("config", "rank").collect():
        best[r["config"]].append(r["id"])
    assert set(best) == {c.name for c in SWEEP}
    assert best["dense"] == list(range(20)) and best["sparse (BM25)"] == list(range(60, 40, -1))
    assert all(len(ids) == 20 for ids in best.values())
    assert best["hybrid (RRF k=60, d=0.7)"] != best["hybrid (RRF k=60)"]


def test_negatives_do_not_depend_on_layout_or_ranges(spark, monkeypatch):
    pairs = spark.createDataFrame([(q, (q * 7 + d) % 500) for q in range(40) for d in range(q % 5 + 1)], "query_id int, doc_id long")
    sample = pairs.select("query_id").distinct()
    docs = spark.range(500).select(F.col("id").alias("doc_id"))
    found = []
    for rows, parts in ((50_000, 1), (50_000, 7), (1, 3)):
        monkeypatch.setattr(similarity, "NUMBERED_ROWS", rows)
        found.append(sorted(map(tuple, negative_pairs(sample, pairs, docs.repartition(parts)).collect())))
    assert found[0] == found[1] == found[2] and len(found[0]) == 40


def test_negatives_are_not_relevant(spark):
    docs = spark.range(30).select(F.col("id").alias("doc_id"))
    # Query 0 finds every document but one relevant.
    pairs = spark.createDataFrame([(0, d) for d in range(29)] + [(q, q) for q in range(1, 20)], "query_id int, doc_id long")
    queries = spark.createDataFrame([(q,) for q in range(25)], "query_id int")
    sample = sample_queries(pairs, queries, 12)
    assert sample.count() == 12 and sample.collect() == sample_queries(pairs, queries, 12).collect()
    sample = sample_queries(pairs, queries)
    negative = {r["query_id"]: r["doc_id"] for r in negative_pairs(sample, pairs, docs).collect()}
    assert set(negative) == set(range(20))
    assert negative[0] == 29 and all(negative[q] != q for q in range(1, 20))
    assert len(set(negative.values())) > 5
    positive = {r["query_id"]: r["doc_id"] for r in positive_pairs(sample, pairs).collect()}
    assert positive == {0: 0} | {q: q for q in range(1, 20)}


def test_similarity_tables(spark):
    values = [-0.2, 0.0, 1 / 49, 0.5, 0.999, 1.0, 1.0]
    df = spark.createDataFrame([("p", v) for v in values], "kind string, similarity double")
    bins = {r["bin"]: r["n"] for r in similarity_histogram(df).collect()}
    assert bins == {1: 1, 2: 1, 25: 1, 49: 3}
    s = similarity_stats(df).first()
    mean = sum(values) / 7
    assert s["mean"] == pytest.approx(mean) and s["min"] == -0.2 and s["max"] == 1.0
    assert s["std"] == pytest.approx(math.sqrt(sum((v - mean) ** 2 for v in values) / 7))


def test_length_histogram(spark):
    df = spark.createDataFrame([("x" * n,) for n in (0, 1, 9, 10, 55, 100)], "t string")
    assert {r["bin"]: r["n"] for r in length_histogram(df, "t").collect()} == {1: 3, 2: 1, 6: 1, 10: 1}
    same = spark.createDataFrame([("abc",)] * 4, "t string")
    assert {r["bin"]: r["n"] for r in length_histogram(same, "t").collect()} == {6: 4}

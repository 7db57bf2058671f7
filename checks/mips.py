"""Registered queries: inner-product search over lists of norm-augmented vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.dense import LISTS, VECTORS
from checks.tables import table
from rankweave.operators.dense import knn
from rankweave.operators.ivf import build_ivf, ivf_search
from rankweave.operators.mips import augmented_search, build_augmented_ivf
from rankweave.plans.evaluate import mark_relevant, mean_metrics, query_metrics
from rankweave.spec import DistanceStrategy, IvfParams

IP = DistanceStrategy.INNER_PRODUCT


def mixed_lengths(spark, sf):
    """The stored vectors, each stretched by 1 to 5 times, by its id."""
    vectors = table(spark, sf, "embeddings")
    stretch = (F.col("vec_id") % 5 + 1).cast("double")
    return vectors.withColumn("embedding", F.transform("embedding", lambda x: x * stretch))


def augmented_recall(spark, sf):
    """Recall at 10 against the exact inner product: augmented lists by probes, and unit-scaled lists."""
    vectors = mixed_lengths(spark, sf)
    queries = vectors.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_embedding"))
    truth = knn(vectors, queries, 10, IP, spec=VECTORS).select("query_id", F.col("id").alias("doc_id"))
    judged = queries.select("query_id", F.lit(10).alias("n_rel"))
    index = build_augmented_ivf(vectors, LISTS, VECTORS)
    runs = {f"augmented probes={p}": augmented_search(index, queries, 10, p) for p in (1, 4, 8, 12, LISTS)}
    unit = build_ivf(vectors, IvfParams(lists=LISTS, distance_strategy=IP), VECTORS)
    runs["unit-scaled probes=2"] = ivf_search(unit, queries, 10, probes=2)
    results = None
    for name, found in runs.items():
        one = found.select("query_id", "id", "rank", "distance").withColumn("config", F.lit(name))
        results = one if results is None else results.unionByName(one)
    means = mean_metrics(query_metrics(mark_relevant(results, truth), judged, (10,), list(runs)))
    return means.select("config", "k", F.round("recall", 6).alias("recall"))


QUERIES = {"ivf_ip_augmented_recall": augmented_recall}
# Trained lists are not SQL; tests/test_mips.py holds the search against the exact one.
ORACLE: dict[str, str] = {}

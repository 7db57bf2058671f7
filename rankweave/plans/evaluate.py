"""Retrieval quality: per-query metrics, means, result tables, config sweep."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankweave.operators.topk import top_per_query

# List lengths at which the metrics are taken.
K_VALUES = (5, 10, 20)


@dataclass(frozen=True)
class SweepConfig:
    """One row of a parameter sweep; a weight of None switches the arm off."""

    name: str
    rrf_k: float = 60.0
    dense_weight: float | None = 1.0
    sparse_weight: float | None = 1.0
    dense_top_k: int = 100
    sparse_top_k: int = 100


# The six configurations that are compared.
SWEEP = (
    SweepConfig("dense", sparse_weight=None, dense_top_k=20),
    SweepConfig("sparse (BM25)", dense_weight=None, sparse_top_k=20),
    SweepConfig("hybrid (RRF k=60)"),
    SweepConfig("hybrid (RRF k=60, d=0.7)", dense_weight=0.7, sparse_weight=0.3),
    SweepConfig("hybrid (RRF k=30, d=0.7)", rrf_k=30.0, dense_weight=0.7, sparse_weight=0.3),
    SweepConfig("hybrid (RRF k=20)", rrf_k=20.0),
)


def sweep(
    dense: DataFrame, sparse: DataFrame, k: int = max(K_VALUES), configs: Sequence[SweepConfig] = SWEEP
) -> DataFrame:
    """Fuse one pair of candidate lists under many configurations.

    The candidates are computed once; each row is copied once for every
    configuration that uses its arm. Result: config, query_id, id, score, rank.
    """

    def arm(rows: DataFrame, weight: str, top_k: str, ranks: str) -> DataFrame:
        used = [c for c in configs if getattr(c, weight) is not None]
        options = F.array(
            *[
                F.struct(
                    F.lit(c.name).alias("config"),
                    F.lit(float(c.rrf_k)).alias("rrf_k"),
                    F.lit(float(getattr(c, weight))).alias("weight"),
                    F.lit(getattr(c, top_k)).alias("top_k"),
                )
                for c in used
            ]
        )
        copied = rows.select("query_id", "id", "rank", F.inline(options)).where("rank <= top_k")
        part = F.col("weight") * (1.0 / (F.col("rank") + F.col("rrf_k")))
        places = {
            name: (F.col("rank") if name == ranks else F.lit(None).cast("int")).alias(name)
            for name in ("dense_rank", "sparse_rank")
        }
        return copied.select("config", "query_id", "id", part.alias("part"), *places.values())

    both = arm(dense, "dense_weight", "dense_top_k", "dense_rank").unionByName(
        arm(sparse, "sparse_weight", "sparse_top_k", "sparse_rank")
    )
    fused = both.groupBy("config", "query_id", "id").agg(
        F.sum("part").alias("score"),
        F.min("dense_rank").alias("dense_rank"),
        F.min("sparse_rank").alias("sparse_rank"),
    )
    order = [F.desc("score"), F.asc_nulls_last("dense_rank"), F.asc_nulls_last("sparse_rank")]
    best = top_per_query(fused, k, order, by=["config", "query_id"])
    return best.select("config", "query_id", "id", "score", "rank")


def relevant_counts(qrels: DataFrame) -> DataFrame:
    """Number of different relevant documents of each query: query_id, n_rel."""
    pairs = qrels.select("query_id", "doc_id").distinct()
    return pairs.groupBy("query_id").agg(F.count("*").alias("n_rel"))


def mark_relevant(results: DataFrame, qrels: DataFrame) -> DataFrame:
    """Results with ``rel``: 1 where the document is judged relevant, else 0."""
    pairs = qrels.select("query_id", F.col("doc_id").alias("id")).distinct()
    judged = pairs.withColumn("rel", F.lit(1))
    marked = results.join(judged, ["query_id", "id"], "left")
    return marked.withColumn("rel", F.coalesce("rel", F.lit(0)))


def _ideal_gain(n_rel, k: int):
    """DCG of a list that starts with all relevant documents, cut at k."""
    best = F.least(n_rel, F.lit(k)).cast("int")
    gains = F.sequence(F.lit(1), best)
    total = F.aggregate(
        gains, F.lit(0.0), lambda acc, i: acc + F.lit(1.0) / F.log2(i.cast("double") + 1)
    )
    return F.when(best > 0, total).otherwise(F.lit(0.0))


def query_metrics(
    marked: DataFrame,
    judged: DataFrame,
    ks: Sequence[int] = K_VALUES,
    configs: Sequence[str] | None = None,
) -> DataFrame:
    """Metrics of every judged query: config, query_id, k, recall, precision,
    ndcg, mrr, ap.

    ``marked`` is (config, query_id, id, rank, rel), ``judged`` (query_id,
    n_rel). A judged query without results counts with zeros, under every name
    in ``configs``. Recall and precision count a document once however often
    it is listed; MRR and AP look at the whole list.
    """
    by = ["config", "query_id"]
    if configs is None:
        configs = [row[0] for row in marked.select("config").distinct().collect()]
    listed = Window.partitionBy(*by).orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    first = Window.partitionBy(*by, "id").orderBy("rank")
    hits = (
        marked.where("rel = 1")
        .withColumn("hits", F.sum("rel").over(listed))
        .withColumn("is_first", F.row_number().over(first) == 1)
    )
    gain = F.lit(1.0) / F.log2(F.col("rank") + 1.0)
    totals = hits.groupBy(*by).agg(
        *[F.count_if(F.col("is_first") & (F.col("rank") <= k)).alias(f"found_{k}") for k in ks],
        *[F.sum(F.when(F.col("rank") <= k, gain).otherwise(0.0)).alias(f"dcg_{k}") for k in ks],
        F.min("rank").alias("first_hit"),
        F.sum(F.col("hits") / F.col("rank")).alias("precisions"),
    )
    names = F.explode(F.array(*map(F.lit, configs))).alias("config")
    every = judged.select(names, "query_id", "n_rel").join(totals, by, "left")

    n_rel = F.col("n_rel")
    per_k = F.array(
        *[
            F.struct(
                F.lit(k).alias("k"),
                F.coalesce(F.try_divide(F.col(f"found_{k}"), n_rel), F.lit(0.0)).alias("recall"),
                F.coalesce(F.col(f"found_{k}") / F.lit(k) if k > 0 else F.lit(0.0), F.lit(0.0)).alias("precision"),
                F.coalesce(F.try_divide(F.col(f"dcg_{k}"), _ideal_gain(n_rel, k)), F.lit(0.0)).alias("ndcg"),
            )
            for k in ks
        ]
    )
    return every.select(
        *by,
        F.inline(per_k),
        F.coalesce(1.0 / F.col("first_hit"), F.lit(0.0)).alias("mrr"),
        F.coalesce(F.try_divide(F.col("precisions"), n_rel), F.lit(0.0)).alias("ap"),
    )


def mean_metrics(per_query: DataFrame) -> DataFrame:
    """Means over the judged queries: config, k, recall, precision, ndcg, mrr, map."""
    return per_query.groupBy("config", "k").agg(
        F.avg("recall").alias("recall"),
        F.avg("precision").alias("precision"),
        F.avg("ndcg").alias("ndcg"),
        F.avg("mrr").alias("mrr"),
        F.avg("ap").alias("map"),
    )


def evaluate(
    results: DataFrame,
    qrels: DataFrame,
    queries: DataFrame,
    ks: Sequence[int] = K_VALUES,
    configs: Sequence[str] | None = None,
) -> DataFrame:
    """Mean metrics of ranked results over the judged queries that have a text."""
    judged = relevant_counts(qrels).join(queries.select("query_id").distinct(), "query_id", "left_semi")
    return mean_metrics(query_metrics(mark_relevant(results, qrels), judged, ks, configs))


def summary_table(means: DataFrame, ks: Sequence[int] = K_VALUES) -> DataFrame:
    """One row for each configuration: R@k and nDCG@k for every k, MRR, MAP."""
    at = {k: F.col("k") == k for k in ks}
    return means.groupBy("config").agg(
        *[F.max(F.when(at[k], F.col("recall"))).alias(f"R@{k}") for k in ks],
        *[F.max(F.when(at[k], F.col("ndcg"))).alias(f"nDCG@{k}") for k in ks],
        F.max(F.when(at[ks[0]], F.col("mrr"))).alias("MRR"),
        F.max(F.when(at[ks[0]], F.col("map"))).alias("MAP"),
    )

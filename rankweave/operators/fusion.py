"""Fusion of the dense and the sparse candidates of each query.

Both inputs are candidate lists with a ``rank`` from 1: dense (query_id, id,
distance, rank), sparse (query_id, id, bm25_score, rank). The result has one
row for each fused document: query_id, id, score, rank, distance, bm25_score,
dense_rank, sparse_rank. Equal scores keep the order dense rank, then sparse
rank. A fusion of one's own is any function with the signature of the two here.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankweave.operators.topk import top_per_query
from rankweave.spec import DEFAULT_K, DistanceStrategy

TIE_ORDER = ["dense_rank", "sparse_rank"]


def _fuse(dense: DataFrame, sparse: DataFrame, dense_part: Column, sparse_part: Column) -> DataFrame:
    """Union of both arms, summed for each document."""
    left = dense.select(
        "query_id", "id", dense_part.alias("part"), "distance",
        F.lit(None).cast("double").alias("bm25_score"),
        F.col("rank").alias("dense_rank"), F.lit(None).cast("int").alias("sparse_rank"),
    )
    right = sparse.select(
        "query_id", "id", sparse_part.alias("part"),
        F.lit(None).cast("double").alias("distance"), "bm25_score",
        F.lit(None).cast("int").alias("dense_rank"), F.col("rank").alias("sparse_rank"),
    )
    return (
        left.unionByName(right)
        .groupBy("query_id", "id")
        .agg(
            F.sum("part").alias("score"),
            F.max("distance").alias("distance"),
            F.max("bm25_score").alias("bm25_score"),
            F.min("dense_rank").alias("dense_rank"),
            F.min("sparse_rank").alias("sparse_rank"),
        )
    )


def _best(fused: DataFrame, k: int) -> DataFrame:
    ties = [F.asc_nulls_last(column) for column in TIE_ORDER]
    return top_per_query(fused, k, [F.desc("score"), *ties])


def reciprocal_rank_fusion(
    dense: DataFrame,
    sparse: DataFrame,
    rrf_k: float = 60,
    dense_weight: float = 1.0,
    sparse_weight: float = 1.0,
    fetch_top_k: int = DEFAULT_K,
    **_: Any,
) -> DataFrame:
    """Sum of weight / (rank + rrf_k) over the arms that found the document."""
    place = F.col("rank") + F.lit(float(rrf_k))
    fused = _fuse(dense, sparse, F.lit(float(dense_weight)) * (1.0 / place),
                  F.lit(float(sparse_weight)) * (1.0 / place))
    return _best(fused, fetch_top_k)


def _scaled(score: Column, low_is_best: bool) -> Column:
    """Score of one arm scaled to [0, 1] within its query; all equal: 0."""
    arm = Window.partitionBy("query_id")
    low, high = F.min(score).over(arm), F.max(score).over(arm)
    spread = F.when(high == low, F.lit(1.0)).otherwise(high - low)
    scaled = (score - low) / spread
    return F.lit(1.0) - scaled if low_is_best else scaled


def weighted_sum_ranking(
    dense: DataFrame,
    sparse: DataFrame,
    dense_weight: float = 0.5,
    sparse_weight: float = 0.5,
    fetch_top_k: int = DEFAULT_K,
    distance_strategy: DistanceStrategy = DistanceStrategy.COSINE_DISTANCE,
    **_: Any,
) -> DataFrame:
    """Weighted sum of the arms' scores, each scaled by its minimum and maximum."""
    dense_scaled = _scaled(F.col("distance"), not distance_strategy.larger_is_nearer)
    sparse_scaled = _scaled(F.col("bm25_score"), True)
    # A document without a distance adds nothing from the dense arm.
    dense = dense.withColumn("scaled", F.coalesce(dense_scaled, F.lit(0.0)))
    sparse = sparse.withColumn("scaled", sparse_scaled)
    fused = _fuse(dense, sparse, F.col("scaled") * float(dense_weight),
                  F.col("scaled") * float(sparse_weight))
    return _best(fused, fetch_top_k)

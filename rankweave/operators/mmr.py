"""Maximal marginal relevance (Carbonell and Goldstein, 1998)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankweave.operators.dense import knn
from rankweave.operators.filters import Filter
from rankweave.runtime import few_results
from rankweave.spec import (
    DEFAULT_FETCH_K,
    DEFAULT_K,
    DEFAULT_LAMBDA,
    CollectionSpec,
    DistanceStrategy,
)


def _cosines(rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Cosine of every row with the vector; 0 where a length is zero."""
    dots = (rows * vector).sum(axis=1)
    scale = np.sqrt((rows * rows).sum(axis=1)) * np.sqrt((vector * vector).sum())
    return np.divide(dots, scale, out=np.zeros(len(rows)), where=scale > 0)


def select_diverse(query: np.ndarray, docs: np.ndarray, k: int, lambda_mult: float) -> list[int]:
    """Positions of the chosen documents, in the order they are chosen.

    The first is the most similar to the query. Each next one has the largest
    lambda * similarity to the query - (1 - lambda) * similarity to the nearest
    chosen document; of equals the earlier position wins.
    """
    relevance = _cosines(docs, query)
    chosen: list[int] = []
    redundancy = np.full(len(docs), -np.inf)
    gain = relevance.copy()
    while len(chosen) < min(k, len(docs)):
        pick = int(np.argmax(gain))
        chosen.append(pick)
        redundancy = np.maximum(redundancy, _cosines(docs, docs[pick]))
        gain = lambda_mult * relevance - (1.0 - lambda_mult) * redundancy
        gain[chosen] = -np.inf
    return chosen


def mmr(
    docs: DataFrame,
    queries: DataFrame,
    k: int = DEFAULT_K,
    fetch_k: int = DEFAULT_FETCH_K,
    lambda_mult: float = DEFAULT_LAMBDA,
    metric: DistanceStrategy = DistanceStrategy.COSINE_DISTANCE,
    filter: Filter | Column | None = None,
    spec: CollectionSpec = CollectionSpec(),
    candidates: DataFrame | None = None,
) -> DataFrame:
    """k diverse documents out of the fetch_k nearest of every query.

    Result: (query_id, id, distance, rank, mmr_order); ``rank`` is by distance
    and ``mmr_order`` is the order of choice. ``candidates`` may bring nearest
    documents that were found otherwise, for example by an approximate index.
    """
    found = knn(docs, queries, fetch_k, metric, filter, spec) if candidates is None else candidates
    # Only candidates carry a vector into the groups, fetch_k rows a query.
    found = found.select("query_id", "id", "distance", F.col("rank").alias("place"))
    if few_results(queries, fetch_k):
        found = F.broadcast(found)
    vectors = docs.select(F.col(spec.id).alias("id"), F.col(spec.embedding).alias("vector"))
    grouped = vectors.join(found, "id").join(
        queries.select("query_id", "query_embedding"), "query_id"
    )
    schema = T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("id", docs.schema[spec.id].dataType),
            T.StructField("distance", T.DoubleType()),
            T.StructField("rank", T.IntegerType()),
            T.StructField("mmr_order", T.IntegerType()),
        ]
    )

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place", ignore_index=True)
        rows = np.stack(group["vector"].to_numpy()).astype(np.float64)
        query = np.asarray(group["query_embedding"].iloc[0], dtype=np.float64)
        chosen = select_diverse(query, rows, k, lambda_mult)
        out = group.loc[chosen, ["query_id", "id", "distance"]].copy()
        out["mmr_order"] = np.arange(1, len(chosen) + 1, dtype=np.int32)
        out = out.sort_index()
        out["rank"] = np.arange(1, len(chosen) + 1, dtype=np.int32)
        return out[["query_id", "id", "distance", "rank", "mmr_order"]]

    return grouped.groupBy("query_id").applyInPandas(choose, schema)

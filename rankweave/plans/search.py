"""Search over a collection: dense, sparse or hybrid, for a DataFrame of queries."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.functions.metadata import or_empty
from rankweave.operators.dense import knn
from rankweave.operators.filters import Filter
from rankweave.operators.fusion import reciprocal_rank_fusion
from rankweave.operators.ivf import IvfIndex, ivf_search
from rankweave.operators.sparse import Bm25Index, bm25_topk, build_bm25_index
from rankweave.runtime import few_results
from rankweave.spec import DEFAULT_K, CollectionSpec, SearchConfig


@dataclass(frozen=True)
class SearchTarget:
    """A collection with the indexes a search may use.

    Without a BM25 index one is derived from the texts in the same job, which
    reads all of them; without a vector index the dense arm is exact.
    """

    docs: DataFrame
    bm25: Bm25Index | None = None
    vectors: IvfIndex | None = None
    spec: CollectionSpec = CollectionSpec()
    #: The caller's word that every search filters by the condition of a partial
    #: vector index. Without it such an index would lose rows, and is not used.
    filters_imply_index: bool = False

    def usable_vectors(self) -> IvfIndex | None:
        whole = self.vectors is None or self.vectors.params.where is None
        return self.vectors if whole or self.filters_imply_index else None


def _dense(target: SearchTarget, queries: DataFrame, k: int, config: SearchConfig, filter) -> DataFrame:
    vectors = target.usable_vectors()
    if vectors is not None:
        return ivf_search(vectors, queries, k, config.probes, filter, config.iterative_scan)
    return knn(target.docs, queries, k, config.distance_strategy, filter, target.spec)


def _sparse(target: SearchTarget, queries: DataFrame, k: int, filter) -> DataFrame:
    index = target.bm25 or build_bm25_index(target.docs, spec=target.spec)
    return bm25_topk(index, queries, k, target.docs, filter, target.spec)


def candidates(
    target: SearchTarget,
    queries: DataFrame,
    config: SearchConfig,
    filter: Filter | Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Dense and sparse candidate lists, each with its own top k."""
    return (
        _dense(target, queries, config.dense_top_k, config, filter),
        _sparse(target, queries, config.sparse_top_k, filter),
    )


def ranked(
    target: SearchTarget,
    queries: DataFrame,
    config: SearchConfig = SearchConfig(),
    k: int = DEFAULT_K,
    filter: Filter | Column | None = None,
) -> DataFrame:
    """Ranked ids of every query: query_id, id, rank, score, distance,
    bm25_score, dense_rank, sparse_rank.

    With query texts and the sparse arm enabled the arms of the config run;
    one arm alone is cut to k without fusion. With vectors only, the search is
    dense with k rows; so it is for single queries of empty or null text.
    """
    has_text = "query_text" in queries.columns
    if has_text and config.enable_sparse:
        silent = F.coalesce("query_text", F.lit("")) == ""
        if not queries.where(silent).isEmpty():
            asked = ranked(target, queries.where(~silent), config, k, filter)
            unasked = queries.where(silent).drop("query_text")
            dense = ranked(target, unasked, replace(config, enable_dense=True), k, filter)
            return asked.select(dense.columns).unionByName(dense)
    no_rank, no_score = F.lit(None).cast("int"), F.lit(None).cast("double")
    if not (has_text and config.enable_sparse):
        if not config.enable_dense:
            raise ValueError("a search without query texts needs the dense arm")
        dense = _dense(target, queries, k, config, filter)
        return dense.select(
            "query_id", "id", "rank", F.col("distance").alias("score"), "distance",
            no_score.alias("bm25_score"), F.col("rank").alias("dense_rank"),
            no_rank.alias("sparse_rank"),
        )
    if not config.enable_dense:
        sparse = _sparse(target, queries, min(k, config.sparse_top_k), filter)
        return sparse.select(
            "query_id", "id", "rank", F.col("bm25_score").alias("score"),
            no_score.alias("distance"), "bm25_score", no_rank.alias("dense_rank"),
            F.col("rank").alias("sparse_rank"),
        )
    dense, sparse = candidates(target, queries, config, filter)
    fuse = config.fusion_function or reciprocal_rank_fusion
    # Distances are those of the index, if one was searched.
    vectors = target.usable_vectors()
    metric = config.distance_strategy if vectors is None else vectors.params.distance_strategy
    return fuse(
        dense,
        sparse,
        **config.fusion_function_parameters,
        dense_weight=config.dense_weight,
        sparse_weight=config.sparse_weight,
        fetch_top_k=k,
        distance_strategy=metric,
    )


def with_rows(
    results: DataFrame, docs: DataFrame, queries: DataFrame, k: int, spec: CollectionSpec = CollectionSpec()
) -> DataFrame:
    """Add content and metadata to ranked ids.

    The texts of the collection are read once, for the winners of all queries;
    the winners are broadcast when k rows a query are few.
    """
    told = F.col(spec.metadata) if spec.metadata else F.lit(None).cast("string")
    rows = docs.select(
        F.col(spec.id).alias("_key"),
        F.col(spec.content).alias("content"),
        or_empty(told).alias("metadata"),
    )
    winners = results.withColumnRenamed("id", "_key")
    if few_results(queries, k):
        winners = F.broadcast(winners)
    joined = rows.join(winners, "_key")
    rest = [c for c in results.columns if c not in ("query_id", "rank", "id")]
    return joined.select(
        "query_id", "rank", F.col("_key").cast("string").alias("id"), "content", "metadata", *rest
    )


def search(
    target: SearchTarget,
    queries: DataFrame,
    config: SearchConfig = SearchConfig(),
    k: int = DEFAULT_K,
    filter: Filter | Column | None = None,
    with_score: bool = True,
) -> DataFrame:
    """Search and return rows: query_id, rank, id (text), content, metadata,
    then, unless ``with_score`` is off, the score and its components."""
    results = ranked(target, queries, config, k, filter)
    rows = with_rows(results, target.docs, queries, k, target.spec)
    return rows if with_score else rows.select("query_id", "rank", "id", "content", "metadata")

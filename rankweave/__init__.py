"""Hybrid retrieval over DataFrames: dense, BM25 and fused top-k, with filters,
diversification, stored collections and retrieval metrics.
"""

import sys

from pyspark import cloudpickle

from rankweave.functions.embedders import Embedder, batch_embedder, hash_embedder
from rankweave.operators.dense import knn
from rankweave.operators.filters import (
    FilterCondition,
    FilterOperator,
    MetadataFilter,
    MetadataFilters,
    compile_filter,
)
from rankweave.operators.fusion import reciprocal_rank_fusion, weighted_sum_ranking
from rankweave.operators.ivf import build_ivf, ivf_search
from rankweave.operators.mmr import mmr
from rankweave.operators.sparse import bm25_topk, build_bm25_index
from rankweave.plans.search import SearchTarget, search
from rankweave.sources.collection import build_collection, create_collection, open_collection
from rankweave.spec import (
    Bm25Params,
    CollectionSpec,
    DistanceStrategy,
    IterativeScanMode,
    IvfParams,
    SearchConfig,
)

# Functions of this package travel to the executors with the job, so the
# package has to be installed on the driver only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = [
    "Bm25Params",
    "CollectionSpec",
    "DistanceStrategy",
    "Embedder",
    "FilterCondition",
    "FilterOperator",
    "IterativeScanMode",
    "IvfParams",
    "MetadataFilter",
    "MetadataFilters",
    "SearchConfig",
    "SearchTarget",
    "batch_embedder",
    "bm25_topk",
    "build_bm25_index",
    "build_collection",
    "build_ivf",
    "compile_filter",
    "create_collection",
    "hash_embedder",
    "ivf_search",
    "knn",
    "mmr",
    "open_collection",
    "reciprocal_rank_fusion",
    "search",
    "weighted_sum_ranking",
]

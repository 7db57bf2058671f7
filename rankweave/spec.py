"""Options shared by the operators: column names, metrics, search settings."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from enum import Enum
from typing import Any


class DistanceStrategy(Enum):
    """How two vectors are compared.

    Cosine and Euclidean are distances (smaller is nearer); the inner product
    is reported as it is and larger is nearer.
    """

    EUCLIDEAN = "EUCLIDEAN"
    COSINE_DISTANCE = "COSINE_DISTANCE"
    INNER_PRODUCT = "INNER_PRODUCT"

    @property
    def larger_is_nearer(self) -> bool:
        return self is DistanceStrategy.INNER_PRODUCT


class IterativeScanMode(Enum):
    """Whether an approximate search goes on until every query has k rows."""

    OFF = "off"
    RELAXED_ORDER = "relaxed_order"
    STRICT_ORDER = "strict_order"


@dataclass(frozen=True)
class CollectionSpec:
    """Column names of a collection."""

    id: str = "id"
    content: str = "content"
    embedding: str = "embedding"
    metadata: str | None = "metadata"

    def columns(self) -> list[str]:
        named = [self.id, self.content, self.embedding]
        return named + ([self.metadata] if self.metadata else [])


@dataclass(frozen=True)
class Bm25Params:
    """Settings of a BM25 index: analyser name, term saturation, length weight."""

    text_config: str = "korean"
    k1: float = 1.2
    b: float = 0.75


@dataclass(frozen=True)
class IvfParams:
    """Settings of an inverted-list vector index.

    ``where`` is a SQL predicate: only rows that satisfy it are indexed.
    """

    lists: int = 100
    distance_strategy: DistanceStrategy = DistanceStrategy.COSINE_DISTANCE
    where: str | None = None
    seed: int = 42


@dataclass(frozen=True)
class SearchConfig:
    """What one search does.

    Each arm fetches its own number of candidates; the fused list is cut to
    the ``k`` given to the search. ``probes`` and ``iterative_scan`` apply
    only when a vector index is given.
    """

    fusion_function: Callable[..., Any] | None = None
    fusion_function_parameters: Mapping[str, Any] = field(
        default_factory=lambda: {"rrf_k": 60}
    )
    dense_top_k: int = 20
    sparse_top_k: int = 20
    dense_weight: float = 1.0
    sparse_weight: float = 1.0
    enable_dense: bool = True
    enable_sparse: bool = True
    distance_strategy: DistanceStrategy = DistanceStrategy.COSINE_DISTANCE
    probes: int = 1
    iterative_scan: IterativeScanMode = IterativeScanMode.STRICT_ORDER

    def __post_init__(self) -> None:
        if not (self.enable_dense or self.enable_sparse):
            raise ValueError("enable the dense arm, the sparse arm, or both")
        clash = {"dense_weight", "sparse_weight"} & set(self.fusion_function_parameters)
        if clash:
            raise ValueError(
                f"{sorted(clash)} are fields of SearchConfig; "
                "do not put them in fusion_function_parameters"
            )


# Result sizes used when the caller names none (fixed values).
DEFAULT_K = 4
DEFAULT_FETCH_K = 20
DEFAULT_LAMBDA = 0.5

"""Top-k rows of each query: inside a task, and over all tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# First-level groups when the lists of the tasks are merged.
MERGE_GROUPS = 32


def top_per_query(
    df: DataFrame,
    k: int,
    order: list[Column],
    by: list[str] | None = None,
    rank: str = "rank",
) -> DataFrame:
    """Keep the first ``k`` rows of each query and number them from 1.

    Spark limits each task to k rows per query before the shuffle
    (WindowGroupLimit), so the shuffle carries tasks x k rows a query at most.
    """
    if k <= 0:
        return df.withColumn(rank, F.lit(0)).where(F.lit(False))
    window = Window.partitionBy(*(by or ["query_id"])).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


class RunningTopK:
    """The k rows with the smallest (key, id) of each query, seen so far.

    ``bound`` is the key of a query's k-th row: a row above it need not be
    offered. Queries are numbers from 0. ``extra`` is one more number of a row
    that goes with it, NaN where none was offered.
    """

    def __init__(self, queries: int, k: int) -> None:
        self.k = k
        self.bound = np.full(queries, np.inf)
        self.owner = np.empty(0, dtype=np.int64)
        self.key = np.empty(0, dtype=np.float64)
        self.extra = np.empty(0, dtype=np.float64)
        self.ids: np.ndarray | None = None

    def offer(self, owner: np.ndarray, key: np.ndarray, ids: np.ndarray, extra: np.ndarray | None = None) -> None:
        if len(owner) == 0:
            return
        extra = np.full(len(owner), np.nan) if extra is None else extra
        rest = np.zeros(len(self.owner), dtype=bool)
        if self.ids is not None:
            # Lists that get no row stay as they are.
            offered = np.zeros(len(self.bound), dtype=bool)
            offered[owner] = True
            old = offered[self.owner]
            rest = ~old
            owner = np.concatenate([self.owner[old], owner])
            key = np.concatenate([self.key[old], key])
            ids = np.concatenate([self.ids[old], ids])
            extra = np.concatenate([self.extra[old], extra])
        _, id_order = np.unique(ids, return_inverse=True)
        order = np.lexsort((id_order, key, owner))
        owner, key, ids, extra = owner[order], key[order], ids[order], extra[order]
        place = np.arange(len(owner)) - np.searchsorted(owner, owner, side="left")
        keep = place < self.k
        full = place == self.k - 1
        self.bound[owner[full]] = key[full]
        owner, key, ids, extra = owner[keep], key[keep], ids[keep], extra[keep]
        if rest.any():
            owner = np.concatenate([self.owner[rest], owner])
            key = np.concatenate([self.key[rest], key])
            ids = np.concatenate([self.ids[rest], ids])
            extra = np.concatenate([self.extra[rest], extra])
        self.owner, self.key, self.ids, self.extra = owner, key, ids, extra

    def batch(self, query_ids: pa.Array, id_type: pa.DataType, values: np.ndarray, group: int) -> pa.RecordBatch:
        """The kept rows as (query_id, id, value, merge_group); NaN becomes NULL."""
        kept = [] if self.ids is None else self.ids.tolist()
        return pa.RecordBatch.from_arrays(
            [
                query_ids.take(pa.array(self.owner)),
                pa.array(kept, type=id_type),
                pa.array(values, mask=np.isnan(values)),
                pa.array(np.full(len(self.owner), group % MERGE_GROUPS, dtype=np.int32)),
            ],
            names=["query_id", "id", "value", "merge_group"],
        )


def task_group() -> int:
    context = TaskContext.get()
    return context.partitionId() if context else 0


def list_schema(query_type: T.DataType, id_type: T.DataType, value: str) -> T.StructType:
    """Schema of the lists that tasks return."""
    return T.StructType(
        [
            T.StructField("query_id", query_type),
            T.StructField("id", id_type),
            T.StructField(value, T.DoubleType()),
            T.StructField("merge_group", T.IntegerType()),
        ]
    )


def merge_lists(lists: DataFrame, k: int, value: Column) -> DataFrame:
    """One ranked list a query out of the lists of all tasks, in two levels.

    The first level is keyed by query and task group, so that a search with
    few queries over very many tasks does not end in a few large sorts. Lists
    without the column merge_group are few a query and are merged at once.
    """
    order = [value, F.asc("id")]
    if "merge_group" not in lists.columns:
        return top_per_query(lists, k, order)
    first = top_per_query(lists, k, order, by=["query_id", "merge_group"])
    return top_per_query(first.drop("merge_group", "rank"), k, order)

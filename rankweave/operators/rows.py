"""Changes of a collection as DataFrame operations: upsert, delete, lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankweave.operators.filters import Filter, compile_filter
from rankweave.runtime import broadcast_if_small
from rankweave.spec import CollectionSpec


def with_defaults(incoming: DataFrame, spec: CollectionSpec = CollectionSpec()) -> DataFrame:
    """Fill missing ids with random ones and missing metadata with ``{}``.

    A random id differs each time it is evaluated: write the result before
    using it twice.
    """
    given = F.col(spec.id) if spec.id in incoming.columns else F.lit(None)
    out = incoming.withColumn(spec.id, F.coalesce(given, F.uuid()))
    if spec.metadata:
        told = F.col(spec.metadata) if spec.metadata in incoming.columns else F.lit(None).cast("string")
        out = out.withColumn(spec.metadata, F.coalesce(told, F.lit("{}")))
    return out


def latest_rows(incoming: DataFrame, order: str, spec: CollectionSpec = CollectionSpec()) -> DataFrame:
    """The row with the highest ``order`` for each id."""
    newest = Window.partitionBy(spec.id).orderBy(F.desc(order))
    return incoming.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n", order)


def merge_rows(
    base: DataFrame, incoming: DataFrame, order: str, spec: CollectionSpec = CollectionSpec()
) -> DataFrame:
    """Insert or replace whole rows by id; of repeated ids the last one counts."""
    columns = spec.columns()
    newest = latest_rows(incoming.select(*columns, order), order, spec)
    keys = broadcast_if_small(incoming.select(spec.id).distinct(), F.octet_length(F.col(spec.id).cast("string")))
    return base.select(columns).join(keys, spec.id, "left_anti").select(columns).unionByName(newest)


def delete_rows(
    base: DataFrame,
    ids: DataFrame | None = None,
    filter: Filter | None = None,
    spec: CollectionSpec = CollectionSpec(),
) -> DataFrame:
    """Rows that stay when those with a given id AND matching the filter go.

    Without ids and without a predicate nothing goes. A predicate that is NULL
    for a row does not delete it.
    """
    predicate = compile_filter(filter, spec.metadata)
    if ids is None:
        return base if predicate is None else base.where(~F.coalesce(predicate, F.lit(False)))
    keys = broadcast_if_small(ids.select(spec.id).distinct(), F.octet_length(F.col(spec.id).cast("string")))
    if predicate is None:
        return base.join(keys, spec.id, "left_anti").select(base.columns)
    marked = base.join(keys.withColumn("_named", F.lit(True)), spec.id, "left")
    doomed = F.coalesce(F.col("_named") & predicate, F.lit(False))
    return marked.where(~doomed).select(base.columns)


def rows_by_id(base: DataFrame, ids: DataFrame, spec: CollectionSpec = CollectionSpec()) -> DataFrame:
    """Rows with the given ids; ids that do not exist are absent."""
    keys = broadcast_if_small(ids.select(spec.id).distinct(), F.octet_length(F.col(spec.id).cast("string")))
    return base.join(keys, spec.id, "left_semi").select(base.columns)


def present_rows(base: DataFrame, spec: CollectionSpec = CollectionSpec()) -> DataFrame:
    """Result form of stored rows: id as text, content, metadata (``{}`` for NULL)."""
    told: Column = F.col(spec.metadata) if spec.metadata else F.lit(None).cast("string")
    return base.select(
        F.col(spec.id).cast("string").alias("id"),
        F.col(spec.content).alias("content"),
        F.coalesce(told, F.lit("{}")).alias("metadata"),
    )

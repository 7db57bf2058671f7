"""Saved indexes: BM25 tables and inverted vector lists as Parquet."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.functions.text import Analyzer, analyzer
from rankweave.operators.ivf import IvfIndex
from rankweave.operators.sparse import (
    Bm25Index,
    document_frequencies,
    term_bucket,
    term_counts,
)
from rankweave.runtime import remove_path
from rankweave.spec import Bm25Params, CollectionSpec, DistanceStrategy, IvfParams

_POSTINGS = "term string, id {}, tf int, dl int, term_bucket int"
_TERMS = "term string, df long, term_bucket int"
_STATS = (
    "n_docs long, avg_dl double, text_config string, k1 double, b double, buckets int, id_type string"
)


def _write_by(rows: DataFrame, column: str, sort: list[str], path: str) -> None:
    """Write partitioned by a column; rebalancing splits a value that is too large."""
    balanced = rows.hint("rebalance", column).sortWithinPartitions(column, *sort)
    balanced.write.mode("overwrite").partitionBy(column).parquet(path)


def save_bm25_index(
    docs: DataFrame,
    path: str,
    params: Bm25Params = Bm25Params(),
    spec: CollectionSpec = CollectionSpec(),
    buckets: int = 64,
    where: str | None = None,
) -> Bm25Index:
    """Build a BM25 index over a collection and save it.

    The texts are read once, for the postings; document frequencies and
    lengths are taken from the postings just written.
    """
    spark = docs.sparkSession
    docs = docs.where(F.expr(where)) if where else docs
    analyze = analyzer(params.text_config)
    postings = term_counts(docs, spec, analyze)
    bucketed = postings.withColumn("term_bucket", term_bucket(F.col("term"), buckets))
    _write_by(bucketed, "term_bucket", ["term"], f"{path}/postings")
    _finish_bm25(spark, path, docs.count(), params, buckets, docs.schema[spec.id].dataType.simpleString())
    return load_bm25_index(spark, path, analyze)


def save_bm25_tables(index: Bm25Index, spark: SparkSession, path: str, buckets: int = 64) -> Bm25Index:
    """Save an index that exists as DataFrames, such as a refreshed one."""
    bucketed = index.postings.select("term", "id", "tf", "dl").withColumn(
        "term_bucket", term_bucket(F.col("term"), buckets)
    )
    _write_by(bucketed, "term_bucket", ["term"], f"{path}/postings")
    n_docs = index.stats.select("n_docs").first()[0]
    _finish_bm25(spark, path, n_docs, index.params, buckets, index.postings.schema["id"].dataType.simpleString())
    return load_bm25_index(spark, path, index.analyze)


def _finish_bm25(
    spark: SparkSession, path: str, n_docs: int, params: Bm25Params, buckets: int, id_type: str
) -> None:
    written = spark.read.schema(_POSTINGS.format(id_type)).parquet(f"{path}/postings")
    terms = document_frequencies(written).withColumn("term_bucket", term_bucket(F.col("term"), buckets))
    _write_by(terms, "term_bucket", ["term"], f"{path}/terms")
    tokens = written.agg(F.coalesce(F.sum("tf"), F.lit(0))).first()[0]
    name = params.text_config if isinstance(params.text_config, str) else None
    row = (n_docs, tokens / n_docs if n_docs else 0.0, name, params.k1, params.b, buckets, id_type)
    spark.createDataFrame([row], _STATS).coalesce(1).write.mode("overwrite").parquet(f"{path}/stats")


def load_bm25_index(spark: SparkSession, path: str, analyze: Analyzer | None = None) -> Bm25Index:
    """Open a saved index; pass the analyser if it is a function of one's own."""
    # The schemas are known: nothing is read to find them out.
    stats = spark.read.schema(_STATS).parquet(f"{path}/stats")
    s = stats.first()
    return Bm25Index(
        spark.read.schema(_POSTINGS.format(s["id_type"])).parquet(f"{path}/postings"),
        spark.read.schema(_TERMS).parquet(f"{path}/terms"),
        stats,
        Bm25Params(s["text_config"], s["k1"], s["b"]),
        analyze or analyzer(s["text_config"]),
        s["buckets"],
    )


def save_ivf_index(index: IvfIndex, path: str) -> IvfIndex:
    """Save the centres and the documents, partitioned by list."""
    spark = index.docs.sparkSession
    _write_by(index.docs, "list_id", [index.spec.id], f"{path}/lists")
    centers = [(i, c.tolist()) for i, c in enumerate(index.centers)]
    rows = spark.createDataFrame(centers, "list_id int, center array<double>")
    rows.write.mode("overwrite").parquet(f"{path}/centers")
    options = (index.params.lists, index.params.distance_strategy.value, index.params.where, index.params.seed)
    schema = "lists int, distance_strategy string, where string, seed int"
    spark.createDataFrame([options], schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/options")
    return load_ivf_index(spark, path, index.spec)


def load_ivf_index(spark: SparkSession, path: str, spec: CollectionSpec = CollectionSpec()) -> IvfIndex:
    o = spark.read.parquet(f"{path}/options").first()
    params = IvfParams(o["lists"], DistanceStrategy(o["distance_strategy"]), o["where"], o["seed"])
    rows = spark.read.parquet(f"{path}/centers").orderBy("list_id").collect()
    centers = np.array([r["center"] for r in rows])
    return IvfIndex(centers, spark.read.parquet(f"{path}/lists"), params, spec)


def drop_index(spark: SparkSession, path: str) -> None:
    """Delete a saved index; a search without it is exact."""
    remove_path(spark, path)

"""Hook for an embedding model that the user brings."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.functions.vectors import hash_embedding

TextsToVectors = Callable[[pd.Series], pd.Series]
Embed = Callable[[Column], Column]


@dataclass(frozen=True)
class Embedder:
    """How documents and how queries become vectors (text column to vector column)."""

    documents: Embed
    queries: Embed


def batch_embedder(documents: TextsToVectors, queries: TextsToVectors | None = None) -> Embedder:
    """Embedder of functions from a batch of texts to a batch of vectors.

    They run as Arrow UDFs, a batch at a time. ``spark.sql.execution.arrow.
    maxRecordsPerBatch`` sets the batch, the number of partitions how many
    batches are in work at once.
    """

    def as_column(fn: TextsToVectors) -> Embed:
        def embed(texts: pd.Series) -> pd.Series:
            return fn(texts)

        return F.pandas_udf(embed, "array<float>")

    return Embedder(as_column(documents), as_column(queries or documents))


def hash_embedder(dim: int) -> Embedder:
    """Deterministic stand-in without a model."""
    return Embedder(lambda text: hash_embedding(text, dim), lambda text: hash_embedding(text, dim))


def embed_documents(
    docs: DataFrame, embedder: Embedder, content: str = "content", embedding: str = "embedding",
    partitions: int | None = None,
) -> DataFrame:
    """Add vectors to documents; ``partitions`` bounds the batches in work at once."""
    spread = docs if partitions is None else docs.repartition(partitions)
    return spread.withColumn(embedding, embedder.documents(F.col(content)))


def embed_queries(queries: DataFrame, embedder: Embedder, prefix: str = "") -> DataFrame:
    """Add ``query_embedding``; the prefix goes into the embedding only."""
    text = F.col("query_text") if not prefix else F.concat(F.lit(prefix), F.col("query_text"))
    return queries.withColumn("query_embedding", embedder.queries(text))

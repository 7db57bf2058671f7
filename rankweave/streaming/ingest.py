"""Bulk load of a growing corpus folder, batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rankweave.functions.embedders import Embedder
from rankweave.sources.collection import Collection
from rankweave.sources.corpora import corpus_to_documents


def stream_corpus(
    spark: SparkSession,
    path: str,
    titled: bool = True,
    files_per_batch: int = 64,
    max_chars: int | None = None,
) -> DataFrame:
    """JSON-lines shards of a folder as a stream of documents (id, content, metadata)."""
    title = "title string, " if titled else ""
    schema = f"docid string, {title}text string"
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)
    return corpus_to_documents(rows, titled, max_chars)


def load_stream(
    documents: DataFrame, collection: Collection, embedder: Embedder, checkpoint: str, order: str | None = None
) -> StreamingQuery:
    """Embed and upsert every batch of the stream, until the folder is read.

    Documents need ids: a batch that is repeated after a failure then replaces
    its own rows and adds none. ``order`` names the column by which the last of
    rows with one id is known.
    """

    def upsert(batch: DataFrame, _: int) -> None:
        collection.add_texts(batch, embedder, order)

    return (
        documents.writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

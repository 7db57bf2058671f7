"""Readers of corpora, queries and relevance judgments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankweave.functions.metadata import encode
from rankweave.functions.text import build_content


def read_corpus_jsonl(spark: SparkSession, path: str, titled: bool = True) -> DataFrame:
    """JSON-lines corpus: (docid, [title], text). A glob reads all its shards."""
    title = "title string, " if titled else ""
    return spark.read.schema(f"docid string, {title}text string").json(path)


def read_corpus_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Columnar corpus (_id, title, text) as (docid, title, text)."""
    return spark.read.parquet(path).select(F.col("_id").alias("docid"), "title", "text")


def read_queries_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines queries (query_id, query), gzipped or not."""
    rows = spark.read.schema("query_id string, query string").json(path)
    return rows.select("query_id", F.col("query").alias("query_text"))


def read_queries_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Columnar queries (_id, text)."""
    rows = spark.read.parquet(path)
    return rows.select(F.col("_id").alias("query_id"), F.col("text").alias("query_text"))


def _tsv(spark: SparkSession, path: str, fields: int) -> DataFrame:
    """Lines with at least so many tab-separated fields. Quotes are data.

    ``place`` orders the lines of one file set: by file, then by position.
    """
    lines = spark.read.text(path).select(
        F.split(F.btrim("value", F.lit(" \t\r\n")), "\t").alias("f"),
        F.struct(
            F.col("_metadata.file_path"),
            F.col("_metadata.file_block_start"),
            F.monotonically_increasing_id(),
        ).alias("place"),
    )
    return lines.where(F.size("f") >= fields)


def read_topics_tsv(spark: SparkSession, path: str) -> DataFrame:
    """TSV queries (qid, query); the last line of a repeated qid counts."""
    lines = _tsv(spark, path, 2).select(
        F.col("f")[0].alias("query_id"), F.col("f")[1].alias("query_text"), "place"
    )
    last = Window.partitionBy("query_id").orderBy(F.desc("place"))
    numbered = lines.withColumn("n", F.row_number().over(last))
    return numbered.where("n = 1").select("query_id", "query_text")


def read_qrels_tsv(spark: SparkSession, path: str, graded: bool = False) -> DataFrame:
    """TSV judgments (qid, iteration, docid, rel), relevant pairs without repeats.

    Relevant is ``rel = 1``, or ``rel >= 1`` when the file is graded.
    """
    lines = _tsv(spark, path, 4)
    rel = F.trim(F.col("f")[3]).cast("int")
    relevant = lines.where(rel >= 1 if graded else rel == 1)
    return relevant.select(F.col("f")[0].alias("query_id"), F.col("f")[2].alias("doc_id")).distinct()


def read_qrels_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Columnar judgments (query-id, corpus-id), without repeats."""
    rows = spark.read.parquet(path)
    pairs = rows.select(F.col("`query-id`").alias("query_id"), F.col("`corpus-id`").alias("doc_id"))
    return pairs.distinct()


def corpus_to_documents(
    corpus: DataFrame,
    titled: bool = True,
    max_chars: int | None = None,
    metadata: list[Column | str] | None = None,
) -> DataFrame:
    """Corpus rows as documents (id, content, metadata); the id is also metadata."""
    title = F.col("title") if titled else None
    told = metadata if metadata is not None else ["docid", *(["title"] if titled else [])]
    return corpus.select(
        F.col("docid").alias("id"),
        build_content(F.col("text"), title, max_chars).alias("content"),
        encode(*told).alias("metadata"),
    )

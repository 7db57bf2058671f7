"""Block-max postings: top-k BM25 that skips blocks which cannot reach the k-th score.

The postings of each term are cut into blocks by the size of their score part
(``tf`` and ``dl`` against the average length, without idf): block ``level``
holds the parts in the ``level``-th of ``LEVELS`` equal bands of the possible
range, so block maxima fall from the top level down. Stored per block: the
largest part and the number of postings.

A search first reads, for each query term, its top blocks until they hold k
postings; a document's score is at least its largest single-term share, so the
k-th largest such share over distinct documents is a lower bound ``theta`` of
each query's k-th score. A block of term t can hold a document of score at
least theta only if its bound ``qtf idf max_part + sum of the other terms'
largest shares`` reaches theta; all other blocks are skipped. Every document
that can enter the top k keeps all its postings (each lies in a block whose
bound is at least its score), so the ranking over the blocks left is exact; it
is done by the plain BM25 top-k over those postings, with the statistics of the
whole index.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankweave.operators.sparse import (
    DEFAULT_K,
    Bm25Index,
    bm25_topk,
    inverse_document_frequency,
    query_terms,
    term_bucket,
    term_score,
)
from rankweave.runtime import broadcast_if_small, scratch_path

LEVELS = 64
# Scores are summed in steps of 1e-9; a bound is taken this much lower.
SLACK = 1e-6


@dataclass(frozen=True)
class BlockMaxIndex:
    """An index with its postings in blocks: (term, level, id, tf, dl, part) and (term, level, top, rows)."""

    index: Bm25Index
    postings: DataFrame
    blocks: DataFrame


def block_max_index(index: Bm25Index, path: str | None = None, levels: int = LEVELS) -> BlockMaxIndex:
    """Cut the postings of an index into blocks by their score part and write them.

    Postings are written partitioned by term bucket and sorted by term and
    level, so that a read of some terms and blocks touches few row groups.
    A bucket is cut over as many tasks as its size asks for.
    """
    spark = index.postings.sparkSession
    path = path or scratch_path(spark, "bm25-blockmax")
    stats = index.stats.first()
    k1, b = index.params.k1, index.params.b
    avg_dl = stats.avg_dl or 0.0
    part = term_score(F.col("tf"), F.col("dl"), F.lit(avg_dl), k1, b) if avg_dl else F.lit(0.0)
    level = F.least(F.lit(levels - 1), F.floor(part / (k1 + 1.0) * levels)).cast("int")
    postings = index.postings.withColumn("part", part.cast("double")).withColumn("level", level)
    if "term_bucket" not in postings.columns:
        postings = postings.withColumn("term_bucket", F.lit(0))
    postings = postings.select("term", "level", "id", "tf", "dl", "part", "term_bucket")
    balanced = postings.hint("rebalance", "term_bucket").sortWithinPartitions("term_bucket", "term", F.desc("level"))
    balanced.write.partitionBy("term_bucket").parquet(f"{path}/postings")
    written = spark.read.parquet(f"{path}/postings")
    blocks = written.groupBy("term", "level").agg(F.max("part").alias("top"), F.count("*").alias("rows"))
    blocks.write.parquet(f"{path}/blocks")
    return BlockMaxIndex(index, written, spark.read.parquet(f"{path}/blocks"))


def kept_blocks(bmi: BlockMaxIndex, queries: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    """(term, level) of the blocks that some query cannot skip."""
    index = bmi.index
    n_docs = index.stats.select("n_docs").first()[0]
    wanted = query_terms(queries.select("query_id", "query_text"), index.analyze)
    idf = index.terms.select("term", inverse_document_frequency(F.lit(n_docs), F.col("df")).alias("idf"))
    asked = wanted.join(idf, "term")
    bounds = asked.join(bmi.blocks, "term").withColumn("share", F.col("qtf") * F.col("idf") * F.col("top"))

    # Top blocks of each asked term until they hold k postings.
    ahead = Window.partitionBy("term").orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, -1)
    before = bmi.blocks.withColumn("before", F.coalesce(F.sum("rows").over(ahead), F.lit(0)))
    top = before.where(F.col("before") < k).select("term", "level")
    top = top.join(asked.select("term").distinct(), "term", "left_semi")
    seeds = bmi.postings.join(broadcast_if_small(top), ["term", "level"], "left_semi")
    least = seeds.join(asked, "term").groupBy("query_id", "id").agg(F.max(F.col("qtf") * F.col("idf") * F.col("part")).alias("lb"))
    rank = Window.partitionBy("query_id").orderBy(F.desc("lb"), "id")
    theta = least.withColumn("r", F.row_number().over(rank)).where(F.col("r") == k).select("query_id", F.col("lb").alias("theta"))

    # Each term's largest share, and the sum of them per query.
    largest = bounds.groupBy("query_id", "term").agg(F.max("share").alias("largest"))
    total = largest.groupBy("query_id").agg(F.sum("largest").alias("total"))
    judged = bounds.join(largest, ["query_id", "term"]).join(total, "query_id").join(theta, "query_id", "left")
    bound = F.col("share") + F.col("total") - F.col("largest")
    keep = F.col("theta").isNull() | (bound >= F.col("theta") - SLACK)
    return judged.where(keep).select("term", "level").distinct()


def block_max_topk(bmi: BlockMaxIndex, queries: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    """The k best documents of every query, as ``bm25_topk`` ranks them, from the blocks kept."""
    postings = read_postings(bmi, queries, k)
    index = bmi.index
    # Frequencies must come from the whole index, not from the blocks read: the bucketed path takes them from it.
    buckets = index.buckets or 1
    terms = index.terms if index.buckets else index.terms.withColumn("term_bucket", term_bucket(F.col("term"), 1))
    reduced = Bm25Index(postings, terms, index.stats, index.params, index.analyze, buckets)
    return bm25_topk(reduced, queries, k)


def read_postings(bmi: BlockMaxIndex, queries: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    """The postings of the blocks kept, in the layout of the index's postings."""
    kept = kept_blocks(bmi, queries, k)
    rows = bmi.postings.join(broadcast_if_small(kept), ["term", "level"], "left_semi")
    return rows.select("term", "id", "tf", "dl", "term_bucket")

"""Registered queries: a BM25 index in append-only segments, refreshed and merged."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.sparse import K, _rounded
from checks.tables import SQL_COLLECTION, collection, sql_bm25, sql_sparse, text_queries
from rankweave.operators.sparse import bm25_topk
from rankweave.runtime import scratch_path
from rankweave.sources.segments import create_segmented_bm25, load_segmented_bm25, merge_segments, refresh_segmented_bm25
from rankweave.spec import Bm25Params


def _refreshed(spark, sf, merge):
    """Base of all documents; French ones deleted in one delta, German ones replaced in a second."""
    docs = collection(spark, sf)
    language = F.get_json_object("metadata", "$.lang")
    french, german = docs.where(language == "fr"), docs.where(language == "de")
    changed = german.withColumn("content", F.concat(F.lit("replaced "), F.col("content")))
    path = scratch_path(spark, "bm25-segments")
    create_segmented_bm25(docs, path, Bm25Params("simple"), buckets=16)
    refresh_segmented_bm25(path, french.select("id"), docs.limit(0), merge=False)
    index = refresh_segmented_bm25(path, german.limit(0).select("id"), changed, merge=False)
    if merge:
        merge_segments(spark, path)
        index = load_segmented_bm25(spark, path)
    return index


def segments_topk(spark, sf):
    """Search over three segments: the base and two deltas."""
    return _rounded(bm25_topk(_refreshed(spark, sf, False), text_queries(spark, sf), K))


def segments_merged_topk(spark, sf):
    """The same after the merge policy has folded the deltas in."""
    return _rounded(bm25_topk(_refreshed(spark, sf, True), text_queries(spark, sf), K))


def segments_stats(spark, sf):
    stats = _refreshed(spark, sf, False).stats
    return stats.select("n_docs", F.round("avg_dl", 6).alias("avg_dl"))


def segments_terms(spark, sf):
    return _refreshed(spark, sf, False).terms.select("term", "df")


QUERIES = {
    "bm25_segments_topk": segments_topk,
    "bm25_segments_merged_topk": segments_merged_topk,
    "bm25_segments_stats": segments_stats,
    "bm25_segments_terms": segments_terms,
}

_CHANGED = """changed AS (SELECT id, CASE WHEN lang = 'de' THEN 'replaced ' || content ELSE content END AS content
                FROM coll WHERE lang <> 'fr')"""

ORACLE = {
    "bm25_segments_topk": f"""WITH {SQL_COLLECTION}, {_CHANGED},
    {sql_bm25(source='changed')}, {sql_sparse('sparse', K)}
    SELECT query_id, id, rank, round(bm25_score, 6) AS bm25_score FROM sparse""",
    "bm25_segments_stats": f"""WITH {SQL_COLLECTION}, {_CHANGED}, {sql_bm25(source='changed')}
    SELECT n_docs::BIGINT AS n_docs, round(avg_dl, 6) AS avg_dl FROM stats""",
    "bm25_segments_terms": f"""WITH {SQL_COLLECTION}, {_CHANGED}, {sql_bm25(source='changed')}
    SELECT term, df FROM dfs""",
}
ORACLE["bm25_segments_merged_topk"] = ORACLE["bm25_segments_topk"]

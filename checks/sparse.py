"""Registered queries: BM25."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.tables import (
    SQL_COLLECTION,
    bm25_index,
    collection,
    sql_bm25,
    sql_sparse,
    text_queries,
)
from rankweave.operators import sparse
from rankweave.operators.filters import MetadataFilter
from rankweave.operators.rows import delete_rows, merge_rows
from rankweave.operators.sparse import bm25_topk, build_bm25_index, refresh_bm25_index
from rankweave.runtime import scratch_path
from rankweave.sources.indexes import save_bm25_index
from rankweave.spec import Bm25Params

K = 10


def _rounded(found):
    return found.select("query_id", "id", "rank", F.round("bm25_score", 6).alias("bm25_score"))


def _sql_topk(config: str = "simple", where: str = "TRUE", k1: float = 1.2, b: float = 0.75) -> str:
    return f"""WITH {SQL_COLLECTION}, {sql_bm25(config, k1, b)}, {sql_sparse('sparse', K, where)}
    SELECT query_id, id, rank, round(bm25_score, 6) AS bm25_score FROM sparse"""


def bm25_postings(spark, sf):
    return bm25_index(spark, sf).postings.select("term", "id", F.col("tf").cast("bigint"), F.col("dl").cast("bigint"))


def bm25_terms(spark, sf):
    return bm25_index(spark, sf).terms.select("term", "df")


def bm25_stats(spark, sf):
    stats = build_bm25_index(collection(spark, sf), Bm25Params("simple")).stats
    return stats.select("n_docs", F.round("avg_dl", 6).alias("avg_dl"))


def bm25_query(spark, sf):
    return _rounded(bm25_topk(bm25_index(spark, sf), text_queries(spark, sf), K))


def bm25_english(spark, sf):
    return _rounded(bm25_topk(bm25_index(spark, sf, "english"), text_queries(spark, sf), K))


def bm25_filtered(spark, sf):
    docs = collection(spark, sf)
    english = MetadataFilter("lang", "en")
    return _rounded(bm25_topk(bm25_index(spark, sf), text_queries(spark, sf), K, docs, english))


def bm25_unsaved(spark, sf):
    """Index as lazy tables, in the same job as the search, with its own k1 and b."""
    index = build_bm25_index(collection(spark, sf), Bm25Params("simple", k1=0.9, b=0.4))
    return _rounded(bm25_topk(index, text_queries(spark, sf), K))


def bm25_refreshed(spark, sf):
    """Postings refreshed after French documents went and German ones were replaced."""
    docs = collection(spark, sf)
    language = F.get_json_object("metadata", "$.lang")
    french, german = docs.where(language == "fr"), docs.where(language == "de")
    changed = german.withColumn("content", F.concat(F.lit("replaced "), F.col("content")))
    left = delete_rows(docs, french.select("id"))
    now = merge_rows(left, changed.withColumn("n", F.lit(1)), "n")
    index = refresh_bm25_index(bm25_index(spark, sf), french.unionByName(german), changed, now)
    return _rounded(bm25_topk(index, text_queries(spark, sf), K))


def bm25_korean(spark, sf):
    return _rounded(bm25_topk(bm25_index(spark, sf, "korean"), text_queries(spark, sf), K))


def bm25_korean_terms(spark, sf):
    """Terms of texts with a Korean line in front, the document number in it, by the default analyser."""
    docs = collection(spark, sf).withColumn("content", F.concat(F.lit(KOREAN_LINE), "id", F.lit("호 "), "content"))
    return build_bm25_index(docs, Bm25Params("public.korean")).terms.select("term", "df")


def bm25_blocks(spark, sf):
    """The query set in blocks, as if it were over the broadcast bounds."""
    whole = sparse.MAX_BROADCAST_ROWS
    sparse.MAX_BROADCAST_ROWS = 300
    try:
        return _rounded(bm25_topk(bm25_index(spark, sf), text_queries(spark, sf), K))
    finally:
        sparse.MAX_BROADCAST_ROWS = whole


def bm25_null_content(spark, sf):
    """Statistics where the French documents have no content."""
    french = F.get_json_object("metadata", "$.lang") == "fr"
    docs = collection(spark, sf).withColumn("content", F.when(french, F.lit(None)).otherwise(F.col("content")))
    path = scratch_path(spark, "bm25-null")
    saved = save_bm25_index(docs, path, Bm25Params("simple"), buckets=4).stats
    made = build_bm25_index(docs, Bm25Params("simple")).stats
    rows = [s.select(F.lit(n).alias("kind"), "n_docs", F.round("avg_dl", 6).alias("avg_dl")) for n, s in (("saved", saved), ("made", made))]
    return rows[0].unionByName(rows[1])


# Fixed value of two registered queries: a line of text in Hangul.
KOREAN_LINE = "문서번호 "

QUERIES = {
    "bm25_postings": bm25_postings,
    "bm25_terms": bm25_terms,
    "bm25_stats": bm25_stats,
    "bm25_topk": bm25_query,
    "bm25_english_topk": bm25_english,
    "bm25_filtered_topk": bm25_filtered,
    "bm25_unsaved_topk": bm25_unsaved,
    "bm25_refreshed_topk": bm25_refreshed,
    "bm25_korean_topk": bm25_korean,
    "bm25_korean_terms": bm25_korean_terms,
    "bm25_null_content_stats": bm25_null_content,
    "bm25_blocks_topk": bm25_blocks,
}

ORACLE = {
    "bm25_postings": f"WITH {SQL_COLLECTION}, {sql_bm25()} SELECT term, id, tf, dl FROM postings",
    "bm25_terms": f"WITH {SQL_COLLECTION}, {sql_bm25()} SELECT term, df FROM dfs",
    "bm25_stats": f"WITH {SQL_COLLECTION}, {sql_bm25()} SELECT n_docs::BIGINT AS n_docs, round(avg_dl, 6) AS avg_dl FROM stats",
    "bm25_topk": _sql_topk(),
    "bm25_english_topk": _sql_topk("english"),
    "bm25_filtered_topk": _sql_topk(where="lang = 'en'"),
    "bm25_unsaved_topk": _sql_topk(k1=0.9, b=0.4),
    "bm25_korean_topk": _sql_topk("korean"),
    "bm25_blocks_topk": _sql_topk(),
    "bm25_korean_terms": f"""WITH {SQL_COLLECTION},
    lined AS (SELECT id, '{KOREAN_LINE}' || id || '호 ' || content AS content FROM coll),
    {sql_bm25('korean', source='lined')} SELECT term, df FROM dfs""",
    "bm25_null_content_stats": r"""WITH sizes AS (
      SELECT CASE WHEN lang = 'fr' THEN 0
             ELSE len(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '')) END AS dl
      FROM documents)
    SELECT kind, count(*) AS n_docs, round(sum(dl) / count(*), 6) + 0e0 AS avg_dl
    FROM sizes, (VALUES ('saved'), ('made')) k(kind) GROUP BY kind""",
    "bm25_refreshed_topk": f"""WITH {SQL_COLLECTION},
    changed AS (SELECT id, CASE WHEN lang = 'de' THEN 'replaced ' || content ELSE content END AS content
                FROM coll WHERE lang <> 'fr'),
    {sql_bm25(source='changed')}, {sql_sparse('sparse', K)}
    SELECT query_id, id, rank, round(bm25_score, 6) AS bm25_score FROM sparse""",
}

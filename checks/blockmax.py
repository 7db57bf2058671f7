"""Registered queries: BM25 top-k over block-max postings, skipping blocks below the bound."""

from __future__ import annotations

from checks.sparse import K, _rounded, _sql_topk
from checks.tables import SQL_COLLECTION, bm25_index, sql_bm25, sql_sparse, text_queries
from rankweave.operators.blockmax import block_max_index, block_max_topk


def blockmax_topk(spark, sf):
    return _rounded(block_max_topk(block_max_index(bm25_index(spark, sf)), text_queries(spark, sf), K))


def blockmax_top1(spark, sf):
    """k = 1: the tightest bound, the most blocks skipped."""
    return _rounded(block_max_topk(block_max_index(bm25_index(spark, sf)), text_queries(spark, sf), 1))


QUERIES = {"bm25_blockmax_topk": blockmax_topk, "bm25_blockmax_top1": blockmax_top1}
ORACLE = {
    "bm25_blockmax_topk": _sql_topk(),
    "bm25_blockmax_top1": f"""WITH {SQL_COLLECTION}, {sql_bm25()}, {sql_sparse('sparse', 1)}
    SELECT query_id, id, rank, round(bm25_score, 6) AS bm25_score FROM sparse""",
}

"""Block-max postings: the same ranking as plain BM25 from fewer postings."""

import pytest
from pyspark.sql import functions as F

from checks.tables import collection, text_queries
from rankweave.operators.blockmax import block_max_index, block_max_topk, read_postings
from rankweave.operators.sparse import build_bm25_index, bm25_topk, query_terms
from rankweave.spec import Bm25Params

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def built(spark):
    index = build_bm25_index(collection(spark, SF), Bm25Params("simple"))
    # Two-word queries: with long ones the bound of the other terms keeps nearly every block.
    short = F.array_join(F.slice(F.split("query_text", " "), 1, 2), " ")
    queries = text_queries(spark, SF).where("query_id < 5").withColumn("query_text", short)
    return index, block_max_index(index), queries


def _ranked(df):
    return sorted((r.query_id, r.rank, r.id, round(r.bm25_score, 6)) for r in df.collect())


@pytest.mark.parametrize("k", [1, 10])
def test_same_ranking_fewer_postings(built, k):
    index, bmi, queries = built
    assert _ranked(block_max_topk(bmi, queries, k)) == _ranked(bm25_topk(index, queries, k))
    asked = query_terms(queries, index.analyze).select("term").distinct()
    every = index.postings.join(asked, "term", "left_semi").count()
    read = read_postings(bmi, queries, k).count()
    assert read < every


def test_blocks_hold_their_maxima(built):
    _, bmi, _ = built
    seen = bmi.postings.groupBy("term", "level").agg(F.max("part").alias("m"), F.count("*").alias("n"))
    joined = seen.join(bmi.blocks, ["term", "level"])
    assert joined.where((F.col("m") != F.col("top")) | (F.col("n") != F.col("rows"))).count() == 0
    assert joined.count() == bmi.blocks.count()


def test_query_without_known_terms(spark, built):
    index, bmi, _ = built
    queries = spark.createDataFrame([(1, "zzzz qqqq"), (2, None)], "query_id long, query_text string")
    assert block_max_topk(bmi, queries, 3).count() == 0

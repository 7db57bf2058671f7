"""Registered queries: hybrid search and its evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.tables import (
    SQL_COLLECTION,
    SQL_QRELS,
    bm25_index,
    collection,
    sentence_qrels,
    stored_qrels,
    sql_bm25,
    sql_dense,
    sql_sparse,
    table,
    text_queries,
    vector_queries,
)
from rankweave.operators.dense import knn
from rankweave.operators.filters import FilterCondition, FilterOperator, MetadataFilter, MetadataFilters
from rankweave.operators.fusion import reciprocal_rank_fusion, weighted_sum_ranking
from rankweave.operators.sparse import bm25_topk
from rankweave.operators.topk import top_per_query
from rankweave.plans.evaluate import (
    K_VALUES,
    SWEEP,
    evaluate,
    mark_relevant,
    mean_metrics,
    query_metrics,
    relevant_counts,
    summary_table,
    sweep,
)
from rankweave.plans.search import SearchTarget, ranked, search
from rankweave.spec import CollectionSpec, DistanceStrategy, SearchConfig

K = 10
FILTER = MetadataFilters(
    [MetadataFilter("lang", "en"), MetadataFilter("n_chars", 500, FilterOperator.GTE)],
    FilterCondition.AND,
)
SQL_FILTER = "lang = 'en' AND n_chars >= 500"
NAMES = [c.name for c in SWEEP]


def _target(spark, sf):
    return SearchTarget(collection(spark, sf), bm25_index(spark, sf))


def _rounded(results):
    return results.select(
        "query_id", "id", "rank", "dense_rank", "sparse_rank", F.round("score", 6).alias("score"),
        F.round("distance", 6).alias("distance"), F.round("bm25_score", 6).alias("bm25_score"),
    )


def hybrid(filter=None, k=K, **options):
    def run(spark, sf):
        config = SearchConfig(**options)
        return _rounded(ranked(_target(spark, sf), text_queries(spark, sf), config, k, filter))

    return run


def best_rank(dense, sparse, fetch_top_k, **_):
    """A fusion of one's own: order by the better of the two ranks."""
    both = dense.select("query_id", "id", "distance", F.col("rank").alias("dense_rank")).join(
        sparse.select("query_id", "id", "bm25_score", F.col("rank").alias("sparse_rank")),
        ["query_id", "id"], "full",
    )
    scored = both.withColumn("score", 1.0 / F.least("dense_rank", "sparse_rank"))
    order = [F.desc("score"), F.asc_nulls_last("dense_rank"), F.asc_nulls_last("sparse_rank")]
    return top_per_query(scored, fetch_top_k, order)


def search_rows(spark, sf):
    """The whole lifecycle down to texts and metadata of the winners."""
    rows = search(_target(spark, sf), text_queries(spark, sf), SearchConfig(), 4, FILTER)
    return rows.select(
        "query_id", "rank", "id", F.md5("content").alias("content"),
        F.get_json_object("metadata", "$.source").alias("source"), F.round("score", 6).alias("score"),
    )


def search_rows_without_score(spark, sf):
    rows = search(_target(spark, sf), text_queries(spark, sf), SearchConfig(), 4, with_score=False)
    return rows.select("query_id", "rank", "id", F.md5("content").alias("content"))


def vector_only(spark, sf):
    """Queries without a text are always dense, with k rows."""
    asked = text_queries(spark, sf).drop("query_text")
    return _rounded(ranked(_target(spark, sf), asked, SearchConfig(), K))


def search_empty_text(spark, sf):
    """Every second query has an empty text: it is dense with k rows, the others are fused."""
    asked = text_queries(spark, sf)
    silent = F.when(F.col("query_id") % 2 == 0, F.lit("")).otherwise(F.col("query_text"))
    return _rounded(ranked(_target(spark, sf), asked.withColumn("query_text", silent), SearchConfig(), K))


def _swept(spark, sf):
    docs, asked = collection(spark, sf), text_queries(spark, sf)
    dense = knn(docs, asked, 100)
    sparse = bm25_topk(bm25_index(spark, sf), asked, 100)
    return sweep(dense, sparse)


def config_sweep(spark, sf):
    return _swept(spark, sf).select("config", "query_id", "id", "rank", F.round("score", 6).alias("score"))


def qrels(spark, sf):
    return sentence_qrels(spark, sf)


def _per_query(spark, sf):
    pairs = stored_qrels(spark, sf)
    return query_metrics(mark_relevant(_swept(spark, sf), pairs), relevant_counts(pairs), configs=NAMES)


def metrics_at_k(spark, sf):
    names = ("recall", "precision", "ndcg", "mrr", "ap")
    return _per_query(spark, sf).select("config", "query_id", "k", *[F.round(n, 6).alias(n) for n in names])


def mean_metrics_table(spark, sf):
    pairs, asked = stored_qrels(spark, sf), text_queries(spark, sf)
    means = evaluate(_swept(spark, sf), pairs, asked, configs=NAMES)
    names = ("recall", "precision", "ndcg", "mrr", "map")
    return means.select("config", "k", *[F.round(n, 6).alias(n) for n in names])


def summary(spark, sf):
    rows = summary_table(mean_metrics(_per_query(spark, sf)))
    return rows.select("config", *[F.round(F.col(f"`{c}`"), 6).alias(c) for c in rows.columns[1:]])


def label_metrics(spark, sf):
    """Dense-only run over all stored vectors; relevant is what has the same label.

    Labels are joined to the results, so the pairs of a label are never rows.
    """
    vectors = table(spark, sf, "embeddings")
    labels = vectors.select(F.col("vec_id"), "label")
    found = knn(vectors, vector_queries(spark, sf), 21, spec=CollectionSpec(id="vec_id", metadata=None))
    others = top_per_query(found.where("query_id <> id").drop("rank"), 20, [F.asc("distance"), F.asc("id")])
    marked = (
        others.join(labels.toDF("query_id", "asked"), "query_id")
        .join(labels.toDF("id", "held"), "id")
        .select(F.lit("dense").alias("config"), "query_id", "id", "rank",
                (F.col("asked") == F.col("held")).cast("int").alias("rel"))
    )
    sizes = labels.groupBy("label").agg((F.count("*") - 1).alias("n_rel"))
    judged = labels.join(sizes, "label").select(F.col("vec_id").alias("query_id"), "n_rel")
    means = mean_metrics(query_metrics(marked, judged, configs=["dense"]))
    names = ("recall", "precision", "ndcg", "mrr", "map")
    return means.select("config", "k", *[F.round(n, 6).alias(n) for n in names])


# -- SQL -----------------------------------------------------------------


def _sql_arms(dense_k: int = 20, sparse_k: int = 20, where: str = "TRUE", metric: str = "cosine") -> str:
    return f"""{SQL_COLLECTION}, {sql_bm25()}, {sql_dense('dense', dense_k, metric, where)},
    {sql_sparse('sparse', sparse_k, where)}"""


_SQL_ROUNDED = """query_id, id, rank, dense_rank, sparse_rank, round(score, 6) + 0e0 AS score,
  round(distance, 6) + 0e0 AS distance, round(bm25_score, 6) AS bm25_score"""


def _sql_fused(dense_part: str, sparse_part: str, k: int = K) -> str:
    return f"""
parts AS (
  SELECT query_id, id, {dense_part} AS part, distance, NULL::DOUBLE AS bm25_score, rank AS dense_rank, NULL::BIGINT AS sparse_rank
  FROM dense_in
  UNION ALL
  SELECT query_id, id, {sparse_part}, NULL, bm25_score, NULL, rank FROM sparse_in),
fused AS (
  SELECT query_id, id, sum(part) AS score, max(distance) AS distance, max(bm25_score) AS bm25_score,
         max(dense_rank) AS dense_rank, max(sparse_rank) AS sparse_rank
  FROM parts GROUP BY query_id, id),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id
     ORDER BY score DESC, dense_rank NULLS LAST, sparse_rank NULLS LAST) AS rank FROM fused) WHERE rank <= {k})"""


_SQL_AS_IS = "dense_in AS (SELECT * FROM dense), sparse_in AS (SELECT * FROM sparse)"


def _sql_rrf(dense_w: float = 1.0, sparse_w: float = 1.0, rrf_k: float = 60, k: int = K, **arms) -> str:
    fused = _sql_fused(
        f"{dense_w}::DOUBLE * (1e0 / (rank + {rrf_k}))", f"{sparse_w}::DOUBLE * (1e0 / (rank + {rrf_k}))", k
    )
    return f"WITH {_sql_arms(**arms)}, {_SQL_AS_IS}, {fused}"


def _sql_weighted(dense_w: float, sparse_w: float, metric: str = "cosine") -> str:
    def scaled(column: str) -> str:
        low, high = (f"{f}({column}) OVER (PARTITION BY query_id)" for f in ("min", "max"))
        return f"({column} - {low}) / (CASE WHEN {low} = {high} THEN 1e0 ELSE {high} - {low} END)"

    dense = scaled("distance") if metric == "ip" else f"1e0 - {scaled('distance')}"
    return f"""WITH {_sql_arms(metric=metric)},
dense_in AS (SELECT *, {dense} AS scaled FROM dense),
sparse_in AS (SELECT *, 1e0 - {scaled('bm25_score')} AS scaled FROM sparse),
{_sql_fused(f'scaled * {dense_w}::DOUBLE', f'scaled * {sparse_w}::DOUBLE')}
SELECT {_SQL_ROUNDED} FROM best"""


_SQL_DENSE_ONLY = f"""WITH {SQL_COLLECTION}, {sql_dense('dense', K)}
SELECT query_id, id, rank, rank AS dense_rank, NULL::BIGINT AS sparse_rank, round(distance, 6) + 0e0 AS score,
       round(distance, 6) + 0e0 AS distance, NULL::DOUBLE AS bm25_score FROM dense"""

_SQL_SPARSE_ONLY = f"""WITH {SQL_COLLECTION}, {sql_bm25()}, {sql_sparse('sparse', K)}
SELECT query_id, id, rank, NULL::BIGINT AS dense_rank, rank AS sparse_rank, round(bm25_score, 6) AS score,
       NULL::DOUBLE AS distance, round(bm25_score, 6) AS bm25_score FROM sparse"""


def _sql_sweep() -> str:
    options = ", ".join(
        f"('{c.name}', {c.rrf_k}::DOUBLE, {'NULL' if c.dense_weight is None else c.dense_weight}::DOUBLE, "
        f"{'NULL' if c.sparse_weight is None else c.sparse_weight}::DOUBLE, {c.dense_top_k}, {c.sparse_top_k})"
        for c in SWEEP
    )
    return f"""{_sql_arms(100, 100)},
options(config, rrf_k, dw, sw, dk, sk) AS (VALUES {options}),
sweep_parts AS (
  SELECT config, query_id, id, dw * (1e0 / (rank + rrf_k)) AS part, rank AS dense_rank, NULL::BIGINT AS sparse_rank
  FROM dense, options WHERE dw IS NOT NULL AND rank <= dk
  UNION ALL
  SELECT config, query_id, id, sw * (1e0 / (rank + rrf_k)), NULL, rank
  FROM sparse, options WHERE sw IS NOT NULL AND rank <= sk),
sweep_fused AS (
  SELECT config, query_id, id, sum(part) AS score, max(dense_rank) AS dense_rank, max(sparse_rank) AS sparse_rank
  FROM sweep_parts GROUP BY config, query_id, id),
swept AS (
  SELECT config, query_id, id, score, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY config, query_id
      ORDER BY score DESC, dense_rank NULLS LAST, sparse_rank NULLS LAST) AS rank FROM sweep_fused)
  WHERE rank <= 20)"""


def _sql_metrics(results: str, judged: str) -> str:
    """CTE per_query from results(config, query_id, id, rank, rel) and judged(query_id, n_rel)."""
    ks = ", ".join(f"({k})" for k in K_VALUES)
    return f"""
ks(k) AS (VALUES {ks}),
hits AS (
  SELECT config, query_id, id, rank, sum(rel) OVER (PARTITION BY config, query_id ORDER BY rank) AS seen
  FROM {results} WHERE rel = 1),
ideal AS (
  SELECT k, n, sum(1e0 / log2(i + 1e0)) AS dcg
  FROM ks, (SELECT unnest(range(1, 21)) AS n), (SELECT unnest(range(1, 21)) AS i) WHERE i <= n AND n <= k GROUP BY k, n),
per_query AS (
  SELECT c.config, j.query_id, ks.k,
    coalesce(count(DISTINCT CASE WHEN h.rank <= ks.k THEN h.id END) / j.n_rel::DOUBLE, 0e0) AS recall,
    count(DISTINCT CASE WHEN h.rank <= ks.k THEN h.id END) / ks.k::DOUBLE AS precision,
    coalesce(sum(CASE WHEN h.rank <= ks.k THEN 1e0 / log2(h.rank + 1e0) END), 0e0)
      / any_value(ideal.dcg) AS ndcg,
    coalesce(1e0 / min(h.rank), 0e0) AS mrr,
    coalesce(sum(h.seen::DOUBLE / h.rank) / j.n_rel, 0e0) AS ap
  FROM (SELECT DISTINCT config FROM {results}) c CROSS JOIN {judged} j CROSS JOIN ks
  JOIN ideal ON ideal.k = ks.k AND ideal.n = least(j.n_rel, ks.k)
  LEFT JOIN hits h ON h.config = c.config AND h.query_id = j.query_id
  GROUP BY c.config, j.query_id, ks.k, j.n_rel)"""


_SQL_MEANS = """SELECT config, k, round(avg(recall), 6) AS recall, round(avg(precision), 6) AS precision,
  round(avg(ndcg), 6) AS ndcg, round(avg(mrr), 6) AS mrr, round(avg(ap), 6) AS map FROM {0} GROUP BY config, k"""

_SQL_EVALUATED = f"""WITH {_sql_sweep()}, {SQL_QRELS},
judged AS (SELECT query_id, count(*) AS n_rel FROM qrels GROUP BY query_id),
marked AS (
  SELECT s.config, s.query_id, s.id, s.rank, CASE WHEN r.doc_id IS NULL THEN 0 ELSE 1 END AS rel
  FROM swept s LEFT JOIN qrels r ON r.query_id = s.query_id AND r.doc_id = s.id),
{_sql_metrics('marked', 'judged')}"""

_SQL_SUMMARY_COLUMNS = ", ".join(
    f'round(avg({metric}) FILTER (k = {k}), 6) AS "{name}@{k}"'
    for name, metric in (("R", "recall"), ("nDCG", "ndcg"))
    for k in K_VALUES
)

QUERIES = {
    "hybrid_rrf": hybrid(),
    "hybrid_rrf_weighted": hybrid(dense_weight=0.7, sparse_weight=0.3, fusion_function_parameters={"rrf_k": 30}),
    "hybrid_rrf_inner_product": hybrid(distance_strategy=DistanceStrategy.INNER_PRODUCT),
    "hybrid_rrf_filtered": hybrid(filter=FILTER, dense_top_k=50, sparse_top_k=50),
    "hybrid_weighted_sum": hybrid(
        fusion_function=weighted_sum_ranking, fusion_function_parameters={}, dense_weight=0.5, sparse_weight=0.5
    ),
    "hybrid_weighted_sum_inner_product": hybrid(
        fusion_function=weighted_sum_ranking, fusion_function_parameters={}, dense_weight=0.7, sparse_weight=0.3,
        distance_strategy=DistanceStrategy.INNER_PRODUCT,
    ),
    "hybrid_own_fusion": hybrid(fusion_function=best_rank, fusion_function_parameters={}),
    "hybrid_dense_only": hybrid(enable_sparse=False),
    "hybrid_sparse_only": hybrid(enable_dense=False),
    "vector_only_search": vector_only,
    "search_empty_text": search_empty_text,
    "search_rows": search_rows,
    "search_rows_without_score": search_rows_without_score,
    "config_sweep": config_sweep,
    "sentence_qrels": qrels,
    "metrics_at_k": metrics_at_k,
    "mean_metrics": mean_metrics_table,
    "summary_table": summary,
    "label_metrics": label_metrics,
}

ORACLE = {
    "hybrid_rrf": f"{_sql_rrf()} SELECT {_SQL_ROUNDED} FROM best",
    "hybrid_rrf_weighted": f"{_sql_rrf(0.7, 0.3, 30)} SELECT {_SQL_ROUNDED} FROM best",
    "hybrid_rrf_inner_product": f"{_sql_rrf(metric='ip')} SELECT {_SQL_ROUNDED} FROM best",
    "hybrid_rrf_filtered": f"{_sql_rrf(dense_k=50, sparse_k=50, where=SQL_FILTER)} SELECT {_SQL_ROUNDED} FROM best",
    "hybrid_weighted_sum": _sql_weighted(0.5, 0.5),
    "hybrid_weighted_sum_inner_product": _sql_weighted(0.7, 0.3, "ip"),
    "hybrid_own_fusion": f"""WITH {_sql_arms()}, scored AS (
      SELECT query_id, id, distance, bm25_score, d.rank AS dense_rank, s.rank AS sparse_rank,
             1e0 / least(d.rank, s.rank) AS score
      FROM dense d FULL JOIN sparse s USING (query_id, id)),
    best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id
      ORDER BY score DESC, dense_rank NULLS LAST, sparse_rank NULLS LAST) AS rank FROM scored) WHERE rank <= {K})
    SELECT {_SQL_ROUNDED} FROM best""",
    "hybrid_dense_only": _SQL_DENSE_ONLY,
    "hybrid_sparse_only": _SQL_SPARSE_ONLY,
    "vector_only_search": _SQL_DENSE_ONLY,
    "search_empty_text": f"""SELECT * FROM ({_sql_rrf()} SELECT {_SQL_ROUNDED} FROM best WHERE query_id % 2 <> 0)
    UNION ALL BY NAME SELECT * FROM ({_SQL_DENSE_ONLY} WHERE query_id % 2 = 0)""",
    "search_rows": f"""{_sql_rrf(k=4, where=SQL_FILTER)}
    SELECT query_id, rank, id::VARCHAR AS id, md5(content) AS content, source, round(score, 6) AS score
    FROM best JOIN coll USING (id)""",
    "search_rows_without_score": f"""{_sql_rrf(k=4)}
    SELECT query_id, rank, id::VARCHAR AS id, md5(content) AS content FROM best JOIN coll USING (id)""",
    "config_sweep": f"WITH {_sql_sweep()} SELECT config, query_id, id, rank, round(score, 6) AS score FROM swept",
    "sentence_qrels": f"WITH {SQL_QRELS} SELECT query_id, doc_id FROM qrels",
    "metrics_at_k": f"""{_SQL_EVALUATED} SELECT config, query_id, k, round(recall, 6) AS recall,
      round(precision, 6) AS precision, round(ndcg, 6) AS ndcg, round(mrr, 6) AS mrr, round(ap, 6) AS ap FROM per_query""",
    "mean_metrics": f"{_SQL_EVALUATED} {_SQL_MEANS.format('per_query')}",
    "summary_table": f"""{_SQL_EVALUATED} SELECT config, {_SQL_SUMMARY_COLUMNS},
      round(avg(mrr) FILTER (k = {K_VALUES[0]}), 6) AS "MRR", round(avg(ap) FILTER (k = {K_VALUES[0]}), 6) AS "MAP"
      FROM per_query GROUP BY config""",
    "label_metrics": f"""WITH near AS (
      SELECT q.vec_id AS query_id, d.vec_id AS id, (q.label = d.label)::INTEGER AS rel,
             row_number() OVER (PARTITION BY q.vec_id
               ORDER BY list_cosine_distance(d.embedding::DOUBLE[], q.embedding::DOUBLE[]), d.vec_id) AS rank
      FROM embeddings d, embeddings q WHERE d.vec_id <> q.vec_id),
    marked AS (SELECT 'dense' AS config, * FROM near WHERE rank <= 20),
    judged AS (SELECT vec_id AS query_id, count(*) OVER (PARTITION BY label) - 1 AS n_rel FROM embeddings),
    {_sql_metrics('marked', 'judged')} {_SQL_MEANS.format('per_query')}""",
}

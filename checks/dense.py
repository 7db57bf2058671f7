"""Registered queries: vectors and dense search."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from checks.tables import (
    DIM,
    SQL_COLLECTION,
    collection,
    sql_dense,
    sql_distance,
    table,
    text_queries,
    vector_queries,
)
from rankweave.functions.vectors import (
    cosine_similarity,
    hash_embedding,
    inner_product,
    l2_distance,
    positional_hash_embedding,
)
from rankweave.operators.dense import knn
from rankweave.operators.filters import FilterOperator, MetadataFilter
from rankweave.operators.ivf import assign_lists, build_ivf, extend_ivf, ivf_search
from rankweave.operators.mmr import mmr
from rankweave.plans.evaluate import mark_relevant, mean_metrics, query_metrics
from rankweave.runtime import scratch_path
from rankweave.sources.indexes import drop_index, save_ivf_index
from rankweave.spec import CollectionSpec, DistanceStrategy, IterativeScanMode, IvfParams

VECTORS = CollectionSpec(id="vec_id", metadata=None)
COSINE = DistanceStrategy.COSINE_DISTANCE
METRICS = {
    "cosine": COSINE,
    "l2": DistanceStrategy.EUCLIDEAN,
    "ip": DistanceStrategy.INNER_PRODUCT,
}
ENGLISH = MetadataFilter("lang", "en")
NOT_LABEL_0 = MetadataFilter("label", 0, FilterOperator.NE)
LISTS = 16


def _rounded(found):
    return found.select("query_id", "id", "rank", F.round("distance", 6).alias("distance"))


def _stored_topk(metric: str, k: int = 4, **options):
    def run(spark, sf):
        docs = table(spark, sf, "embeddings")
        return _rounded(knn(docs, vector_queries(spark, sf), k, METRICS[metric], spec=VECTORS, **options))

    return run


def _sql_stored_topk(metric: str, k: int = 4, where: str = "TRUE") -> str:
    order = "DESC" if metric == "ip" else "ASC"
    return f"""
    SELECT query_id, id, rank, round(distance, 6) + 0e0 AS distance FROM (
      SELECT q.vec_id AS query_id, d.vec_id AS id, {sql_distance(metric, 'd.embedding', 'q.embedding')} AS distance,
             row_number() OVER (PARTITION BY q.vec_id
               ORDER BY {sql_distance(metric, 'd.embedding', 'q.embedding')} {order}, d.vec_id) AS rank
      FROM embeddings d, embeddings q WHERE {where}) WHERE rank <= {k}"""


def text_topk(metric: str):
    def run(spark, sf):
        return _rounded(knn(collection(spark, sf), text_queries(spark, sf), 10, METRICS[metric], ENGLISH))

    return run


def _sql_text_topk(metric: str) -> str:
    return f"""WITH {SQL_COLLECTION}, {sql_dense('dense', 10, metric, "lang = 'en'")}
    SELECT query_id, id, rank, round(distance, 6) + 0e0 AS distance FROM dense"""


def paired_similarity(spark, sf):
    stored = table(spark, sf, "embeddings")
    docs = table(spark, sf, "documents")
    pairs = stored.join(docs, stored.vec_id == docs.doc_id)
    a, b = F.col("embedding"), hash_embedding(F.col("text"), DIM)
    pairs = pairs.select("doc_id", a.alias("a"), b.alias("b"))
    a, b = F.col("a"), F.col("b")
    return pairs.select(
        "doc_id",
        F.round(cosine_similarity(a, b), 6).alias("similarity"),
        F.round(inner_product(a, b), 6).alias("product"),
        F.round(l2_distance(a, b), 6).alias("gap"),
    )


def _embedding_rows(embed):
    def run(spark, sf):
        docs = table(spark, sf, "documents").select("doc_id", embed(F.col("text"), DIM).alias("v"))
        items = docs.select("doc_id", F.posexplode("v").alias("place", "value"))
        return items.select("doc_id", F.col("place").cast("bigint"), F.round(F.col("value").cast("double"), 5).alias("value"))

    return run


def _sql_embedding_rows(value: str) -> str:
    byte = "(('0x' || substr(digest, (2 * (({0}) % 32) + 1)::BIGINT, 2))::INTEGER)"
    value = value.replace("BYTE0", byte.format("i")).replace("BYTE1", byte.format("i + 1"))
    return f"""
    WITH digests AS (SELECT doc_id, sha256(text) AS digest FROM documents),
    raw AS (SELECT doc_id, i AS place, {value} AS v
            FROM (SELECT doc_id, digest, unnest(range(0, {DIM})) AS i FROM digests)),
    norms AS (SELECT doc_id, sqrt(sum(v * v)) AS norm FROM raw GROUP BY doc_id)
    SELECT doc_id, place, round((v / norm)::FLOAT::DOUBLE, 5) + 0e0 AS value FROM raw JOIN norms USING (doc_id)"""


def _mmr(spark, sf):
    found = mmr(collection(spark, sf), text_queries(spark, sf), 4, 20)
    return found.select("query_id", "id", "rank", "mmr_order", F.round("distance", 6).alias("distance"))


def _sql_mmr(k: int = 4, fetch_k: int = 20) -> str:
    steps = ["""
chosen1 AS (
  SELECT query_id, id, 1 AS mmr_order FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY relevance DESC, place) AS n FROM cand) WHERE n = 1)"""]
    for step in range(2, k + 1):
        steps.append(f"""
gain{step} AS (
  SELECT c.query_id, c.id, c.place,
         5e-1 * any_value(c.relevance) - 5e-1 * max(list_cosine_similarity(c.v, o.v)) AS gain
  FROM cand c JOIN chosen{step - 1} s ON s.query_id = c.query_id
  JOIN cand o ON o.query_id = s.query_id AND o.id = s.id
  WHERE NOT EXISTS (SELECT 1 FROM chosen{step - 1} t WHERE t.query_id = c.query_id AND t.id = c.id)
  GROUP BY c.query_id, c.id, c.place),
chosen{step} AS (
  SELECT * FROM chosen{step - 1}
  UNION ALL
  SELECT query_id, id, {step} FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY gain DESC, place) AS n FROM gain{step}) WHERE n = 1)""")
    return f"""WITH {SQL_COLLECTION}, {sql_dense('dense', fetch_k)},
cand AS (
  SELECT d.query_id, d.id, d.rank AS place, d.distance, c.embedding::DOUBLE[] AS v,
         list_cosine_similarity(c.embedding::DOUBLE[], q.query_embedding::DOUBLE[]) AS relevance
  FROM dense d JOIN coll c USING (id) JOIN queries q USING (query_id)),
{','.join(steps)}
SELECT query_id, id, row_number() OVER (PARTITION BY query_id ORDER BY place) AS rank, mmr_order,
       round(distance, 6) + 0e0 AS distance
FROM chosen{k} JOIN cand USING (query_id, id)"""


def _ivf(spark, sf, where=None):
    params = IvfParams(lists=LISTS, where=where)
    return build_ivf(table(spark, sf, "embeddings"), params, VECTORS)


def _ivf_given(spark, sf, rows=None):
    """Lists around given centres, the first stored vectors, so that SQL can follow the probes."""
    vectors = table(spark, sf, "embeddings")
    first = vectors.where(F.col("vec_id") < LISTS).orderBy("vec_id").select("embedding").collect()
    centers = np.array([r[0] for r in first])
    return assign_lists(vectors if rows is None else rows, centers, IvfParams(lists=LISTS), VECTORS)


def ivf_full_probe(spark, sf):
    return _rounded(ivf_search(_ivf(spark, sf), vector_queries(spark, sf), 4, probes=LISTS))


def ivf_partial_index(spark, sf):
    index = _ivf(spark, sf, where="label <> 0")
    return _rounded(ivf_search(index, vector_queries(spark, sf), 4, probes=LISTS))


def ivf_nprobe1(spark, sf):
    return _rounded(ivf_search(_ivf_given(spark, sf), vector_queries(spark, sf), 4, probes=1))


def ivf_saved_filtered(spark, sf):
    """Saved lists, a selective filter, and a second pass for short results."""
    index = save_ivf_index(_ivf_given(spark, sf), scratch_path(spark, "ivf"))
    only = MetadataFilter("label", 3)
    scan = IterativeScanMode.STRICT_ORDER
    found = ivf_search(index, vector_queries(spark, sf), 10, probes=2, filter=only, iterative_scan=scan)
    return _rounded(found)


def ivf_refreshed(spark, sf):
    """A saved index after every third vector went and every fifth was turned round."""
    vectors = table(spark, sf, "embeddings")
    index = save_ivf_index(_ivf_given(spark, sf), scratch_path(spark, "ivf"))
    gone = vectors.where("vec_id % 3 = 1 OR vec_id % 5 = 2").select("vec_id")
    turned = vectors.where("vec_id % 5 = 2 AND vec_id % 3 <> 1").withColumn("embedding", F.transform("embedding", lambda x: -x))
    now = save_ivf_index(extend_ivf(index, turned, gone), scratch_path(spark, "ivf"))
    return _rounded(ivf_search(now, vector_queries(spark, sf), 4, probes=2))


def ivf_dropped(spark, sf):
    """After the index is dropped the search is exact again."""
    path = scratch_path(spark, "ivf")
    save_ivf_index(_ivf(spark, sf), path)
    drop_index(spark, path)
    return _stored_topk("cosine")(spark, sf)


def ivf_recall(spark, sf):
    """Recall of the approximate search against the exact one, by probes."""
    queries = vector_queries(spark, sf)
    index = _ivf_given(spark, sf)
    exact = knn(table(spark, sf, "embeddings"), queries, 10, spec=VECTORS)
    truth = exact.select("query_id", F.col("id").alias("doc_id"))
    judged = queries.select("query_id", F.lit(10).alias("n_rel"))
    names = {f"probes={p}": p for p in (1, 4, LISTS)}
    runs = [
        ivf_search(index, queries, 10, probes=p).withColumn("config", F.lit(name))
        for name, p in names.items()
    ]
    results = runs[0].unionByName(runs[1]).unionByName(runs[2])
    means = mean_metrics(query_metrics(mark_relevant(results, truth), judged, (10,), list(names)))
    return means.select("config", "k", F.round("recall", 6).alias("recall"))


_SQL_LENGTH_ONE = "list_transform({0}::DOUBLE[], lambda x: x / sqrt(list_sum(list_transform({0}::DOUBLE[], lambda y: y * y))))"


def _sql_lists(docs: str = "embeddings") -> str:
    """CTEs: the list of every document, and the lists of every query by nearness."""
    gap = "list_inner_product(c, c) - 2e0 * list_inner_product(v, c)"
    return f"""
    centres AS (SELECT vec_id AS list_id, {_SQL_LENGTH_ONE.format('embedding')} AS c FROM embeddings WHERE vec_id < {LISTS}),
    placed AS (SELECT vec_id, any_value(embedding) AS embedding, any_value(label) AS label, arg_min(list_id, (gap, list_id)) AS list_id
      FROM (SELECT d.*, list_id, {gap} AS gap
            FROM (SELECT *, {_SQL_LENGTH_ONE.format('embedding')} AS v FROM {docs}) d, centres) GROUP BY vec_id),
    near AS (SELECT query_id, q, list_id, row_number() OVER (PARTITION BY query_id ORDER BY gap, list_id) AS place
      FROM (SELECT d.vec_id AS query_id, d.embedding AS q, list_id, {gap} AS gap
            FROM (SELECT *, {_SQL_LENGTH_ONE.format('embedding')} AS v FROM embeddings) d, centres))"""


def _sql_probed(name: str, k: int, probes: int, where: str = "TRUE") -> str:
    distance = sql_distance("cosine", "embedding", "q")
    return f"""
    {name} AS (SELECT * FROM (
      SELECT query_id, vec_id AS id, {distance} AS distance,
             row_number() OVER (PARTITION BY query_id ORDER BY {distance}, vec_id) AS rank
      FROM near JOIN placed USING (list_id) WHERE place <= {probes} AND {where}) WHERE rank <= {k})"""


_SQL_FOUND = "SELECT query_id, id, rank, round(distance, 6) + 0e0 AS distance FROM"
_SQL_IVF = {
    "ivf_nprobe1": f"WITH {_sql_lists()}, {_sql_probed('found', 4, 1)} {_SQL_FOUND} found",
    "ivf_saved_filtered": f"""WITH {_sql_lists()}, {_sql_probed('found', 10, 2, 'label = 3')},
    {_sql_probed('whole', 10, LISTS, 'label = 3')},
    enough AS (SELECT query_id FROM found GROUP BY query_id HAVING count(*) >= 10)
    {_SQL_FOUND} found WHERE query_id IN (FROM enough)
    UNION ALL {_SQL_FOUND} whole WHERE query_id NOT IN (FROM enough)""",
    "ivf_refreshed": f"""WITH changed AS (
      SELECT vec_id, CASE WHEN vec_id % 5 = 2 THEN list_transform(embedding, lambda x: -x) ELSE embedding END AS embedding, label
      FROM embeddings WHERE vec_id % 3 <> 1),
    {_sql_lists('changed')}, {_sql_probed('found', 4, 2)} {_SQL_FOUND} found""",
    "ivf_recall": f"""WITH {_sql_lists()}, {_sql_probed('p1', 10, 1)}, {_sql_probed('p4', 10, 4)}, {_sql_probed('p16', 10, LISTS)},
    runs AS (SELECT 'probes=1' AS config, * FROM p1 UNION ALL SELECT 'probes=4', * FROM p4 UNION ALL SELECT 'probes={LISTS}', * FROM p16)
    SELECT config, 10 AS k, round(count(p16.id) / 1e1 / (SELECT count(*) FROM embeddings), 6) + 0e0 AS recall
    FROM runs LEFT JOIN p16 USING (query_id, id) GROUP BY config""",
}


QUERIES = {
    "dense_cosine_topk": _stored_topk("cosine"),
    "dense_l2_topk": _stored_topk("l2"),
    "dense_ip_topk": _stored_topk("ip"),
    "dense_filtered_topk": _stored_topk("cosine", filter=NOT_LABEL_0),
    "dense_block_shuffle_topk": _stored_topk("l2", 10, max_broadcast_rows=256),
    "dense_text_cosine_topk": text_topk("cosine"),
    "dense_text_l2_topk": text_topk("l2"),
    "dense_text_ip_topk": text_topk("ip"),
    "paired_similarity": paired_similarity,
    "hash_embedding": _embedding_rows(hash_embedding),
    "positional_hash_embedding": _embedding_rows(positional_hash_embedding),
    "mmr": _mmr,
    "ivf_full_probe": ivf_full_probe,
    "ivf_partial_index": ivf_partial_index,
    "ivf_nprobe1": ivf_nprobe1,
    "ivf_saved_filtered": ivf_saved_filtered,
    "ivf_refreshed": ivf_refreshed,
    "ivf_dropped": ivf_dropped,
    "ivf_recall": ivf_recall,
}

ORACLE = {
    "dense_cosine_topk": _sql_stored_topk("cosine"),
    "dense_l2_topk": _sql_stored_topk("l2"),
    "dense_ip_topk": _sql_stored_topk("ip"),
    "dense_filtered_topk": _sql_stored_topk("cosine", where="d.label <> 0"),
    "dense_block_shuffle_topk": _sql_stored_topk("l2", 10),
    "dense_text_cosine_topk": _sql_text_topk("cosine"),
    "dense_text_l2_topk": _sql_text_topk("l2"),
    "dense_text_ip_topk": _sql_text_topk("ip"),
    "paired_similarity": f"""WITH {SQL_COLLECTION},
    hashes AS (SELECT id, stored::DOUBLE[] AS a, list_transform(hashed,
        lambda x: x / sqrt(list_sum(list_transform(hashed, lambda y: y * y))))::FLOAT[]::DOUBLE[] AS b
      FROM raw_docs WHERE stored IS NOT NULL)
    SELECT id AS doc_id, round(list_cosine_similarity(a, b), 6) + 0e0 AS similarity,
           round(list_inner_product(a, b), 6) + 0e0 AS product, round(list_distance(a, b), 6) AS gap FROM hashes""",
    "hash_embedding": _sql_embedding_rows("BYTE0 / 255e0 * 2e0 - 1e0"),
    "positional_hash_embedding": _sql_embedding_rows(
        "(BYTE0 / 255e0 * 2e0 - 1e0) * (5e-1 + 5e-1 * ((i + BYTE1) % 100) / 100e0)"
    ),
    "mmr": _sql_mmr(),
    "ivf_full_probe": _sql_stored_topk("cosine"),
    "ivf_partial_index": _sql_stored_topk("cosine", where="d.label <> 0"),
    "ivf_dropped": _sql_stored_topk("cosine"),
    **_SQL_IVF,
}

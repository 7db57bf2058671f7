"""Exact top-k inner-product search by norm-bucketed retrieval.

Vectors are grouped by length (squared norm): ranges of the squared norm cut
at quantiles over all rows, each range dealt by a hash of the id into buckets
of at most about ``BUCKET_ROWS`` rows, so a norm that many rows share is split
too. A query first meets one bucket of the longest vectors; the k-th best of
those scores is a lower bound ``s`` of its final k-th score. A bucket whose
longest vector p gives ``|q| |p| < s`` cannot hold a result, so the query only
visits ranges from the first one that can; inside a bucket the local cosine
threshold ``s / (|q| max|p|)`` chooses the pruning:

- above ``COORD_THETA``: coordinate pruning - a candidate must lie, on the
  query's largest coordinate, within the band that such a cosine allows
  (found by binary search in the bucket's sorted coordinate);
- otherwise length pruning - candidates sorted by length, only the prefix with
  ``|q| |p| >= s`` is taken.

The products of the candidates left are computed exactly in integers and the
k best of each visited bucket are ranked again per query. Squared lengths are
doubles, which long vectors do not overflow; every bound taken from them gives
way by ``SLACK``, so rounding never drops a candidate.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import range_bounds, range_bucket, stored

# Rows of a bucket of candidates and of a block of queries that meet in one task.
BUCKET_ROWS = 4096
QUERY_ROWS = 4096
# Bytes of components that a bucket or a block holds at most: wide vectors make smaller ones.
BUCKET_BYTES = 16 * 1024 * 1024
# Share by which a bound from squared lengths gives way; their rounding is far below it.
SLACK = 1e-9
# Local cosine threshold from which coordinate pruning is used instead of length pruning.
COORD_THETA = 0.3
K = 5
SCALE = 256
QUERY_EVERY = 50

RESULT = "query_id long, rank int, vec_id long, score long"
_SCORES = "query_id long, copy int, vec_id long, score long"


def integer_vectors(embeddings: DataFrame, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(vec_id, v: floor(256 x) as longs, n2: squared length as a double) of the usable rows.

    Rows with a null id, a null vector or a null, NaN or infinite component
    take no part; an empty vector is usable (all its products are 0).
    """
    x = F.col(column)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    ints = F.transform(x, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))
    out = embeddings.where(F.col(key).isNotNull() & x.isNotNull() & ~bad)
    out = out.select(F.col(key).alias("vec_id"), ints.alias("v"))
    return out.withColumn("n2", F.aggregate("v", F.lit(0.0), lambda acc, c: acc + c.cast("double") * c.cast("double")))


def exact_topk(
    embeddings: DataFrame,
    k: int = K,
    every: int = QUERY_EVERY,
    bucket_rows: int = BUCKET_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """The k best candidates of every query by integer inner product.

    Queries are the usable rows whose vec_id is divisible by ``every``;
    candidates are all usable rows but those with the query's vec_id. Ties go
    to the smaller vec_id; a query with fewer candidates gets them all.
    Vectors of unequal length are compared as if padded with zeros. Repeated
    rows are each a candidate (a repeated query row reports its list once per
    copy). Returns (query_id, rank from 1, vec_id, score).
    """
    spark = embeddings.sparkSession
    # The key of a range: beyond the longs all lengths share the last one.
    vectors = integer_vectors(embeddings).withColumn("n2_key", F.least("n2", F.lit(9e18)).cast("long"))
    cuts = range_bounds(vectors, "n2_key")
    vectors = vectors.withColumn("range", range_bucket("n2_key", cuts)).drop("n2_key")
    found = vectors.groupBy("range").agg(F.count("*").alias("rows"), F.max("n2").alias("top"), F.max(F.size("v")).alias("width"))
    ranges = sorted((r.range, r.rows, r.top, r.width) for r in found.collect())
    if not ranges:
        return spark.createDataFrame([], RESULT)
    fitting = max(1, BUCKET_BYTES // (8 * max(1, *[width for *_, width in ranges])))
    bucket_rows, query_rows = min(bucket_rows, fitting), min(query_rows, fitting)
    subs = {r: max(1, math.ceil(rows / bucket_rows)) for r, rows, *_ in ranges}
    # Longest squared length up to each range: a bound that rises with the range.
    bounds = np.maximum.accumulate(np.array([top for _, _, top, _ in ranges], np.float64))
    ids = np.array([r for r, *_ in ranges], np.int64)
    sub_of = F.create_map(*[F.lit(x) for r, n in subs.items() for x in (r, n)])
    # An int, as in ``asked``: keys of two types are dealt to different tasks and never meet.
    vectors = vectors.withColumn("sub", F.pmod(F.xxhash64("vec_id"), F.element_at(sub_of, F.col("range"))).cast("int"))

    # Rows of one vec_id are queries of their own, told apart by ``copy``.
    queries = vectors.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "v", "n2")
    queries = queries.withColumn("copy", F.row_number().over(Window.partitionBy("query_id").orderBy("v")))
    blocks = max(1, math.ceil(queries.count() / query_rows))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("query_id", "copy"), F.lit(blocks)))
    keys = ["range", "sub", "block"]

    def bucket(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _bucket_scores(left, right, k)

    def meet(asked: DataFrame, visits: DataFrame) -> DataFrame:
        # Fresh names: the candidates' side must not share columns with the queries' one.
        dealt = vectors.join(visits, ["range", "sub"]).select(*[F.col(c).alias(c) for c in (*keys, "vec_id", "v", "n2")])
        return asked.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInPandas(bucket, _SCORES)

    top_range = int(ids[-1])
    place = {"range": F.lit(top_range), "sub": F.lit(0)}
    first = queries.withColumns({**place, "seed": F.lit(None).cast("long")})
    everywhere = spark.range(blocks).select(*[c.alias(n) for n, c in place.items()], F.col("id").alias("block"))
    met = stored(meet(first, everywhere), "topk-seed")
    # Only a full list bounds the k-th score.
    seeds = met.groupBy("query_id", "copy").agg(F.when(F.count("*") == k, F.min("score")).alias("seed"))

    @F.pandas_udf("long")
    def first_range(seed: pd.Series, n2: pd.Series) -> pd.Series:
        # Ranges whose bound b has b * n2 >= seed^2 (all, when seed <= 0 or unknown).
        known = seed.fillna(0).astype("float64").to_numpy()
        least = known**2 * (1 - SLACK) / np.maximum(n2.to_numpy("float64"), 1)
        at = np.searchsorted(bounds, least, side="left")
        return pd.Series(np.where(known <= 0, 0, at), dtype="int64")

    asked = queries.join(seeds, ["query_id", "copy"], "left")
    ranks = F.array(*[F.lit(int(r)) for r in ids])
    asked = asked.withColumn("range", F.explode(F.slice(ranks, first_range("seed", "n2") + 1, len(ids))))
    asked = asked.withColumn("sub", F.explode(F.sequence(F.lit(0), F.element_at(sub_of, F.col("range")) - 1)))
    asked = asked.where((F.col("range") != top_range) | (F.col("sub") != 0))
    asked = stored(asked, "topk-asked")
    visits = asked.select(*keys).distinct()
    order = Window.partitionBy("query_id", "copy").orderBy(F.col("score").desc(), F.col("vec_id").asc())
    ranked = met.unionByName(meet(asked, visits)).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def _padded(vectors: list) -> np.ndarray:
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best: score descending, then id ascending."""
    order = np.lexsort((ids, -scores))
    return order[:k]


def _bucket_scores(queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> pd.DataFrame:
    """Exact k best of one bucket for each query, pruned by length or by coordinate."""
    if queries.empty or candidates.empty:
        return pd.DataFrame({"query_id": [], "copy": [], "vec_id": [], "score": []}, dtype="int64")
    order = np.argsort(-candidates["n2"].to_numpy(), kind="stable")
    ids = candidates["vec_id"].to_numpy()[order]
    n2 = candidates["n2"].to_numpy()[order]
    matrix = _padded([candidates["v"].iloc[i] for i in order])
    q_matrix = _padded(list(queries["v"]))
    width = max(matrix.shape[1], q_matrix.shape[1])
    matrix = np.pad(matrix, ((0, 0), (0, width - matrix.shape[1])))
    q_matrix = np.pad(q_matrix, ((0, 0), (0, width - q_matrix.shape[1])))
    lengths = np.sqrt(n2)
    unit = matrix / np.maximum(lengths, 1e-300)[:, None]
    # Sorted lists per coordinate, built when a query first asks for that coordinate.
    sorted_by: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    top = float(lengths[0])
    out_q, out_copy, out_id, out_s = [], [], [], []
    asking = zip(queries["query_id"], queries["copy"], queries["seed"], queries["n2"])
    for row, (qid, copy, seed, qn2) in enumerate(asking):
        q = q_matrix[row]
        known = seed is not None and not pd.isna(seed) and seed > 0
        take = len(ids)
        if known:
            # Length pruning: the prefix whose |p|^2 * |q|^2 >= seed^2.
            need = float(seed) ** 2 * (1 - SLACK)
            take = int(np.searchsorted(-(n2 * float(qn2)), -need, side="right"))
        picked = np.arange(take)
        q_len = math.sqrt(float(qn2))
        theta = float(seed) / (q_len * top) * (1 - SLACK) if known and q_len > 0 and top > 0 else 0.0
        if known and theta >= COORD_THETA and take > 0:
            f = int(np.argmax(np.abs(q)))
            qf = q[f] / q_len
            # The cap of cosine >= theta around q, seen on axis f: an open side where the cap holds the axis.
            half = math.sqrt(max(0.0, (1 - theta * theta) * (1 - qf * qf)))
            low = -2.0 if qf < -theta else theta * qf - half - 1e-9
            high = 2.0 if qf > theta else theta * qf + half + 1e-9
            if f not in sorted_by:
                at = np.argsort(unit[:, f], kind="stable")
                sorted_by[f] = (at, unit[at, f])
            at, values = sorted_by[f]
            band = at[np.searchsorted(values, low, "left") : np.searchsorted(values, high, "right")]
            picked = np.sort(band[band < take])
        if not len(picked):
            continue
        scores = matrix[picked] @ q
        cand = ids[picked]
        keep = cand != qid
        if known:
            keep &= scores >= seed
        cand, scores = cand[keep], scores[keep]
        best = _best(cand, scores, k)
        out_q.extend([qid] * len(best))
        out_copy.extend([copy] * len(best))
        out_id.extend(cand[best].tolist())
        out_s.extend(scores[best].tolist())
    return pd.DataFrame({"query_id": out_q, "copy": out_copy, "vec_id": out_id, "score": out_s}, dtype="int64")

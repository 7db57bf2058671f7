"""Inner-product search over inverted lists by norm augmentation.

Lists trained under inner product on vectors scaled to length one put a long
vector in the list of its direction, although its products are large against
many queries. With ``M`` the largest length of all documents, a document x
becomes ``(x, sqrt(M^2 - |x|^2))`` and a query q becomes ``(q, 0)``; then
``|q' - x'|^2 = |q|^2 + M^2 - 2 q.x``, so the nearest documents in Euclidean
distance are those of largest inner product. Lists are trained and probed in
that space; the found documents are ranked again by their exact product.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankweave.operators.ivf import IvfIndex, build_ivf, ivf_search
from rankweave.spec import DEFAULT_K, CollectionSpec, DistanceStrategy, IvfParams


@dataclass(frozen=True)
class AugmentedIndex:
    lists: IvfIndex
    longest: float
    docs: DataFrame
    #: No id is null or of two documents.
    distinct: bool


def _doubles(column: str) -> Column:
    return F.transform(F.col(column), lambda x: x.cast("double"))


def _square(column: Column) -> Column:
    return F.aggregate(column, F.lit(0.0), lambda acc, x: acc + x * x)


def _distinct(rows: DataFrame, key: str) -> bool:
    """True when no value of the column is null or comes twice."""
    return rows.groupBy(key).count().where(F.col(key).isNull() | (F.col("count") > 1)).isEmpty()


def build_augmented_ivf(
    docs: DataFrame, lists: int = 100, spec: CollectionSpec = CollectionSpec(), seed: int = 42
) -> AugmentedIndex:
    """Lists over the augmented documents; rows without a vector are left out.

    ``M`` is one aggregate over all rows; the extra value is the square root of
    ``M^2 - |x|^2`` (never below 0).
    """
    usable = docs.where(F.col(spec.embedding).isNotNull()).withColumn(spec.embedding, _doubles(spec.embedding))
    longest = usable.agg(F.max(F.sqrt(_square(F.col(spec.embedding)))).alias("m")).first().m or 0.0
    extra = F.sqrt(F.greatest(F.lit(longest * longest) - _square(F.col(spec.embedding)), F.lit(0.0)))
    augmented = usable.withColumn(spec.embedding, F.concat(F.col(spec.embedding), F.array(extra)))
    index = build_ivf(augmented, IvfParams(lists=lists, distance_strategy=DistanceStrategy.EUCLIDEAN, seed=seed), spec)
    return AugmentedIndex(index, float(longest), usable.select(spec.id, spec.embedding), _distinct(usable, spec.id))


def augmented_search(index: AugmentedIndex, queries: DataFrame, k: int = DEFAULT_K, probes: int = 1) -> DataFrame:
    """(query_id, id, rank, distance): the k largest inner products found in the probed lists.

    ``distance`` is the inner product, as the inner-product metric of ``knn``
    reports it (largest first); ties go to the smaller id.
    """
    spec = index.lists.spec
    asked = queries.select("query_id", _doubles("query_embedding").alias("query_embedding")).where(
        F.col("query_embedding").isNotNull()
    )
    padded = asked.withColumn("query_embedding", F.concat("query_embedding", F.array(F.lit(0.0))))
    found = ivf_search(index.lists, padded, k, probes=probes, products=True)
    if index.distinct and _distinct(asked, "query_id"):
        scored = found.select("query_id", "id", F.col("product").alias("distance"))
    else:
        # An id of several rows stands for all of them.
        vectors = index.docs.select(F.col(spec.id).alias("id"), F.col(spec.embedding).alias("v"))
        scored = found.select("query_id", "id").join(asked, "query_id").join(vectors, "id")
        product = F.aggregate(F.zip_with("query_embedding", "v", lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)
        scored = scored.select("query_id", "id", product.alias("distance"))
    order = Window.partitionBy("query_id").orderBy(F.desc("distance"), "id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

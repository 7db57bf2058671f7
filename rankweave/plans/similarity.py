"""Similarity of query and document pairs, and histograms of a corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Seed, and the edges 0 .. 1 of the histogram.
SAMPLE_SEED = 42
SIMILARITY_EDGES = 50
LENGTH_BINS = 10

# Documents numbered in one task, about; sets how finely the hash order is cut.
NUMBERED_ROWS = 50_000


def seeded_hash(column: Column, seed: int) -> Column:
    return F.md5(F.concat(column.cast("string"), F.lit(f":{seed}")))


def sample_queries(qrels: DataFrame, queries: DataFrame, n: int | None = None, seed: int = SAMPLE_SEED) -> DataFrame:
    """Judged queries that exist: (query_id). With ``n``, the first n in seeded order."""
    judged = qrels.select("query_id").distinct().join(queries, "query_id", "left_semi")
    order = [seeded_hash(F.col("query_id"), seed), F.col("query_id")]
    return judged if n is None else judged.orderBy(*order).limit(n)


def positive_pairs(sample: DataFrame, qrels: DataFrame) -> DataFrame:
    """One relevant document for each sampled query: (query_id, doc_id)."""
    relevant = qrels.join(sample, "query_id", "left_semi")
    return relevant.groupBy("query_id").agg(F.min("doc_id").alias("doc_id"))


def _numbered(ids: DataFrame, seed: int, rows: int) -> DataFrame:
    """Ids numbered from 0 in seeded order: (place, doc_id).

    The first hex digits of the hash cut the order into even ranges; a row's
    place is its number in the range plus the sizes of the ranges before. How
    many digits cut it changes the tasks and not the places.
    """
    digits = 2
    while 16**digits * NUMBERED_ROWS < rows:
        digits += 1
    hashed = ids.select("doc_id", seeded_hash(F.col("doc_id"), seed).alias("h"))
    hashed = hashed.withColumn("range", F.substring("h", 1, digits))
    sizes = hashed.groupBy("range").agg(F.count("*").alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("range").orderBy("h", "doc_id")
    numbered = hashed.withColumn("number", F.row_number().over(inside) - 1)
    return numbered.join(offsets, "range").select((F.col("offset") + F.col("number")).alias("place"), "doc_id")


def negative_pairs(sample: DataFrame, qrels: DataFrame, docs: DataFrame, seed: int = SAMPLE_SEED) -> DataFrame:
    """One seeded random document that is not relevant, for each sampled query.

    All documents stand in seeded order. A query starts at a place of its own
    and takes the first document not judged relevant. A query with n relevant
    documents never needs more than n + 1 steps, so no query meets all of them.
    """
    relevant = qrels.select("query_id", "doc_id").distinct().join(sample, "query_id", "left_semi")
    counts = relevant.groupBy("query_id").agg(F.count("*").alias("n_rel"))
    ids = docs.select("doc_id")
    length = ids.count()
    digits = F.substring(seeded_hash(F.col("query_id"), seed), 1, 8)
    start = F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(length))
    steps = F.explode(F.sequence(F.lit(0), F.col("n_rel").cast("int"))).alias("step")
    tries = counts.select("query_id", start.alias("start"), steps).select(
        "query_id", "step", F.pmod(F.col("start") + F.col("step"), F.lit(length)).alias("place")
    )
    tried = tries.join(_numbered(ids, seed, length), "place")
    free = tried.join(relevant, ["query_id", "doc_id"], "left_anti")
    return free.groupBy("query_id").agg(F.min_by("doc_id", "step").alias("doc_id"))


def _bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Number from 1 of the equal bin [edge, next edge) that holds the value;
    the last bin is closed. The quotient may be off by one at an edge, so it is
    held against the edges themselves."""
    step = (high - low) / F.lit(bins)
    rough = F.floor((value - low) / (high - low) * F.lit(bins))
    above = (value >= low + (rough + 1) * step).cast("int")
    below = (value < low + rough * step).cast("int")
    return F.least(rough + above - below + 1, F.lit(bins)).cast("int")


def similarity_stats(similarities: DataFrame, by: str = "kind") -> DataFrame:
    """Mean, population standard deviation, minimum and maximum of ``similarity``."""
    value = F.col("similarity")
    return similarities.groupBy(by).agg(
        F.avg(value).alias("mean"),
        F.stddev_pop(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )


def similarity_histogram(similarities: DataFrame, by: str = "kind", edges: int = SIMILARITY_EDGES) -> DataFrame:
    """Counts by equal bins of [0, 1]; values outside are left out, 1 is in the last bin."""
    bins = edges - 1
    number = _bin(F.col("similarity"), F.lit(0.0), F.lit(1.0), bins)
    inside = similarities.where(F.col("similarity").between(0.0, 1.0))
    return inside.groupBy(by, number.alias("bin")).agg(F.count("*").alias("n"))


def length_histogram(texts: DataFrame, text: str, bins: int = LENGTH_BINS) -> DataFrame:
    """Counts of text lengths by equal bins between the shortest and the longest."""
    lengths = texts.select(F.length(text).alias("len"))
    ends = lengths.agg(F.min("len").cast("double").alias("low"), F.max("len").cast("double").alias("high"))
    low, high = ends.select("low").scalar(), ends.select("high").scalar()
    # All texts of one length: a range of one around it, as for plotted histograms.
    low, high = (
        F.when(low == high, low - 0.5).otherwise(low),
        F.when(low == high, high + 0.5).otherwise(high),
    )
    number = _bin(F.col("len"), low, high, bins)
    return lengths.groupBy(number.alias("bin")).agg(F.count("*").alias("n"))

"""Size checks before a broadcast, and the shared folder for written tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Most that a broadcast side may hold.
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# The same for a side of bare ids, where a shuffle would move a table many times its size.
MAX_BROADCAST_IDS = 2_000_000
MAX_ID_BYTES = 128 * 1024 * 1024


def is_small(
    df: DataFrame,
    width: Column | None = None,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> bool:
    """True when ``df`` is proven to be under both bounds.

    A count and a sum over all rows, added up in each task first. ``width``
    gives the bytes of the variable part of a row; 64 bytes are added for the rest.
    """
    size = F.lit(64) if width is None else F.coalesce(width, F.lit(0)) + 64
    rows, size_sum = df.agg(*size_of(size)).first()
    return rows <= max_rows and size_sum <= max_bytes


def size_of(width: Column) -> list[Column]:
    """Aggregates: number of rows and the sum of their widths."""
    return [F.count("*"), F.coalesce(F.sum(width.cast("long")), F.lit(0))]


def broadcast_if_small(df: DataFrame, width: Column | None = None) -> DataFrame:
    """Hint a broadcast only for a side that passed the size check."""
    return F.broadcast(df) if is_small(df, width) else df


def broadcast_ids(df: DataFrame, *ids: str) -> DataFrame:
    """Hint a broadcast only for a list of ids under the bounds for ids."""
    texts = [F.octet_length(F.col(c)) for c in ids if df.schema[c].dataType.typeName() in ("string", "binary")]
    width = sum(texts[1:], texts[0]) if texts else None
    return F.broadcast(df) if is_small(df, width, MAX_BROADCAST_IDS, MAX_ID_BYTES) else df


def few_results(queries: DataFrame, k: int) -> bool:
    """True when k result rows for every query stay under the broadcast bound."""
    most = MAX_BROADCAST_ROWS // max(1, k)
    return queries.count() <= most


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Spread a table of few files over all cores, by the given keys.

    A file with a single row group is one task, whatever work each row makes.
    A table that is read in as many tasks as there are cores is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="rankweave-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that every executor can reach.

    The cluster names that folder in ``spark.checkpoint.dir``; only where the
    setting is absent (tests, a laptop) is a temporary folder made for it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = _own_folder()
    return f"{root.rstrip('/')}/rankweave/{name}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a written table on whatever file system holds it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(target, True))


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(target))


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    if not path_exists(spark, path):
        return []
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in fs.listStatus(target)]

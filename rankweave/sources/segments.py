"""BM25 index in append-only segments: a refresh writes only its own rows.

A saved index (``save_bm25_index``) is rewritten whole by a refresh. Here the
index is a list of segments, each written once:

- ``postings``: (term, id, tf, dl, term_bucket) of the documents it added;
- ``docs``: (id, dl) of those documents, empty ones included;
- ``tombstones``: ids whose older versions it deletes (removed or replaced);
- ``df``: its additive change of each term's document frequency - plus for
  the postings it added, minus for the live postings it killed;
- ``totals``: its change of the number of documents and of the length sum.

The reader unions the postings of all live segments without those killed by a
later tombstone, and sums the changes: the statistics are those of the
collection as it now is, and no text is read again. A small manifest lists the
segments of each version; a new version is written last, so a reader sees
either the old or the new list.

Merge policy: the first segment is the base; the ones after it are deltas.
When there are more than ``MAX_DELTAS`` deltas, they are merged into one (the
base is not touched); when the deltas together hold more than
``BASE_SHARE`` of the base's rows, everything is merged into a new base.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.functions.text import analyzer
from rankweave.operators.sparse import Bm25Index, term_bucket, term_counts
from rankweave.runtime import broadcast_ids, folders, path_exists
from rankweave.spec import Bm25Params, CollectionSpec

MAX_DELTAS = 4
BASE_SHARE = 0.25

_MANIFEST = "version long, seq long, segment string, docs long"
_OPTIONS = "text_config string, k1 double, b double, buckets int, id_type string"


@dataclass(frozen=True)
class Segment:
    seq: int
    name: str
    docs: int


def _manifest(spark: SparkSession, path: str) -> tuple[int, list[Segment]]:
    if not path_exists(spark, f"{path}/manifest"):
        return -1, []
    rows = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest").collect()
    if not rows:
        return -1, []
    version = max(r.version for r in rows)
    live = sorted((Segment(r.seq, r.segment, r.docs) for r in rows if r.version == version), key=lambda s: s.seq)
    return version, live


def _publish(spark: SparkSession, path: str, version: int, segments: list[Segment]) -> None:
    rows = [(version, s.seq, s.name, s.docs) for s in segments]
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifest")


def _options(spark: SparkSession, path: str):
    return spark.read.schema(_OPTIONS).parquet(f"{path}/options").first()


def _read(spark: SparkSession, path: str, segment: Segment, part: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{path}/segments/{segment.name}/{part}").withColumn("seq", F.lit(segment.seq).cast("long"))


def _schemas(id_type: str) -> dict[str, str]:
    return {
        "postings": f"term string, id {id_type}, tf int, dl int, term_bucket int",
        "docs": f"id {id_type}, dl int",
        "tombstones": f"id {id_type}",
        "df": "term string, df long, term_bucket int",
        "totals": "n_docs long, dl_sum long",
    }


def _all(spark: SparkSession, path: str, segments: list[Segment], part: str, id_type: str) -> DataFrame:
    schema = _schemas(id_type)[part]
    if not segments:
        return spark.createDataFrame([], schema).withColumn("seq", F.lit(0).cast("long"))
    parts = [_read(spark, path, s, part, schema) for s in segments]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def _killed(docs: DataFrame, tombstones: DataFrame) -> DataFrame:
    """(id, seq) of documents of a segment that a later segment's tombstone kills.

    Found among the documents, not the postings: one row per document.
    """
    later = tombstones.select("id", F.col("seq").alias("killed_at"))
    return docs.join(later, "id").where(F.col("killed_at") > F.col("seq")).select("id", "seq").distinct()


def _live(rows: DataFrame, killed: DataFrame) -> DataFrame:
    """Rows whose document is not killed; the killed list is broadcast when it passes the size check."""
    return rows.join(broadcast_ids(killed, "id"), ["id", "seq"], "left_anti")


def _write_rows(
    spark: SparkSession, path: str, seq: int, postings: DataFrame, docs: DataFrame, tombstones: DataFrame, id_type: str
) -> tuple[str, dict[str, DataFrame]]:
    """Write the rows of a new segment; its name and the rows as written, to count from."""
    name = f"seg-{seq:06d}-{uuid.uuid4().hex[:8]}"
    root, schemas = f"{path}/segments/{name}", _schemas(id_type)
    postings.select("term", "id", "tf", "dl", "term_bucket").sortWithinPartitions("term_bucket", "term").write.parquet(f"{root}/postings")
    docs.select("id", "dl").write.parquet(f"{root}/docs")
    tombstones.select("id").write.parquet(f"{root}/tombstones")
    parts = ("postings", "docs", "tombstones")
    return name, {part: spark.read.schema(schemas[part]).parquet(f"{root}/{part}") for part in parts}


def _write_changes(spark: SparkSession, path: str, seq: int, name: str, df: DataFrame, totals: DataFrame) -> Segment:
    """Write a segment's changes of the statistics, beside its rows."""
    root = f"{path}/segments/{name}"
    df.groupBy("term", "term_bucket").agg(F.sum("df").alias("df")).select("term", "df", "term_bucket").write.parquet(f"{root}/df")
    totals.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n_docs"), F.coalesce(F.sum("dl_sum"), F.lit(0)).alias("dl_sum")).coalesce(1).write.parquet(f"{root}/totals")
    counted = spark.read.schema("n_docs long, dl_sum long").parquet(f"{root}/totals").first()
    return Segment(seq, name, int(counted.n_docs))


def _added(docs: DataFrame, spec: CollectionSpec, params: Bm25Params, buckets: int) -> tuple[DataFrame, DataFrame]:
    """Postings and (id, dl) of new documents; the texts are read once."""
    analyze = analyzer(params.text_config)
    postings = term_counts(docs, spec, analyze).withColumn("term_bucket", term_bucket(F.col("term"), buckets))
    lengths = docs.select(F.col(spec.id).alias("id"), F.coalesce(F.size(analyze(F.col(spec.content))), F.lit(0)).cast("int").alias("dl"))
    return postings, lengths.withColumn("dl", F.greatest("dl", F.lit(0)))


def create_segmented_bm25(
    docs: DataFrame, path: str, params: Bm25Params = Bm25Params(), spec: CollectionSpec = CollectionSpec(), buckets: int = 64
) -> Bm25Index:
    """Write the base segment of a new index over all documents."""
    spark = docs.sparkSession
    id_type = docs.schema[spec.id].dataType.simpleString()
    name = params.text_config if isinstance(params.text_config, str) else None
    spark.createDataFrame([(name, params.k1, params.b, buckets, id_type)], _OPTIONS).coalesce(1).write.parquet(f"{path}/options")
    postings, lengths = _added(docs, spec, params, buckets)
    segment = _changes(spark, path, 0, postings, lengths, lengths.select("id").limit(0), [], id_type)
    _publish(spark, path, 0, [segment])
    return load_segmented_bm25(spark, path)


def _changes(spark, path, seq, postings, lengths, gone, live_segments, id_type) -> Segment:
    """Write one segment: its rows, its tombstones and the additive changes they make.

    The changes are counted from the rows just written: nothing is held in memory meanwhile.
    """
    old_docs = _all(spark, path, live_segments, "docs", id_type)
    # Removed and replaced ids; only those that an older segment holds need a tombstone.
    asked = gone.select("id").unionByName(lengths.select("id")).where(F.col("id").isNotNull())
    tombstones = asked.join(old_docs.select("id"), "id", "left_semi").distinct()
    name, rows = _write_rows(spark, path, seq, postings, lengths, tombstones, id_type)
    df = rows["postings"].groupBy("term", "term_bucket").agg(F.count("*").alias("df"))
    totals = rows["docs"].agg(F.count("*").alias("n_docs"), F.sum("dl").cast("long").alias("dl_sum"))
    if live_segments:
        dead = _killed(old_docs, _all(spark, path, live_segments, "tombstones", id_type))
        killed_docs = _live(old_docs.join(rows["tombstones"], "id", "left_semi"), dead)
        old_postings = _all(spark, path, live_segments, "postings", id_type)
        killed = old_postings.join(broadcast_ids(killed_docs.select("id", "seq"), "id"), ["id", "seq"], "left_semi")
        df = df.unionByName(killed.groupBy("term", "term_bucket").agg((-F.count("*")).alias("df")))
        totals = totals.unionByName(
            killed_docs.agg((-F.count("*")).alias("n_docs"), (-F.sum("dl")).cast("long").alias("dl_sum"))
        )
    return _write_changes(spark, path, seq, name, df, totals)


def refresh_segmented_bm25(
    path: str, removed: DataFrame, added: DataFrame, spec: CollectionSpec = CollectionSpec(), merge: bool = True
) -> Bm25Index:
    """Append a segment: ``removed`` ids go, ``added`` rows come (replacing rows of equal id).

    Only the new rows are analysed and written, with the tombstones and the
    changes of statistics; no earlier segment is rewritten. Then the merge
    policy runs, unless ``merge`` is False.
    """
    spark = added.sparkSession
    options = _options(spark, path)
    params = Bm25Params(options.text_config, options.k1, options.b)
    version, live = _manifest(spark, path)
    postings, lengths = _added(added, spec, params, options.buckets)
    gone = removed.select(F.col(spec.id).alias("id"))
    seq = max(s.seq for s in live) + 1 if live else 0
    segment = _changes(spark, path, seq, postings, lengths, gone, live, options.id_type)
    live = [*live, segment]
    _publish(spark, path, version + 1, live)
    if merge:
        merge_segments(spark, path)
    return load_segmented_bm25(spark, path)


def merge_segments(spark: SparkSession, path: str, max_deltas: int = MAX_DELTAS, base_share: float = BASE_SHARE) -> bool:
    """Apply the merge policy; True when a merge was written."""
    version, live = _manifest(spark, path)
    if len(live) < 2:
        return False
    base, deltas = live[0], live[1:]
    if sum(abs(d.docs) for d in deltas) > base_share * max(base.docs, 1):
        chosen = live
    elif len(deltas) > max_deltas:
        chosen = deltas
    else:
        return False
    merged = _merged(spark, path, live, chosen)
    keep = [s for s in live if s not in chosen]
    _publish(spark, path, version + 1, sorted([*keep, merged], key=lambda s: s.seq))
    return True


def _merged(spark: SparkSession, path: str, live: list[Segment], chosen: list[Segment]) -> Segment:
    """One segment in place of consecutive ones: their live rows, their changes summed.

    It takes the number of the last; tombstones of the chosen segments that
    still kill rows of earlier segments are kept, so nothing older revives.
    """
    options = _options(spark, path)
    id_type = options.id_type
    dead = _killed(_all(spark, path, live, "docs", id_type), _all(spark, path, live, "tombstones", id_type))
    first = chosen[0].seq
    postings = _live(_all(spark, path, chosen, "postings", id_type), dead)
    docs = _live(_all(spark, path, chosen, "docs", id_type), dead)
    kept_stones = _all(spark, path, chosen, "tombstones", id_type)
    earlier = [s for s in live if s.seq < first]
    if earlier:
        older = _all(spark, path, earlier, "docs", id_type).select("id").distinct()
        kept_stones = kept_stones.join(older, "id", "left_semi")
    else:
        kept_stones = kept_stones.limit(0)
    df = _all(spark, path, chosen, "df", id_type).select("term", "df", "term_bucket")
    totals = _all(spark, path, chosen, "totals", id_type).select("n_docs", "dl_sum")
    seq = chosen[-1].seq
    name, _ = _write_rows(spark, path, seq, postings, docs, kept_stones.select("id").distinct(), id_type)
    return _write_changes(spark, path, seq, name, df, totals)


def load_segmented_bm25(spark: SparkSession, path: str) -> Bm25Index:
    """The index as it now is: live postings of all segments, summed statistics."""
    options = _options(spark, path)
    _, live = _manifest(spark, path)
    dead = _killed(_all(spark, path, live, "docs", options.id_type), _all(spark, path, live, "tombstones", options.id_type))
    postings = _live(_all(spark, path, live, "postings", options.id_type), dead).drop("seq")
    df = _all(spark, path, live, "df", options.id_type).groupBy("term", "term_bucket").agg(F.sum("df").alias("df"))
    terms = df.where("df > 0").select("term", "df", "term_bucket")
    totals = _all(spark, path, live, "totals", options.id_type).agg(
        F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n_docs"), F.coalesce(F.sum("dl_sum"), F.lit(0)).alias("dl_sum")
    )
    stats = totals.select("n_docs", F.coalesce(F.try_divide("dl_sum", "n_docs"), F.lit(0.0)).cast("double").alias("avg_dl"))
    params = Bm25Params(options.text_config, options.k1, options.b)
    return Bm25Index(postings, terms, stats, params, analyzer(options.text_config), options.buckets)


def segment_names(spark: SparkSession, path: str) -> list[str]:
    """Live segments of the current version, oldest first."""
    return [s.name for s in _manifest(spark, path)[1]]


def written_segments(spark: SparkSession, path: str) -> list[str]:
    """All segment folders on disk, live or merged away."""
    return sorted(folders(spark, f"{path}/segments"))

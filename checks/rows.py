"""Registered queries: stored collections, readers, pair similarity, histograms."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.tables import (
    DIM,
    SQL_QRELS,
    collection,
    stored_qrels,
    sql_hash_embedding,
    table,
)
from rankweave.functions import metadata as md
from rankweave.functions.embedders import batch_embedder, hash_embedder
from rankweave.functions.text import build_content, first_part, with_prefix
from rankweave.functions.vectors import cosine_similarity, hash_embedding
from rankweave.operators.filters import MetadataFilter, apply_filter
from rankweave.operators.rows import delete_rows, merge_rows, present_rows, rows_by_id
from rankweave.plans.similarity import (
    length_histogram,
    negative_pairs,
    positive_pairs,
    sample_queries,
    similarity_histogram,
    similarity_stats,
)
from rankweave.runtime import path_exists, scratch_path
from rankweave.sources import corpora
from rankweave.sources.collection import build_collection, create_collection, open_collection, validated
from rankweave.streaming.ingest import load_stream, stream_corpus

FRENCH = MetadataFilter("lang", "fr")


def _digest(rows):
    """Stored rows in a form that both engines hash alike."""
    return rows.select(
        "id", F.md5("content").alias("content"), F.get_json_object("metadata", "$.lang").alias("lang"),
        F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x), 4).alias("total"),
    )


def _incoming(spark, sf):
    """Every chat turn as a document; turns of one chat share an id, the last counts."""
    turns = table(spark, sf, "conversations")
    return turns.select(
        F.col("conv_id").alias("id"), F.col("text").alias("content"),
        hash_embedding(F.col("text"), DIM).alias("embedding"),
        md.encode(F.col("role").alias("lang")).alias("metadata"), F.col("turn").alias("n"),
    )


def upsert(spark, sf):
    return _digest(merge_rows(collection(spark, sf), _incoming(spark, sf), "n"))


def delete_by_ids(spark, sf):
    gone = table(spark, sf, "labels").select(F.col("doc_id").alias("id"))
    return delete_rows(collection(spark, sf), gone).select("id")


def delete_by_filter(spark, sf):
    """A document without the key stays."""
    return delete_rows(collection(spark, sf), filter=MetadataFilter("quality", 1)).select("id")


def delete_by_both(spark, sf):
    gone = table(spark, sf, "labels").select(F.col("doc_id").alias("id"))
    return delete_rows(collection(spark, sf), gone, FRENCH).select("id")


def get_by_ids(spark, sf):
    """Ids of all chats; those that are no document are absent."""
    wanted = table(spark, sf, "conversations").select(F.col("conv_id").alias("id"))
    found = present_rows(rows_by_id(collection(spark, sf), wanted))
    return found.select("id", F.md5("content").alias("content"))


def stored_lifecycle(spark, sf):
    """Create, fill, replace, delete by id and by filter, reopen, read."""
    path = scratch_path(spark, "collection")
    made = create_collection(spark, path, DIM, id_type="bigint")
    made.upsert(collection(spark, sf))
    made.upsert(_incoming(spark, sf), order="n")
    made.delete(ids=table(spark, sf, "labels").where("quality = 0").select(F.col("doc_id").alias("id")))
    made.delete(filter=FRENCH)
    return _digest(open_collection(spark, path).rows())


def stored_lookup(spark, sf):
    path = scratch_path(spark, "collection")
    made = build_collection(collection(spark, sf), path, DIM, id_type="bigint")
    wanted = table(spark, sf, "labels").select(F.col("doc_id").alias("id"))
    return made.get_by_ids(wanted).select("id", F.md5("content").alias("content"))


def stored_texts(spark, sf):
    """Texts without id, vector or metadata: embedded by a batch function, then stored."""
    import pandas as pd

    def lengths(texts: pd.Series) -> pd.Series:
        return pd.Series(list(zip(texts.str.len().astype(float), texts.str.count(" ").astype(float), [1.0] * len(texts))))

    path = scratch_path(spark, "collection")
    docs = table(spark, sf, "documents").select(F.col("text").alias("content"))
    made = build_collection(docs, path, 3, batch_embedder(lengths))
    return made.rows().select(
        F.md5("content").alias("content"), (F.length("id") == 36).alias("has_id"), "metadata",
        F.element_at("embedding", 1).cast("double").alias("chars"),
        F.element_at("embedding", 2).cast("double").alias("spaces"),
    )


def stored_repeats(spark, sf):
    """Chat turns as texts of one id a chat, spread over tasks to be embedded: the last row of an id counts."""
    turns = table(spark, sf, "conversations").orderBy("conv_id", "turn")
    docs = turns.select(F.col("conv_id").alias("id"), F.col("text").alias("content"))
    made = build_collection(docs, scratch_path(spark, "collection"), DIM, hash_embedder(DIM), id_type="bigint", partitions=3)
    return made.rows().select("id", F.md5("content").alias("content"))


def stored_compacted(spark, sf):
    """The lifecycle's changes again, then one version of them: the same rows."""
    made = build_collection(collection(spark, sf), scratch_path(spark, "collection"), DIM, id_type="bigint")
    made.upsert(_incoming(spark, sf), order="n")
    made.delete(ids=table(spark, sf, "labels").where("quality = 0").select(F.col("doc_id").alias("id")))
    made.compact()
    return _digest(made.rows())


def dropped(spark, sf):
    """What is left where a collection was dropped, and how many rows a new one has."""
    path = scratch_path(spark, "collection")
    made = build_collection(collection(spark, sf), path, DIM, id_type="bigint")
    held = made.rows().count()
    made.drop()
    left = path_exists(spark, path)
    again = create_collection(spark, path, DIM, id_type="bigint").rows()
    return again.agg(F.count("*").alias("n")).select(
        F.lit(held).cast("bigint").alias("held"), F.lit(left).alias("left_over"), "n"
    )


def open_without_metadata(spark, sf):
    """A table without the metadata column serves as a collection."""
    docs = collection(spark, sf).drop("metadata")
    return validated(docs).select("id", F.col("metadata").isNull().alias("missing"))


# -- functions -----------------------------------------------------------


def metadata_typed(spark, sf):
    """Metadata with the types of its values."""
    docs = collection(spark, sf).withColumn("typed", md.decode_typed(F.col("metadata")))
    return docs.select(
        "id", F.try_variant_get("typed", "$.n_chars", "bigint").alias("n_chars"),
        F.try_variant_get("typed", "$.tags[1]", "string").alias("tag"),
        F.regexp_replace(F.schema_of_variant(F.variant_get("typed", "$.lang", "variant")), "STRING.*", "STRING").alias("kind"),
    )


def filter_star_key(spark, sf):
    """A key that is a path's wildcard names a field like any other."""
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), md.encode(F.col("lang").alias("*"), "source").alias("metadata"))
    return apply_filter(docs, MetadataFilter("*", "de")).select("id")


def content_assembly(spark, sf):
    docs = table(spark, sf, "documents")
    content = build_content(F.col("text"), F.col("source"))
    return docs.select("doc_id", F.md5(content).alias("content"), F.length(content).cast("bigint").alias("n"),
                       F.md5(build_content(F.col("text"), F.col("source"), 8000)).alias("cut"))


def text_functions(spark, sf):
    docs = table(spark, sf, "documents")
    label = F.concat("lang", F.lit(" - "), "source")
    return docs.select(
        "doc_id", first_part(label).alias("domain"), F.md5(with_prefix(F.col("text"))).alias("prefixed"),
        F.length("text").cast("bigint").alias("n"),
    )


def metadata_decode(spark, sf):
    docs = collection(spark, sf).select("id", md.decode(F.col("metadata")).alias("m"))
    return docs.select("id", F.col("m")["lang"].alias("lang"), F.col("m")["n_chars"].cast("bigint").alias("n_chars"),
                       F.col("m")["quality"].cast("int").alias("quality"))


def metadata_fields(spark, sf):
    m = F.col("metadata")
    return collection(spark, sf).select(
        "id", md.field_text(m, "source").alias("source"), md.field_number(m, "n_chars").alias("n_chars"),
        F.element_at(md.field_array(m, "tags"), 1).alias("tag"),
    )


# -- readers: the given tables written in each format, then read back -----


def _corpus(spark, sf):
    return table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("docid"), F.col("source").alias("title"), "text"
    )


def read_corpus_jsonl(spark, sf):
    path = scratch_path(spark, "corpus")
    _corpus(spark, sf).repartition(4).write.json(path)
    rows = corpora.corpus_to_documents(corpora.read_corpus_jsonl(spark, f"{path}/part-*.json"))
    return rows.select("id", F.md5("content").alias("content"), F.get_json_object("metadata", "$.title").alias("title"))


def read_corpus_parquet(spark, sf):
    path = scratch_path(spark, "corpus")
    _corpus(spark, sf).withColumnRenamed("docid", "_id").write.parquet(path)
    rows = corpora.read_corpus_parquet(spark, path)
    return rows.select("docid", "title", F.md5("text").alias("text"))


def read_queries_gz(spark, sf):
    path = scratch_path(spark, "queries")
    items = table(spark, sf, "benchmark").select(F.col("item_id").cast("string").alias("query_id"), F.col("text").alias("query"))
    items.write.option("compression", "gzip").json(path)
    return corpora.read_queries_jsonl(spark, path)


def read_queries_parquet(spark, sf):
    path = scratch_path(spark, "queries")
    table(spark, sf, "benchmark").select(F.col("item_id").cast("string").alias("_id"), "text").write.parquet(path)
    return corpora.read_queries_parquet(spark, path)


def read_topics(spark, sf):
    """Topics with a line break in the query lose what is behind it: one line, one topic."""
    path = scratch_path(spark, "topics")
    items = table(spark, sf, "benchmark")
    one_line = F.regexp_replace("text", r"\s+", " ")
    items.select(F.concat_ws("\t", "item_id", one_line)).write.text(path)
    return corpora.read_topics_tsv(spark, path)


def _qrels_file(spark, sf):
    path = scratch_path(spark, "qrels")
    labels = table(spark, sf, "labels")
    grade = F.col("quality") + F.col("toxic")
    labels.select(F.concat_ws("\t", F.col("quality").cast("string"), F.lit("0"), F.col("doc_id").cast("string"), grade.cast("string"))).write.text(path)
    return path


def read_qrels(spark, sf):
    return corpora.read_qrels_tsv(spark, _qrels_file(spark, sf))


def read_qrels_graded(spark, sf):
    return corpora.read_qrels_tsv(spark, _qrels_file(spark, sf), graded=True)


def read_qrels_parquet(spark, sf):
    path = scratch_path(spark, "qrels")
    labels = table(spark, sf, "labels")
    pairs = labels.select(F.col("quality").cast("string").alias("query-id"), F.col("doc_id").cast("string").alias("corpus-id"))
    pairs.write.parquet(path)
    return corpora.read_qrels_parquet(spark, path)


def stream_ingest(spark, sf):
    """A folder of shards, read as a stream and upserted batch by batch."""
    source = scratch_path(spark, "shards")
    _corpus(spark, sf).repartition(6).write.json(source)
    made = create_collection(spark, scratch_path(spark, "collection"), DIM)
    stream = load_stream(
        stream_corpus(spark, source, files_per_batch=3), made, hash_embedder(DIM), scratch_path(spark, "offsets")
    )
    stream.awaitTermination()
    return made.rows().select("id", F.md5("content").alias("content"))


# -- similarity of pairs --------------------------------------------------


def _similarities(spark, sf):
    pairs = stored_qrels(spark, sf)
    items = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    docs = table(spark, sf, "documents").select("doc_id", "text")
    sample = sample_queries(pairs, items)
    chosen = positive_pairs(sample, pairs).withColumn("kind", F.lit("positive")).unionByName(
        negative_pairs(sample, pairs, docs).withColumn("kind", F.lit("negative"))
    )
    asked = items.select("query_id", hash_embedding(with_prefix(F.col("text")), DIM).alias("a"))
    held = docs.join(chosen, "doc_id").select("query_id", "doc_id", "kind", hash_embedding(F.col("text"), DIM).alias("b"))
    joined = held.join(asked, "query_id")
    return joined.select("query_id", "doc_id", "kind", cosine_similarity(F.col("a"), F.col("b")).alias("similarity"))


def similarity_pairs(spark, sf):
    return _similarities(spark, sf).withColumn("similarity", F.round("similarity", 6))


def pair_stats(spark, sf):
    stats = similarity_stats(_similarities(spark, sf))
    return stats.select("kind", *[F.round(c, 6).alias(c) for c in ("mean", "std", "min", "max")])


def pair_histogram(spark, sf):
    return similarity_histogram(_similarities(spark, sf))


def text_lengths(spark, sf):
    return length_histogram(table(spark, sf, "documents"), "text")


# -- SQL -----------------------------------------------------------------


def _unit(digest: str) -> str:
    raw = sql_hash_embedding(digest)
    return f"(SELECT list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y))))::FLOAT[] FROM (SELECT {raw} AS v))"


_SQL_BASE = f"""
base AS (SELECT d.doc_id AS id, d.text AS content, d.lang, coalesce(e.embedding, {_unit('sha256(d.text)')}) AS embedding
         FROM documents d LEFT JOIN embeddings e ON e.vec_id = d.doc_id),
newest AS (SELECT conv_id AS id, text AS content, role AS lang FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS n FROM conversations) WHERE n = 1),
incoming AS (SELECT id, content, lang, {_unit('sha256(content)')} AS embedding FROM newest),
merged AS (SELECT * FROM base WHERE id NOT IN (SELECT id FROM incoming) UNION ALL
           SELECT id, content, lang, embedding FROM incoming)"""
_SQL_DIGEST = "id, md5(content) AS content, lang, round(list_sum(embedding::DOUBLE[]), 4) + 0e0 AS total"

_SQL_PAIRS = f"""{SQL_QRELS},
sample AS (SELECT DISTINCT query_id FROM qrels),
rel AS (SELECT * FROM qrels WHERE query_id IN (SELECT query_id FROM sample)),
counts AS (SELECT query_id, count(*) AS n_rel FROM rel GROUP BY query_id),
listed AS (SELECT doc_id, row_number() OVER (ORDER BY md5(doc_id || ':42'), doc_id) - 1 AS place FROM documents),
tries AS (SELECT query_id, step,
            ((('0x' || substr(md5(query_id || ':42'), 1, 8))::BIGINT + step) % (SELECT count(*) FROM listed)) AS place
          FROM (SELECT query_id, unnest(range(0, n_rel + 1)) AS step FROM counts)),
negative AS (SELECT query_id, arg_min(doc_id, step) AS doc_id FROM tries JOIN listed USING (place)
             WHERE (query_id, doc_id) NOT IN (SELECT query_id, doc_id FROM rel) GROUP BY query_id),
chosen AS (SELECT query_id, min(doc_id) AS doc_id, 'positive' AS kind FROM rel GROUP BY query_id
           UNION ALL SELECT query_id, doc_id, 'negative' FROM negative),
sims AS (SELECT query_id, chosen.doc_id, kind,
           list_cosine_similarity({_unit("sha256('Query: ' || b.text)")}::DOUBLE[], {_unit('sha256(d.text)')}::DOUBLE[]) AS similarity
         FROM chosen JOIN benchmark b ON b.item_id = query_id JOIN documents d ON d.doc_id = chosen.doc_id)"""

QUERIES = {
    "upsert": upsert,
    "delete_by_ids": delete_by_ids,
    "delete_by_filter": delete_by_filter,
    "delete_by_both": delete_by_both,
    "get_by_ids": get_by_ids,
    "stored_lifecycle": stored_lifecycle,
    "stored_lookup": stored_lookup,
    "stored_texts": stored_texts,
    "stored_repeated_ids": stored_repeats,
    "stored_compacted": stored_compacted,
    "collection_dropped": dropped,
    "open_without_metadata": open_without_metadata,
    "metadata_typed": metadata_typed,
    "filter_star_key": filter_star_key,
    "content_assembly": content_assembly,
    "text_functions": text_functions,
    "metadata_decode": metadata_decode,
    "metadata_fields": metadata_fields,
    "read_corpus_jsonl": read_corpus_jsonl,
    "read_corpus_parquet": read_corpus_parquet,
    "read_queries_gz": read_queries_gz,
    "read_queries_parquet": read_queries_parquet,
    "read_topics": read_topics,
    "read_qrels": read_qrels,
    "read_qrels_graded": read_qrels_graded,
    "read_qrels_parquet": read_qrels_parquet,
    "stream_ingest": stream_ingest,
    "similarity_pairs": similarity_pairs,
    "similarity_stats": pair_stats,
    "similarity_histogram": pair_histogram,
    "length_histogram": text_lengths,
}

ORACLE = {
    "upsert": f"WITH {_SQL_BASE} SELECT {_SQL_DIGEST} FROM merged",
    "delete_by_ids": "SELECT doc_id AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "delete_by_filter": """SELECT doc_id AS id FROM documents
      WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)""",
    "delete_by_both": """SELECT doc_id AS id FROM documents
      WHERE NOT (lang = 'fr' AND doc_id IN (SELECT doc_id FROM labels))""",
    "get_by_ids": """SELECT doc_id::VARCHAR AS id, md5(text) AS content FROM documents
      WHERE doc_id IN (SELECT conv_id FROM conversations)""",
    "stored_lifecycle": f"""WITH {_SQL_BASE} SELECT {_SQL_DIGEST} FROM merged
      WHERE id NOT IN (SELECT doc_id FROM labels WHERE quality = 0) AND lang <> 'fr'""",
    "stored_lookup": """SELECT doc_id::VARCHAR AS id, md5(text) AS content FROM documents
      WHERE doc_id IN (SELECT doc_id FROM labels)""",
    "stored_texts": """SELECT md5(text) AS content, TRUE AS has_id, '{}' AS metadata, length(text)::DOUBLE AS chars,
      (length(text) - length(replace(text, ' ', '')))::DOUBLE AS spaces FROM documents""",
    "stored_repeated_ids": """SELECT conv_id AS id, md5(text) AS content FROM conversations
      QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1""",
    "stored_compacted": f"""WITH {_SQL_BASE} SELECT {_SQL_DIGEST} FROM merged
      WHERE id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)""",
    "collection_dropped": "SELECT count(*) AS held, FALSE AS left_over, 0::BIGINT AS n FROM documents",
    "metadata_typed": "SELECT doc_id AS id, n_chars, source AS tag, 'STRING' AS kind FROM documents",
    "filter_star_key": "SELECT doc_id AS id FROM documents WHERE lang = 'de'",
    "open_without_metadata": "SELECT doc_id AS id, TRUE AS missing FROM documents",
    "content_assembly": """SELECT doc_id, md5(source || chr(10) || text) AS content,
      length(source || chr(10) || text) AS n, md5(substr(source || chr(10) || text, 1, 8000)) AS cut FROM documents""",
    "text_functions": """SELECT doc_id, lang AS domain, md5('Query: ' || text) AS prefixed, length(text) AS n FROM documents""",
    "metadata_decode": """SELECT d.doc_id AS id, lang, n_chars, quality FROM documents d
      LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "metadata_fields": "SELECT doc_id AS id, source, n_chars::DOUBLE AS n_chars, lang AS tag FROM documents",
    "read_corpus_jsonl": """SELECT doc_id::VARCHAR AS id, md5(source || chr(10) || text) AS content, source AS title
      FROM documents""",
    "read_corpus_parquet": "SELECT doc_id::VARCHAR AS docid, source AS title, md5(text) AS text FROM documents",
    "read_queries_gz": "SELECT item_id::VARCHAR AS query_id, text AS query_text FROM benchmark",
    "read_queries_parquet": "SELECT item_id::VARCHAR AS query_id, text AS query_text FROM benchmark",
    "read_topics": r"""SELECT item_id::VARCHAR AS query_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS query_text
      FROM benchmark""",
    "read_qrels": """SELECT DISTINCT quality::VARCHAR AS query_id, doc_id::VARCHAR AS doc_id FROM labels
      WHERE quality + toxic = 1""",
    "read_qrels_graded": """SELECT DISTINCT quality::VARCHAR AS query_id, doc_id::VARCHAR AS doc_id FROM labels
      WHERE quality + toxic >= 1""",
    "read_qrels_parquet": "SELECT DISTINCT quality::VARCHAR AS query_id, doc_id::VARCHAR AS doc_id FROM labels",
    "stream_ingest": """SELECT doc_id::VARCHAR AS id, md5(source || chr(10) || text) AS content
      FROM documents""",
    "similarity_pairs": f"WITH {_SQL_PAIRS} SELECT query_id, doc_id, kind, round(similarity, 6) + 0e0 AS similarity FROM sims",
    "similarity_stats": f"""WITH {_SQL_PAIRS} SELECT kind, round(avg(similarity), 6) + 0e0 AS mean,
      round(stddev_pop(similarity), 6) AS std, round(min(similarity), 6) + 0e0 AS min,
      round(max(similarity), 6) + 0e0 AS max FROM sims GROUP BY kind""",
    "similarity_histogram": f"""WITH {_SQL_PAIRS}
      SELECT kind, least(floor(similarity * 49)::INTEGER + 1, 49) AS bin, count(*) AS n FROM sims
      WHERE similarity BETWEEN 0 AND 1 GROUP BY kind, bin""",
    "length_histogram": """WITH lens AS (SELECT length(text) AS len FROM documents),
      ends AS (SELECT min(len)::DOUBLE AS low, max(len)::DOUBLE AS high FROM lens)
      SELECT least(floor((len - low) / (high - low) * 10)::INTEGER + 1, 10) AS bin, count(*) AS n
      FROM lens, ends GROUP BY bin""",
}

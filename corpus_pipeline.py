"""From raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before
kept; ``run`` writes each result as Parquet and reads it back.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankweave.llm.common import stored, table
from rankweave.llm.decontaminate import contamination
from rankweave.llm.ngram_join import ngram_join
from rankweave.llm.packing import pack
from rankweave.llm.pii import find_personal_data, sanitised
from rankweave.llm.quality import kept, train
from rankweave.runtime import is_small

TOKENIZER = "word_bpe_49k.json"
# Ids (8 bytes each) up to which a list of documents is broadcast.
MAX_IDS = 2_000_000


def _side(ids: DataFrame) -> DataFrame:
    small = is_small(ids, max_rows=MAX_IDS, max_bytes=64 * MAX_IDS)
    return F.broadcast(ids) if small else ids


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls good; it is fitted on the labelled ones of the input."""
    return kept(docs, train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id.

    Of rows of equal doc_id and text one stays. Documents without an id have no
    smallest one in their group and stay.
    """
    groups = stored(ngram_join(docs), "groups")
    gone = groups.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    left = docs.join(_side(gone), "doc_id", "left_anti").select(*docs.columns)
    again = groups.where(F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1").select("doc_id")
    again = _side(stored(again, "repeated-ids"))
    once = left.join(again, "doc_id", "left_anti").select(*docs.columns)
    repeated = left.join(again, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id", "text"])
    return once.unionByName(repeated)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which fewer than one word in twenty stands in a benchmark passage."""
    judged = contamination(docs, table(spark, sf_dir, "benchmark")).where("contaminated")
    hit = stored(judged.select("doc_id").where(F.col("doc_id").isNotNull()).distinct(), "contaminated")
    return docs.join(_side(hit), "doc_id", "left_anti").select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data, and terms that give it away, replaced."""
    out = sanitised(docs, find_personal_data(docs))
    if "n_chars" in docs.columns:
        counted = F.when(F.col("text").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType))
        out = out.withColumn("n_chars", F.coalesce(counted, "n_chars"))
    return out


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens."""
    return pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


# Trained scores, dual prices and token ids are not SQL; the tests hold the stages against brute force.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}

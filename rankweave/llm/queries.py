"""Registered queries of the operators, over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .common import table
from .conversation_repair import repair
from .exact_topk import exact_topk
from .spelling_variants import spelling_variants
from .decontaminate import LOWER, PATTERN, UPPER, contamination
from .fingerprint import edited_pairs
from .html_crf import extract, trained
from .ngram_join import ngram_join
from .packing import pack
from .pii import digest, find_personal_data
from .quality import is_held_out, score, train
from .suffix_dedup import remove_repeats
from .token_store import read_tokens, write_token_files
from .warc import read_archives, write_archives


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", is_held_out().alias("held_out"), "score", "predicted")


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"), trained())


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(find_personal_data(table(spark, sf_dir, "documents")))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_archives(write_archives(table(spark, sf_dir, "pages")))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return read_tokens(spark, write_token_files(table(spark, sf_dir, "documents"), tokenizer))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_pairs(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(table(spark, sf_dir, "conversations"))


def op12_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk(table(spark, sf_dir, "embeddings"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{PATTERN}')"

QUERIES = {f.__name__: f for f in (op1_ngram_join, op2_quality, op3_main_text, op4_packing, op5_personal_data, op6_warc, op7_repeats, op8_token_ids, op9_fingerprints, op10_decontamination, op11_conversation_repair, op12_exact_topk, op13_spelling_variants)}
_NGRAM = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+')"

ORACLE: dict[str, str] = {
    "op1_ngram_join": f"""
WITH RECURSIVE d AS (SELECT doc_id, {_NGRAM} AS w FROM documents),
cut AS (SELECT DISTINCT doc_id, w[s:s + 4] AS g
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS s FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM cut GROUP BY doc_id),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM cut a JOIN cut b USING (g)
         WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM met JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
          WHERE 100 * k >= 75 * (x.n + y.n - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) LEFT JOIN n USING (doc_id)""",
    "op6_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
FROM f""",
    "op10_decontamination": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
cut AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM i WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, w[s:s + 12] AS held FROM cut),
lengths AS (SELECT DISTINCT len(held) AS n FROM windows),
places AS (SELECT doc_id, n, w, unnest(range(1, greatest(len(w) - n + 1, 0) + 1)) AS s FROM d, lengths),
runs AS (SELECT doc_id, n, s, w[s:s + n - 1] AS held FROM places),
met AS (SELECT doc_id, n, s, item_id FROM runs JOIN windows USING (held)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM met) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                 sha256(string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS items_sha256
          FROM met GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op12_exact_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS w FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
q AS (SELECT * FROM v WHERE vec_id % 50 = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
             list_sum(list_transform(list_zip(q.w, c.w), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0)))::BIGINT AS score
      FROM q JOIN v c ON c.vec_id <> q.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5""",
}

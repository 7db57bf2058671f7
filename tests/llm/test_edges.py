"""Nulls, empty and long texts, repeated rows, empty tables and clashing column names."""

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from rankweave.llm import decontaminate, fingerprint, html_crf, ngram_join, packing, pii, quality, suffix_dedup, token_store, warc

WORDS = "amber brook cedar delta ember fjord grove heath inlet jetty knoll lagoon marsh north ocean".split()
LONG = " ".join(WORDS[i % 15] + str(i % 977) for i in range(40_000))
SHARED = " ".join(f"{w} shared passage of some words" for w in WORDS)
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
# Names that the operators use themselves.
CLASHING = "row key value term pos window part hash spans n rank class tokens text2 component _k ids base".split()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, None), (2, ""), (3, "   \n\t"), (4, "one"), (4, "one"), (5, LONG), (6, SHARED), (7, SHARED),
        (None, "no id here but words enough for a shingle"), (None, None), (8, "mail a.b@c.example.org and +1 (555) 010-9999"),
    ]
    made = spark.createDataFrame(rows, "doc_id long, text string")
    return made.select("*", *[F.lit(None).cast("string").alias(c) for c in CLASHING])


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, extra string")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "shared passage of some words"), (2, None), (3, ""), (None, "one")], "item_id long, text string")


def test_ngram_join(docs, none):
    got = sorted(ngram_join.ngram_join(docs).collect(), key=repr)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id))
    assert len(got) == 11
    assert by[1] == [(0, 1)] and by[2] == [(0, 2)] and by[3] == [(0, 3)] and by[4] == [(1, 4), (1, 4)]
    assert by[6][0][1] == 6 and by[7][0][1] == 6 and by[5][0] == (len(set(zip(*[LONG.split()[i:] for i in range(5)]))), 5)
    assert sorted(by[None]) == [(0, None), (5, None)]
    assert ngram_join.ngram_join(none).collect() == []


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(6, 1), (5, 0), (None, 1), (4, None)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    got = quality.score(docs, model).collect()
    assert len(got) == 11 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert quality.score(none, model).collect() == []
    empty = quality.train(none, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in quality.score(docs, empty).collect()} == {0.5}
    assert quality.kept(docs, model).columns == docs.columns


def test_packing(docs, none):
    got = packing.pack(docs, TOKENIZER).collect()
    assert sum(r.length for r in got) == sum(
        r.doc_tokens for r in got if r.start == 0
    )
    spans = {}
    for r in got:
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in spans.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= packing.LENGTH
    assert len([r for r in got if r.start == 0]) == 11
    assert packing.pack(none, TOKENIZER).collect() == []


def test_personal_data(docs, none):
    got = pii.digest(pii.find_personal_data(docs)).collect()
    assert len(got) == 11
    empty = hashlib.sha256(b"").hexdigest()
    row = next(r for r in got if r.doc_id == 8)
    assert (row.n_email, row.n_phone, row.spans) == (1, 1, "email:5:22,phone:27:44")
    assert all(r.base_sha256 == empty and r.spans == "" for r in got if r.doc_id != 8)
    clean = pii.sanitised(docs, pii.find_personal_data(docs))
    assert clean.columns == docs.columns and clean.count() == 11
    assert clean.where("doc_id = 8").first().text == "mail [email] and [phone]"
    assert clean.where("doc_id = 1").first().text is None
    assert pii.find_personal_data(none).collect() == []


def test_repeats(docs, none):
    got = {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.remove_repeats(docs).collect()}
    n = len(SHARED)
    assert {(6, n, n, 1), (7, n, n, 1), (1, 0, 0, 0), (2, 0, 0, 0), (4, 3, 0, 0), (None, 0, 0, 0)} <= got
    assert suffix_dedup.remove_repeats(none).collect() == []


def test_token_files(spark, docs, none):
    got = token_store.read_tokens(spark, token_store.write_token_files(docs, TOKENIZER)).orderBy("start").collect()
    assert len(got) == 11 and [r.doc_id for r in got[:2]] == [None, None]
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(11)]
    assert token_store.read_tokens(spark, token_store.write_token_files(none, TOKENIZER)).collect() == []


def test_fingerprints(spark, docs, none):
    got = fingerprint.edited_pairs(docs).collect()
    assert len(got) == 11
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[6].fingerprint == by[7].fingerprint and by[6].near_next == 1.0
    assert by[1].fingerprint == "" and by[1].near_edited == 1.0
    assert fingerprint.edited_pairs(none).collect() == []
    single = spark.createDataFrame([(9, SHARED)], "doc_id long, text string")
    assert fingerprint.edited_pairs(single).first().near_next == 1.0


def test_decontamination(spark, docs, none, benchmark):
    got = {(r.doc_id, r.n_words): r for r in decontaminate.contamination(docs, benchmark).collect()}
    assert got[6, 90].n_hit == 75 and got[6, 90].contaminated and got[6, 90].n_items == 1
    assert got[4, 1].contaminated and got[4, 1].items_sha256 == hashlib.sha256(b"").hexdigest()
    assert not got[1, 0].contaminated and got[1, 0].n_items == 0
    assert decontaminate.contamination(docs, none.select(F.col("doc_id").alias("item_id"), "text")).where("contaminated").count() == 0
    assert decontaminate.contamination(none, benchmark).collect() == []


def test_main_text(spark):
    rows = [(1, None, None), (1, None, None), (2, "u", ""), (None, "u", "<p>unclosed &amp; <b>bold"), (3, "u", "<" * 5000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x"))
    model = html_crf.trained(60)
    got = html_crf.extract(pages, model).collect()
    assert len(got) == 5 and all(r.n_chars == len(r.text) for r in got)
    assert [r.text for r in got if r.page_id in (1, 2)] == ["", "", ""]
    assert html_crf.extract(pages.limit(0), model).collect() == []


def test_archives(spark):
    body = "x" * 150
    rows = [(5, "u", body), (2, None, body), (2, "again", body), (None, "u", body), (7, "u", "short"), (8, "u", "short"), (9, "u", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    got = warc.read_archives(warc.write_archives(pages)).collect()
    kinds = sorted(((r.page_id, r.record_type, r.refers_to) for r in got), key=repr)
    assert kinds == sorted([
        (2, "response", None), (2, "revisit", 2), (5, "revisit", 2), (None, "revisit", 2),
        (7, "response", None), (8, "response", None), (9, "response", None),
    ], key=repr)
    assert warc.read_archives(warc.write_archives(pages.limit(0))).collect() == []

"""Registered queries of the operators next to their SQL, and the pipeline's stages against plain versions."""

import re

import pytest

import corpus_pipeline
from checks.compare import compare, duck
from rankweave.llm import quality
from rankweave.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_and_sql(spark, name):
    verdict, _, _ = compare(spark, duck(SF), SF, QUERIES[name], ORACLE[name])
    assert verdict.startswith("ok"), verdict


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        out.append((docs, docs := corpus_pipeline.stored(stage(spark, docs, SF), "test-stage")))
    return out


def test_quality_keeps_what_scores_well(spark, stages):
    docs, left = stages[0]
    model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r.doc_id for r in quality.score(docs, model).collect() if r.score >= quality.GOOD}
    assert {r.doc_id for r in left.collect()} == good and left.columns == docs.columns


def _shingles(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_one_of_each_group_stays(stages):
    docs, left = stages[1]
    sets = {r.doc_id: _shingles(r.text) for r in docs.collect()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sorted(sets):
        for b in sorted(sets):
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert {r.doc_id for r in left.collect()} == {i for i in sets if find(i) == i}


def _words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_contaminated_documents_go(spark, stages):
    docs, left = stages[2]
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = _words(r.text)
        windows |= {tuple(w[i:i + 13]) for i in range(max(1, len(w) - 12))} if w else set()
    sizes, clean = {len(w) for w in windows}, set()
    for r in docs.collect():
        w = _words(r.text)
        hit = {p for n in sizes for i in range(len(w) - n + 1) if tuple(w[i:i + n]) in windows for p in range(i, i + n)}
        if not hit or 20 * len(hit) < len(w):
            clean.add(r.doc_id)
    assert {r.doc_id for r in left.collect()} == clean


def test_personal_data_is_gone(stages):
    docs, left = stages[3]
    before = {r.doc_id: r.text for r in docs.collect()}
    for r in left.collect():
        assert "@" not in before[r.doc_id] or not re.search(r"[a-z0-9]@[a-z0-9]+\.[a-z]", r.text)
        if not re.search("[0-9]{2}|@", before[r.doc_id]):
            assert r.text == before[r.doc_id]
        assert r.n_chars == len(r.text)
    assert len(before) == left.count()


def test_every_document_is_packed(stages):
    docs, pieces = stages[4]
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in docs.collect()}

"""BM25 in append-only segments: refreshes write only their rows, merges keep the statistics."""

import os

import pytest
from pyspark.sql import functions as F

from rankweave.operators.sparse import build_bm25_index
from rankweave.runtime import scratch_path
from rankweave.sources import segments as sg
from rankweave.spec import Bm25Params


def _docs(spark, rows):
    return spark.createDataFrame(rows, "id long, content string, metadata string")


def _bytes(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(folder) for f in fs)


def _state(index):
    postings = sorted(tuple(r) for r in index.postings.select("term", "id", "tf", "dl").collect())
    terms = sorted(tuple(r) for r in index.terms.select("term", "df").collect())
    n_docs, avg = index.stats.select("n_docs", "avg_dl").first()
    return postings, terms, n_docs, round(avg, 9)


def _plain(spark, rows):
    return _state(build_bm25_index(_docs(spark, rows), Bm25Params("simple")))


BASE = [(i, f"word{i % 7} common text {'long ' * (i % 5)}", "{}") for i in range(400)] + [(1000, None, "{}"), (1001, "", "{}")]


def test_refresh_writes_only_its_rows(spark):
    path = scratch_path(spark, "segments-test")
    sg.create_segmented_bm25(_docs(spark, BASE), path, Bm25Params("simple"), buckets=4)
    base = sg.written_segments(spark, path)
    local = path.removeprefix("file:")
    before = {name: _bytes(f"{local}/segments/{name}") for name in base}
    added = [(5, "replaced five", "{}"), (2000, "brand new", "{}")]
    index = sg.refresh_segmented_bm25(path, _docs(spark, [(7, None, "{}"), (1000, None, "{}")]), _docs(spark, added), merge=False)
    after = sg.written_segments(spark, path)
    new = [n for n in after if n not in base]
    assert len(new) == 1 and {n: _bytes(f"{local}/segments/{n}") for n in base} == before
    # The new segment holds its two documents; the base's postings are not written again.
    assert _bytes(f"{local}/segments/{new[0]}/postings") < before[base[0]] / 4
    want = [r for r in BASE if r[0] not in (5, 7, 1000)] + added
    assert _state(index) == _plain(spark, want)


def test_many_refreshes_then_merges(spark):
    path = scratch_path(spark, "segments-test")
    rows = {r[0]: r for r in BASE}
    sg.create_segmented_bm25(_docs(spark, list(rows.values())), path, Bm25Params("simple"), buckets=4)
    steps = [
        ([3], [(3, "back again", "{}"), (4, "four changed", "{}")]),
        ([3], []),
        ([], [(3, "three once more", "{}"), (3000, None, "{}")]),
        ([9, 3000], [(9, "nine", "{}")]),
        ([], [(4, "four twice", "{}")]),
        ([10, 11], []),
    ]
    for removed, added in steps:
        for i in removed:
            rows.pop(i, None)
        for r in added:
            rows[r[0]] = r
        gone = spark.createDataFrame([(i,) for i in removed], "id long")
        index = sg.refresh_segmented_bm25(path, gone, _docs(spark, added), merge=False)
        assert _state(index) == _plain(spark, list(rows.values()))
    assert len(sg.segment_names(spark, path)) == 7
    assert sg.merge_segments(spark, path)  # six deltas: folded into one, the base stays
    live = sg.segment_names(spark, path)
    assert len(live) == 2 and live[0] == sg.written_segments(spark, path)[0]
    assert _state(sg.load_segmented_bm25(spark, path)) == _plain(spark, list(rows.values()))
    assert sg.merge_segments(spark, path, base_share=0.0)  # everything into a new base
    assert len(sg.segment_names(spark, path)) == 1
    assert _state(sg.load_segmented_bm25(spark, path)) == _plain(spark, list(rows.values()))
    assert not sg.merge_segments(spark, path)


def test_empty_collection(spark):
    path = scratch_path(spark, "segments-test")
    empty = _docs(spark, [])
    index = sg.create_segmented_bm25(empty, path, Bm25Params("simple"))
    assert index.postings.count() == 0 and index.stats.first().n_docs == 0
    index = sg.refresh_segmented_bm25(path, empty.select("id"), _docs(spark, [(1, "a b", "{}")]))
    assert _state(index) == _plain(spark, [(1, "a b", "{}")])

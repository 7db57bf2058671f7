"""op9_fingerprints, every column, against a plain walk over the documents in doc_id order."""

import hashlib

import numpy as np
import pytest

from rankweave.llm import fingerprint as fp
from rankweave.llm.common import shingle_hashes
from rankweave.llm.queries import op9_fingerprints

SF = "/root/testdata/sf0.001"


def _plain(rows):
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0, r[1]))
    out = {}
    for i, (doc_id, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, new, nxt = (fp.sketches([x])[0] for x in (text, edited, after))
        out[doc_id] = (
            len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), fp._encoded(own),
            fp._encoded(new), fp.resemblance(own, new), fp.resemblance(own, nxt),
        )
    return out


def _jaccard(a, b):
    sa, sb = (set(shingle_hashes([x.encode()])[0].tolist()) for x in (a, b))
    return len(sa & sb) / len(sa | sb) if sa | sb else 1.0


def test_every_column_of_the_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = _plain([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    got = {r.doc_id: tuple(r)[1:] for r in op9_fingerprints(spark, SF).collect()}
    assert got.keys() == want.keys()
    for doc_id, row in want.items():
        assert got[doc_id][:4] == row[:4], doc_id
        assert got[doc_id][4] == pytest.approx(row[4]) and got[doc_id][5] == pytest.approx(row[5]), doc_id


def test_estimates_follow_the_true_resemblance(spark):
    rows = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    errors = []
    for (_, a), (_, b) in zip(rows, rows[1:]):
        half = len(a) // 2
        edited = a[: len(a) - half] + b[:half]
        estimate = fp.resemblance(fp.sketches([a])[0], fp.sketches([edited])[0])
        errors.append(abs(estimate - _jaccard(a, edited)))
    assert np.mean(errors) < 0.05 and max(errors) < 0.25

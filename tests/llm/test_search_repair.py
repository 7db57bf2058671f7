"""Conversation repair, exact top-k and spelling variants against brute force."""

import hashlib
import heapq
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankweave.llm import conversation_repair as cr
from rankweave.llm import exact_topk as xt
from rankweave.llm import spelling_variants as sv

SF = "/root/testdata/sf0.01"
CLASHING = "range sub block seed h run word length cell asks _c _turn _role _text v n2 n".split()


def _clashing(df):
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in CLASHING if c not in df.columns])


# -- op11 -----------------------------------------------------------------------


def _damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        key = f"{conv if conv is not None else ' '}:{turn if turn is not None else ' '}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub(r"[.!?]", "", text)
        elif kind == 4:
            role = "user"
        out.extend([(conv, turn, role, text)] * (2 if kind == 3 else 1))
    return out


def _plain_search(initials, faults):
    """Uniform-cost search ordered by (cost, script): the least script of least cost."""
    heap = [(0, "", 0, 0, ())]
    while heap:
        cost, script, i, state, roles = heapq.heappop(heap)
        if i == len(initials) and state in (0, 3):
            return cost, list(zip(script, roles))
        if cost > 200:
            break
        for letter, step, i2, state2, role in cr._moves(i, state, initials, faults):
            heapq.heappush(heap, (cost + step, script + letter, i2, state2, roles + (role,)))
    raise AssertionError("no script")


def _plain_repair(rows):
    """The contract of op11 row by row, with the plain search."""
    by = {}
    for row in rows:
        by.setdefault(row[0], []).append(row)
    out = {}
    for conv, own in by.items():
        live = _damaged(own)
        if not live:
            out[conv] = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
            continue
        live.sort(key=lambda r: (r[1] is not None, r[1] if r[1] is not None else 0, r[2], r[3]))
        roles, texts = [r[2] for r in live], [r[3] for r in live]
        blank = [not re.search(r"[^\x20\x09-\x0D]", t) for t in texts]
        cut = [not b and re.search(r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*$", t).group(1) not in ".!?" for b, t in zip(blank, texts)]
        faults = cr.row_faults(roles, texts, blank, cut)
        turns = {r[1] for r in live if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        initials = [r[:1] for r in roles]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, script = _plain_search(initials, faults)
        lines, at = [], 0
        for letter, role in script:
            if letter == "I":
                lines.append({"u": "user", "a": "assistant"}[role] + ":")
                continue
            if letter == "K":
                lines.append(f"{roles[at]}:{texts[at]}")
            elif letter == "R":
                lines.append({"u": "user", "a": "assistant"}[role] + f":{texts[at]}")
            at += 1
        counts = [sum(f == k for f in faults) for k in (cr.BLANK, cr.DUPLICATE, cr.CUT)]
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, *counts, illegal, cost, "".join(s for s, _ in script), digest)
    return out


def _conversations(seed, n_conv=40):
    rnd = random.Random(seed)
    texts = ["Hello there.", "Hi!", "what next", "   ", "", None, "Sure? ", "ok ok.", "Fine", "Done!"]
    roles = ["system", "user", "assistant", "user", "assistant", None, "tool"]
    rows = []
    for c in range(n_conv):
        for t in range(rnd.randint(1, 7)):
            turn = None if rnd.random() < 0.05 else t + (rnd.random() < 0.1)
            rows.append((c if c != 7 else None, turn, rnd.choice(roles), rnd.choice(texts)))
    return rows


def test_repair_against_plain_search(spark):
    rows = _conversations(3) + _conversations(11)
    df = _clashing(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r.conv_id: tuple(r)[1:] for r in cr.repair(df).collect()}
    assert got == _plain_repair(rows)


def test_repair_search_on_long_conversation():
    rnd = random.Random(5)
    initials = [rnd.choice("suax") for _ in range(400)]
    faults = [rnd.choice([0, 0, 0, 1, 2, 3]) for _ in range(400)]
    cost, script = cr.cheapest_script(initials, faults)
    assert cost >= sum(4 if f in (1, 2) else 3 if f == 3 else 0 for f in faults)
    short_i, short_f = initials[:7], faults[:7]
    assert cr.cheapest_script(short_i, short_f) == _plain_search(short_i, short_f)


def test_repair_edges(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cr.repair(empty).collect() == []
    # Every row dropped: zeros and the hash of nothing.
    dropped = [(c, 0, "user", "x.") for c in range(400) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:2]
    got = cr.repair(spark.createDataFrame(dropped, "conv_id long, turn long, role string, text string")).collect()
    assert {tuple(r)[1:] for r in got} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    long_text = "word " * 200_000 + "end."
    got = cr.repair(spark.createDataFrame([(1, 1, "user", long_text), (1, 2, "assistant", long_text)], "conv_id long, turn long, role string, text string"))
    assert got.count() == 1


def test_repair_query_covers_all_conversations(spark):
    from rankweave.llm.queries import op11_conversation_repair

    got = op11_conversation_repair(spark, SF)
    ids = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id").distinct().count()
    assert got.count() == ids and got.where("cost < 0").count() == 0


# -- op12 -----------------------------------------------------------------------


def _plain_topk(rows, k=5, every=50):
    usable = {}
    for vid, vec in rows:
        if vid is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        usable.setdefault(vid, []).append([math.floor(256 * float(np.float32(x))) for x in vec])
    out = []
    flat = [(vid, v) for vid, vs in usable.items() for v in vs]
    for qid, q in flat:
        if qid % every:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(q, v)), vid) for vid, v in flat if vid != qid))[:k]
        out.extend((qid, r + 1, vid, -s) for r, (s, vid) in enumerate(scored))
    return sorted(out)


@pytest.mark.parametrize("bucket_rows", [7, 4096])
def test_topk_against_brute_force(spark, bucket_rows):
    rnd = np.random.default_rng(4)
    rows = []
    for i in range(600):
        scale = rnd.choice([0.05, 0.3, 1.0])
        vec = (rnd.normal(size=8) * scale).astype(np.float32).tolist()
        rows.append((i, vec))
    rows += [(600, [0.0] * 8), (650, [0.5] * 8), (651, [0.5] * 8), (700, None), (750, [1.0, float("nan")] + [0.0] * 6),
             (800, [None] + [0.1] * 7), (None, [0.2] * 8), (850, [0.5] * 8)]
    df = _clashing(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = sorted(tuple(r) for r in xt.exact_topk(df, bucket_rows=bucket_rows, query_rows=3).collect())
    assert got == _plain_topk(rows)


def test_topk_edges(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert xt.exact_topk(empty).collect() == []
    few = spark.createDataFrame([(0, [0.1, 0.2]), (1, [0.3, 0.1]), (50, [0.0, 0.0])], "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in xt.exact_topk(few).collect()) == _plain_topk([(0, [0.1, 0.2]), (1, [0.3, 0.1]), (50, [0.0, 0.0])])


def test_topk_when_buckets_are_not_in_one_task(spark):
    rnd = np.random.default_rng(9)
    rows = [(i, rnd.normal(size=8).astype(np.float32).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    merged = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sorted(tuple(r) for r in xt.exact_topk(df, bucket_rows=16, query_rows=3).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", merged)
    assert got == _plain_topk(rows)


def test_topk_of_repeated_ids_and_of_vectors_beyond_the_longs(spark):
    rnd = np.random.default_rng(10)
    rows = [(i, rnd.normal(size=4).astype(np.float32).tolist()) for i in range(200)]
    rows += rows[:60] + [(100, [2.0, -1.0, 0.5, 0.25]), (201, [1e9] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in xt.exact_topk(df).collect()) == _plain_topk(rows)


def test_topk_does_not_depend_on_the_bytes_of_a_bucket(spark, monkeypatch):
    rnd = np.random.default_rng(11)
    rows = [(i, rnd.normal(size=8).astype(np.float32).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    monkeypatch.setattr(xt, "BUCKET_BYTES", 8 * 8 * 10)
    assert sorted(tuple(r) for r in xt.exact_topk(df).collect()) == _plain_topk(rows)


# -- op13 -----------------------------------------------------------------------


def _plain_variants(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans(sv.UPPER, sv.LOWER))
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}

    def near(a, b):
        return sv.one_edit(a, b) or sv.one_edit(b, a)

    out, forms = {}, {}
    for w, n in words.items():
        others = [(words[o], o) for o in words if o != w and near(w, o)]
        best = min(others, key=lambda x: (-x[0], x[1])) if others else None
        form = best[1] if best and best[0] >= 5 * n else None
        forms[w] = form
        out[w] = [w, form, None, n, len(others), best[0] if form else None]
    for w in out:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out[w][2] = root
    return sorted(tuple(v) for v in out.values())


def test_variants_against_brute_force(spark):
    rnd = random.Random(9)
    base = ["gardens", "marchés", "Élégant", "station", "stations", "nation", "notion"]
    rows = []
    for d in range(300):
        words = []
        for _ in range(30):
            w = rnd.choice(base)
            if rnd.random() < 0.2:
                i = rnd.randrange(len(w))
                w = w[:i] + rnd.choice("aeiouxé") + w[i + 1 :]
            elif rnd.random() < 0.1:
                i = rnd.randrange(len(w))
                w = w[:i] + w[i + 1 :]
            words.append(w)
        rows.append((d, " ".join(words) + " 12 ab-cd"))
    rows += [(None, "gardens gardens"), (400, None), (401, "")]
    df = _clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    want = _plain_variants(rows)
    for cell_words in (sv.CELL_WORDS, 3):
        got = sorted(tuple(r) for r in sv.spelling_variants(df, cell_words=cell_words).collect())
        assert got == want


def test_count_tree_finds_all_within_radius():
    rnd = np.random.default_rng(2)
    points = rnd.integers(0, 3, (500, 6)).astype(np.int16)
    queries = rnd.integers(0, 3, (50, 6)).astype(np.int16)
    qs, ps = sv.CountTree(points, leaf=4).within(queries, 2)
    got = set(zip(qs.tolist(), ps.tolist()))
    want = {(i, j) for i in range(50) for j in range(500) if np.abs(queries[i] - points[j]).sum() <= 2}
    assert got == want


def test_variants_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sv.spelling_variants(empty).collect() == []

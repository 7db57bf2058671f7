"""Links of sets in long lists of the n-gram join, against all pairs."""

import itertools
import random

import numpy as np
import pytest

from rankweave.llm import ngram_join

N = 90


def _cloud(words, texts, edits, seed):
    """Texts that are one text with a few words replaced: all alike, and few of them alike enough to link."""
    rnd = random.Random(seed)
    base = [f"w{seed}x{i}" for i in range(words)]
    out = []
    for t in range(texts):
        own = list(base)
        for i in rnd.sample(range(words), edits):
            own[i] = f"e{seed}x{t}x{i}"
        out.append(" ".join(own))
    return out


def _components(texts):
    sets = [set(zip(*[t.split()[i:] for i in range(5)])) for t in texts]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = 0
    for a, b in itertools.combinations(range(len(sets)), 2):
        if 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b]):
            links += 1
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return [find(i) for i in range(len(sets))], links


@pytest.mark.parametrize("listed, block_sets, block_values", [(16, 512, 1 << 20), (2, 7, 300)])
def test_long_lists_join_what_pairs_join(spark, monkeypatch, listed, block_sets, block_values):
    monkeypatch.setattr(ngram_join, "MOST_LISTED", listed)
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", block_sets)
    monkeypatch.setattr(ngram_join, "BLOCK_VALUES", block_values)
    texts = _cloud(80, N, 2, 1) + _cloud(150, N, 3, 2)
    rows = [(i, t) for i, t in enumerate(texts)]
    made = []
    stored = ngram_join.stored
    monkeypatch.setattr(ngram_join, "stored", lambda df, name: made.append((name, stored(df, name))) or made[-1][1])
    got = ngram_join.ngram_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    roots, links = _components(texts)
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(roots))
    # Not all alike, not all apart: the lists have sets that link and sets that do not.
    assert 20 < len(set(roots)) < 2 * N and links > 10
    pairs = next(t for name, t in made if name == "open-pairs").count()
    assert pairs < 4 * N


def test_a_block_gives_few_links_and_joins_all():
    rnd = random.Random(5)
    sets = [np.array(sorted(rnd.sample(range(40), 33)), np.uint64) for _ in range(60)]
    block = ngram_join._Block(range(60), range(60), [33] * 60, sets)
    links = list(block.own_links())
    good = {(a, b) for a in range(60) for b in range(60) if 7 * len(np.intersect1d(sets[a], sets[b])) >= 3 * 66}
    assert set(links) <= good and len(links) < 60 < len(good)
    root = list(range(60))
    for a, b in links:
        root = [root[a] if r == root[b] else r for r in root]
    assert all(root[a] == root[b] for a, b in good)
    # A set from elsewhere, of a group that the block does not hold, joins each group once.
    assert len(list(block.links(99, 99, 33, sets[0]))) == len(set(root[b] for a, b in good if a == 0))
    assert not list(block.links(98, 99, 33, sets[0]))
    assert not list(block.links(97, 97, 2, np.array([77, 78], np.uint64)))

"""Work and memory of steps inside a task."""

import itertools
import json
import random
import tracemalloc

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest

from rankweave.llm import common, packing
from rankweave.llm import spelling_variants as sv
from rankweave.llm import tokens
from rankweave.llm.common import text_slices


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_word_cache_takes_few_bytes_a_word(name):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(20_000)]
    texts = [" ".join(words[i:i + 50]) for i in range(0, len(words), 50)]
    held = tokens.Encoder(public_tokenizers.path(name))
    tracemalloc.start()
    held.encode(texts)
    left = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert left < 50 * len(words)
    assert held.encode(texts[:20]) == [held.whole(t) for t in texts[:20]]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_do_not_depend_on_the_cache(name, monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_WORDS", 5)
    held = tokens.Encoder(public_tokenizers.path(name))
    texts = ["", "a b c", "one two  three\n\nfour a b", "x" * 200 + " b", "a </s> b <unk>", "\x01 a", "tab\ta\x0bb", "É à ß"]
    for _ in range(3):
        for some in (texts, texts[::-1], texts[2:4]):
            assert held.encode(some) == [held.whole(t) for t in some]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_a_word_with_signs_after_it_is_learned_once(name):
    held = tokens.Encoder(public_tokenizers.path(name))
    words = ["word", "éÀß", "Word", "don't", "a1", "x×y", "Åb", "ŝo", "e\u0301a", "İx", "日本", "ªº", "<|endoftext", "'s", "-"]
    tails = ["", ",", "!!", "...", "'s", ",'s", "\"", "|>", "--", ",b", "».", "1."]
    texts = [" ".join(w + t for t in tails) for w in words] + [f"{w}{t}\n{w}{t} {w}  {w}{t}" for w in words for t in tails]
    for some in (texts, texts[::-1]):
        assert held.encode(some) == [held.whole(t) for t in some]
    before = len(held.words)
    held.encode(["Wordy wordy, wordy! Wordy... wordy?"])
    # One word for the file that lower-cases; else two, and the first word of the text, which has no space before it.
    assert len(held.words) - before == (1 if held.spaced else 3)


def test_a_file_with_other_cuts_keeps_words_whole(tmp_path):
    rules = json.loads(open(public_tokenizers.path("byte_bpe_50k.json")).read())
    rules["pre_tokenizer"]["use_regex"] = False
    (tmp_path / "other.json").write_text(json.dumps(rules))
    assert not tokens.Encoder(str(tmp_path / "other.json")).tailed
    assert tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json")).tailed


def test_a_resting_encoder_keeps_the_smaller_cache(monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_WORDS", 5)
    held = tokens.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    held.encode(["a b c d e f g h"])
    assert len(held.words) == 8
    held.rest()
    assert len(held.words) == 5 and held.encode(["a h z"]) == [held.whole("a h z")]


def test_a_step_gives_memory_back_when_it_ends_or_fails(monkeypatch):
    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    assert list(common.resting(lambda batches: (b + 1 for b in batches))([1, 2])) == [2, 3] and given == [1]
    with pytest.raises(ZeroDivisionError):
        list(common.resting(lambda batches: (1 // b for b in batches))([1, 0]))
    assert given == [1, 1]


def test_prices_meet_only_sizes_that_are_there():
    """Against every way to fill the room; absent sizes and the room over the largest one stay empty."""
    sizes, prices, room = np.array([3, 5, 8]), np.array([0.2, 0.4, 0.55]), 17
    worth, pattern = packing._knapsack(sizes, prices, room)
    ways = itertools.product(range(6), range(4), range(3))
    best = max(float(np.dot(w, prices)) for w in ways if np.dot(w, sizes) <= room)
    assert abs(worth - best) < 1e-9 and abs(pattern @ prices - best) < 1e-9 and pattern @ sizes <= room


def test_text_slices_keep_every_row_in_bounded_runs():
    texts = ["é" * 10, None, "", "b" * 100, "c" * 15, "d" * 15, "e"]
    batch = pa.record_batch({"id": range(7), "text": pa.array(texts)}).slice(1)
    parts = list(text_slices(batch, 1, 30))
    assert [x for p in parts for x in p.column(1).to_pylist()] == texts[1:]
    assert [p.column(0).to_pylist() for p in parts] == [[1, 2], [3], [4, 5], [6]]


def test_words_of_equal_letters_are_told_apart_by_their_halves(monkeypatch):
    """Anagrams have equal counts over the whole word; most never reach the check of letter order."""
    words = ["".join(p) for p in itertools.islice(itertools.permutations("abcdefgh"), 0, 40_320, 100)]
    words += [w[:3] + "z" + w[4:] for w in words[:50]]
    frame = pd.DataFrame({"word": words, "n": range(5, 5 + len(words))})
    checked, real = [], sv._one_edit_codes
    monkeypatch.setattr(sv, "_one_edit_codes", lambda a, b, same: (checked.append(len(a)), real(a, b, same))[1])
    got = sv._search_cell(8, frame, frame)
    want = {(a, b) for a in words for b in words if sv.one_edit(a, b)}
    assert set(zip(got["word"], got["other"])) == want and len(got) == len(want)
    assert sum(checked) < len(words) ** 2 / 10


def test_insertions_are_found_on_both_sides_of_the_cut():
    target = "abcdefghi"
    shorter = sorted({target[:i] + target[i + 1:] for i in range(len(target))})
    got = sv._search_cell(9, pd.DataFrame({"word": [target], "n": [7]}), pd.DataFrame({"word": shorter, "n": [9] * len(shorter)}))
    want = sorted([(s, target, 7) for s in shorter] + [(target, s, 9) for s in shorter])
    assert sorted(map(tuple, got.itertuples(index=False))) == want


def test_tree_counts_over_the_largest_of_all_points():
    tree = sv.CountTree(np.array([[1, 0], [0, 2]], np.int16))
    qs, ps = tree.within(np.array([[3, 0], [0, 4], [0, 9]], np.int16), 2)
    assert set(zip(qs.tolist(), ps.tolist())) == {(0, 0), (1, 1)}

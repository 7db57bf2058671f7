"""Token ids of texts by a tokenizer file, word by word for a batch of texts.

A text is cut where the tokenizer cuts it anyway (at its spaces), so the ids of
a word do not depend on its neighbours: the distinct words of a batch are
looked up or encoded once. Where the file's pattern also cuts between letters
and the punctuation after them, only the letters are looked up as a word, so
that "word", "word," and "word!" are learned once. Texts for which that is not
certain are encoded whole.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import give_back, text_chunks, worker_store

END = 2
# Words that a worker's cache goes back to when it holds twice as many, and code
# points of the longest one kept. They bound memory, not results.
CACHED_WORDS = 400_000
CACHED_LENGTH = 64
CACHED_TAILS = 20_000
# Characters of new words encoded in one call, of texts in one batch, and of texts cut into words at a time.
_CALL_CHARS = 1 << 16
_BATCH_CHARS = 1 << 22
_CUT_CHARS = 1 << 19
# Stands before the first word of a byte-level text, which has no space before it.
_FIRST = "\x02"
_MARK = "\x01"
# The two pre-tokenizers known to cut between a run of letters and the signs after it.
_LETTERS_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SPACED_CUTS = {
    "type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": _LETTERS_PATTERN}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
_SPACED_FORMS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_BYTE_LEVEL_CUTS = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
# Bytes that a byte-level vocabulary writes as letters from U+0100 on, in their order.
_BYTE_LETTERS = {b: chr(256 + i) for i, b in enumerate([*range(33), *range(127, 161), 173])}
# Signs that may follow the letters; no apostrophe, which the patterns take together with letters.
_TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class Encoder:
    """Ids of whole texts as little-endian 16-bit bytes (32-bit for a vocabulary over 65536)."""

    def __init__(self, path: str, end: int = END):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # The library finds the strings of added tokens before it cuts a text; such texts are encoded whole.
        self.added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.end = end
        vocabulary = self.tokenizer.get_vocab()
        self.size = max(max(vocabulary.values(), default=0), end) + 1
        self.width = 2 if self.size <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        self.spaced = any(t.endswith("</w>") for t in vocabulary)
        # A byte-level vocabulary writes a leading space as U+0120 and a line end as U+010A.
        self.opens = np.zeros(self.size, bool)
        self.opens[[i for t, i in vocabulary.items() if t[:1] in "ĠĊ"]] = True
        self.mark = self.whole(_MARK) if self.spaced else b""
        self.tailed = self._cuts_tails()
        self.tails: dict[str, bytes] = {}
        self.new: dict[str, bytes] = {}
        # The cache: words, their ids (null: cannot stand alone), and the batch that last had them.
        # Arrow arrays take a fraction of the memory of a dict of texts.
        self.words, self.held = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        self.used, self.batches = np.zeros(0, np.int64), 0

    def whole(self, text: str) -> bytes:
        """Ids of a text in one call, without the end id."""
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, self.dtype).tobytes()

    def _cuts_tails(self) -> bool:
        """The file is known to give letters the same ids with and without signs after them."""
        rules = json.loads(self.tokenizer.to_str())
        # A sign before a letter: then no added token stands inside letters and the signs after them.
        if rules["truncation"] or not all(re.search(r"[^\w\s][^\W\d_]", sign) for sign in self.added):
            return False
        if rules["model"]["type"] != "BPE" or rules["model"].get("dropout"):
            return False
        if self.spaced:
            return rules["pre_tokenizer"] == _SPACED_CUTS and (rules["normalizer"] or {}).get("normalizers") == _SPACED_FORMS
        return rules["pre_tokenizer"] == _BYTE_LEVEL_CUTS and rules["normalizer"] is None

    def ids(self, raw: bytes) -> np.ndarray:
        """Stored ids with the end id, as 32-bit numbers."""
        got = np.frombuffer(raw, self.dtype)
        out = np.empty(len(got) + 1, "<u4")
        out[:-1], out[-1] = got, self.end
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, without the end id."""
        out: list[bytes] = []
        for a, b in text_chunks(texts, _BATCH_CHARS):
            out += self._batch(texts[a:b])
            # Freed buffers of one batch are not kept beside those of the next.
            pa.default_memory_pool().release_unused()
        return out

    def _batch(self, texts: list[str]) -> list[bytes]:
        held = pa.array(texts, pa.large_string())
        if self.spaced:
            # Python's white space is that of the tokenizer and four control characters more.
            odd = pc.match_substring_regex(held, "[\x1c-\x1f\x01]")
            lists = pa.concat_arrays([
                pa.array([t.split() for t in texts[a:b]], pa.large_list(pa.large_string()))
                for a, b in text_chunks(texts, _CUT_CHARS)
            ])
        else:
            odd = pc.match_substring(held, _FIRST)
            lines = pc.replace_substring(held, "\n", " \n")
            parts = [pa.scalar(x, pa.large_string()) for x in (_FIRST, "")]
            lists = pc.split_pattern(pc.binary_join_element_wise(parts[0], lines, parts[1]), " ")
        for sign in [x for x in self.added if any(map(str.isspace, x))]:
            odd = pc.or_(odd, pc.match_substring(held, sign, ignore_case=True))
        coded = pc.dictionary_encode(lists.flatten())
        ids = self._word_ids(coded.dictionary)
        bad = ids.is_null().to_numpy(zero_copy_only=False)
        index = coded.indices.to_numpy()
        flat = ids.take(coded.indices)
        _, offsets, data = flat.buffers()
        at = np.frombuffer(offsets, np.int64)[flat.offset:flat.offset + len(flat) + 1]
        bounds = lists.offsets.to_numpy()
        bounds = bounds - bounds[0]
        skip = odd.to_numpy(zero_copy_only=False)
        if bad.any():
            hits = np.concatenate([[0], np.cumsum(bad[index])])
            skip = skip | (hits[bounds[1:]] > hits[bounds[:-1]])
        raw = memoryview(data) if data is not None else memoryview(b"")
        cuts = at[bounds]
        return [
            self.whole(t) if s else bytes(raw[a:b])
            for t, s, a, b in zip(texts, skip.tolist(), cuts[:-1].tolist(), cuts[1:].tolist())
        ]

    def _word_ids(self, words: pa.Array) -> pa.Array:
        """Ids of distinct words, null for a word that cannot stand alone."""
        if not self.tailed or not len(words):
            return self._key_ids(words)
        letters = pc.ascii_rtrim(words, characters=_TAIL)
        plain = pc.and_(pc.utf8_is_alpha(letters), pa.array(_latin(letters)))
        cut = pc.less(pc.binary_length(letters), pc.binary_length(words))
        keys = pc.dictionary_encode(pc.if_else(plain, pc.utf8_lower(letters) if self.spaced else letters, words))
        got = self._key_ids(keys.dictionary).take(keys.indices)
        cut = np.flatnonzero(pc.and_(plain, cut).to_numpy(zero_copy_only=False))
        if not len(cut):
            return got
        rows = pa.array(cut)
        sizes = pc.utf8_length(letters.take(rows)).to_pylist()
        tails = [self._tail(w[n:]) for w, n in zip(words.take(rows).to_pylist(), sizes)]
        none = pa.scalar(b"", pa.large_binary())
        joined = pc.binary_join_element_wise(got.take(rows), pa.array(tails, pa.large_binary()), none)
        place = np.arange(len(words))
        place[cut] = len(words) + np.arange(len(cut))
        return pa.concat_arrays([got, joined]).take(pa.array(place))

    def _tail(self, tail: str) -> bytes:
        if tail not in self.tails:
            if len(self.tails) > CACHED_TAILS or len(tail) > CACHED_LENGTH:
                return self.whole(tail)
            self.tails[tail] = self.whole(tail)
        return self.tails[tail]

    def _key_ids(self, words: pa.Array) -> pa.Array:
        """The same by the cache; what is not in it is encoded."""
        self.batches += 1
        at = pc.index_in(words, value_set=self.words)
        fresh = at.is_null().to_numpy(zero_copy_only=False)
        place = at.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.used[place[~fresh]] = self.batches
        missing = words.filter(pa.array(fresh))
        made = self._made(missing)
        place[fresh] = len(self.words) + np.arange(len(missing))
        out = pa.concat_arrays([self.held, made]).take(pa.array(place))
        short = pc.less_equal(pc.utf8_length(missing), CACHED_LENGTH)
        self.words = pa.concat_arrays([self.words, missing.filter(short)])
        self.held = pa.concat_arrays([self.held, made.filter(short)])
        self.used = np.append(self.used, np.full(len(self.words) - len(self.used), self.batches))
        if len(self.words) > 2 * CACHED_WORDS:
            self._shrink()
        return out

    def _shrink(self) -> None:
        last = pa.array(np.sort(np.argsort(-self.used, kind="stable")[:CACHED_WORDS]))
        self.words, self.held, self.used = self.words.take(last), self.held.take(last), self.used[last.to_numpy()]

    def rest(self) -> None:
        """After a task: an idle worker keeps the smaller cache only."""
        if len(self.words) > CACHED_WORDS:
            self._shrink()
        give_back()

    def _made(self, words: pa.Array) -> pa.Array:
        """Ids of words that are not in the cache: runs of letters by joined calls, the rest one by one in ``new``."""
        plain = np.zeros(len(words), bool)
        if self.tailed and len(words):
            plain = pc.utf8_is_alpha(words).to_numpy(zero_copy_only=False) & _latin(words)
        letters = words.filter(pa.array(plain))
        parts, start = [], 0
        ends = np.cumsum(pc.binary_length(letters).to_numpy(zero_copy_only=False), dtype=np.int64)
        while start < len(letters):
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + _CALL_CHARS, side="right")))
            parts.append(self._letters(letters.slice(start, end - start)))
            start = end
        texts = words.filter(pa.array(~plain)).to_pylist()
        self._learn(texts)
        parts.append(pa.array([self.new.get(w) for w in texts], pa.large_binary()))
        self.new = {}
        place = np.empty(len(words), np.int64)
        place[np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])] = np.arange(len(words))
        return pa.concat_arrays(parts).take(pa.array(place))

    def _letters(self, words: pa.Array) -> pa.Array:
        """Ids of runs of letters: each is one piece, so it goes to the file's model at once, in its byte letters."""
        tokenize, lead = self.tokenizer.model.tokenize, "" if self.spaced else "\u0120"
        ids: list[int] = []
        ends = [0]
        for word in words.to_pylist():
            if not word.isascii():
                word = word.encode().decode("latin-1").translate(_BYTE_LETTERS)
            ids += [token.id for token in tokenize(lead + word)]
            ends.append(len(ids))
        offsets = np.array(ends, np.int64) * self.width
        held = [pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.array(ids, self.dtype).tobytes())]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, *held])

    def _learn(self, missing: list[str]) -> None:
        """Have the ids of all these words in ``new``, but of words that cannot stand alone."""
        low = "\n".join(missing).lower()
        if any(sign in low for sign in self.added):
            missing = [w for w in missing if not any(sign in w.lower() for sign in self.added)]
        if self.spaced:
            self._in_calls([w for w in missing if _MARK not in w], self._learn_spaced)
            return
        for w in missing:
            if w[:1] == _FIRST and _one_piece(w[1:]) and len(w) > 1:
                self.new[w] = self.whole(w[1:])
        fit = [w for w in missing if w and w[0] != _FIRST and _one_piece(w[1:] if w[0] == "\n" else w)]
        self._in_calls([w for w in fit if w != "\n"], self._learn_byte_level)

    def _in_calls(self, words: list[str], learn) -> None:
        size = start = 0
        for i, w in enumerate(words, 1):
            size += len(w)
            if size >= _CALL_CHARS or i == len(words):
                learn(words[start:i])
                start, size = i, 0

    def _learn_byte_level(self, words: list[str]) -> None:
        given = [w if w[0] == "\n" else " " + w for w in words]
        ids = np.array(self.tokenizer.encode("".join(given), add_special_tokens=False).ids, self.dtype)
        at = np.flatnonzero(self.opens[ids])
        if len(at) != len(words) or at[0] != 0:
            self.new.update((w, self.whole(g)) for w, g in zip(words, given))
        else:
            self._cut(words, ids, at, np.append(at[1:], len(ids)))

    def _learn_spaced(self, words: list[str]) -> None:
        joined = f" {_MARK} ".join(words)
        ids = np.array(self.tokenizer.encode(joined, add_special_tokens=False).ids, self.dtype)
        at = np.flatnonzero(ids == np.frombuffer(self.mark, self.dtype)[0])
        if len(at) != len(words) - 1 or len(self.mark) != self.width:
            self.new.update((w, self.whole(w)) for w in words)
        else:
            self._cut(words, ids, np.append(0, at + 1), np.append(at, len(ids)))

    def _cut(self, words: list[str], ids: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> None:
        raw = ids.tobytes()
        begins, ends = (begins * self.width).tolist(), (ends * self.width).tolist()
        self.new.update(zip(words, [raw[a:b] for a, b in zip(begins, ends)]))


def _latin(words: pa.Array) -> np.ndarray:
    """Words without a code point over U+00FF, by their bytes."""
    _, offsets, data = words.buffers()
    at = np.frombuffer(offsets, np.int64)[words.offset:words.offset + len(words) + 1]
    if data is None or at[-1] == at[0]:
        return np.ones(len(words), bool)
    high = np.flatnonzero(np.frombuffer(data, np.uint8)[at[0]:at[-1]] > 0xC3) + at[0]
    seen = np.searchsorted(high, at)
    return seen[1:] == seen[:-1]


def _one_piece(word: str) -> bool:
    """A word without white space inside."""
    return (word.isascii() and word.isalnum()) or (word != "" and not any(map(str.isspace, word)))


def encoder(path: str, end: int = END) -> Encoder:
    """The worker's encoder of a tokenizer file; loaded once."""
    held = worker_store().setdefault("encoders", {})
    if (path, end) not in held:
        held[path, end] = Encoder(path, end)
    return held[path, end]

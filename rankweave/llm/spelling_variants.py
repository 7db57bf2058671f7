"""Spelling variants grouped by k-d trees over letter-count vectors.

Words are letter runs counted over all documents. One edit (insert, delete or
replace one code point) changes a word's letter-count vector by at most two in
L1 distance (one for an insert or delete), so near words are found by range
searches of radius two (one) among words of equal length (one longer).

Spark counts the words. The words of each length are cut into cells by the
top levels of a k-d tree (split on the letters whose counts vary most in that
length, at their mean), so no cell grows with the vocabulary. A word asks every
cell of its own length and of the next one whose box lies within the radius of
its vector; in each cell a local k-d tree over the counts prunes boxes beyond
the radius, and the pairs left are verified in letter order. The form of a
word is its near word of largest count when that count is at least five times
its own, and forms are followed to a root by pointer jumping.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, text_or_empty

# Fixed values of the contract.
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
DAMAGE_EVERY = 199
MIN_LENGTH = 6
MIN_COUNT = 5
FORM_RATIO = 5
# Letters that can stand in a word after lower-casing: a-z and U+00C0 to U+00FF.
ALPHABET = LOWER + "".join(chr(c) for c in range(0xC0, 0x100))
_INDEX = {c: i for i, c in enumerate(ALPHABET)}
_NUMBERS = np.zeros(256, np.uint8)
_NUMBERS[[ord(c) for c in ALPHABET]] = np.arange(1, len(ALPHABET) + 1)

# Words of one length that one cell (one task of the range search) holds, about.
CELL_WORDS = 20_000
LEAF = 8
# Queries that go down a cell's tree together, and rows of a step of the search.
QUERY_CHUNK = 1024
_FRONT = 1 << 17
_CODED_ROWS = 1 << 13

RESULT = "word string, form string, root string, n long, n_near long, form_n long"


def word_counts(documents: DataFrame) -> DataFrame:
    """(word, n) of all letter runs after the damage rule, before any bound on length or count.

    A run's hash is the unsigned crc32 of ``<doc_id>:<run>`` (a null doc_id
    is written as nothing); when 199 divides it, the code point at hash mod
    length is deleted. Null texts have no runs.
    """
    runs = documents.select("doc_id", F.explode(F.regexp_extract_all(text_or_empty(), F.lit(RUN), 0)).alias("run"))
    runs = runs.withColumn("run", F.translate("run", UPPER, LOWER))
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    runs = runs.withColumn("h", F.crc32(key.cast("binary")))
    cut = F.concat(F.expr("substring(run, 1, cast(h % length(run) as int))"), F.expr("substring(run, cast(h % length(run) as int) + 2)"))
    word = F.when(F.col("h") % DAMAGE_EVERY == 0, cut).otherwise(F.col("run"))
    return runs.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def letter_counts(word: str) -> np.ndarray:
    out = np.zeros(len(ALPHABET), np.int16)
    for c in word:
        out[_INDEX[c]] += 1
    return out


def spelling_variants(documents: DataFrame, cell_words: int = CELL_WORDS) -> DataFrame:
    """Each frequent word with its form, root, count and near-word count.

    Words are results of at least 6 code points met at least 5 times. Near
    words differ by one inserted, deleted or replaced code point. ``form`` is
    the near word of largest n (ties: smallest in code-point order) if that n
    is at least 5 times the word's, else null; ``root`` follows forms to the
    end (the word itself without a form). Empty tables give no rows.
    """
    counted = word_counts(documents).where((F.length("word") >= MIN_LENGTH) & (F.col("n") >= MIN_COUNT))
    words = stored(counted.withColumn("length", F.length("word")), "variant-words")
    splits = _splits(words, cell_words)
    pairs = stored(_near_pairs(words, splits), "variant-pairs")
    best = pairs.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("neg"), F.col("other").alias("other"))).alias("best")
    )
    out = words.join(best, "word", "left")
    strong = F.col("best.neg") * -1 >= FORM_RATIO * F.col("n")
    out = out.select(
        "word",
        F.when(strong, F.col("best.other")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, -F.col("best.neg")).cast("long").alias("form_n"),
    )
    out = stored(out, "variant-forms")
    return _with_roots(out).select("word", "form", "root", "n", "n_near", "form_n")


def _splits(words: DataFrame, cell_words: int) -> dict[int, list[tuple[int, float]]]:
    """Per length, the top-level splits (letter, threshold) of its k-d tree.

    Letters of largest count variance first, each split at its mean; as many
    levels as halve the length's words down to ``cell_words``. The table read
    to the driver has at most one row per length and letter.
    """

    letters = words.select("word", "length", F.explode(F.split("word", "")).alias("letter"))
    per_word = letters.groupBy("word", "length", "letter").agg(F.count("*").alias("c"))
    stats = per_word.groupBy("length", "letter").agg(F.sum("c").alias("s"), F.sum(F.col("c") * F.col("c")).alias("s2"))
    totals = dict(words.groupBy("length").count().collect())
    by_length: dict[int, list[tuple[float, int, float]]] = {}
    for r in stats.collect():
        rows = totals[r.length]
        mean = r.s / rows
        by_length.setdefault(r.length, []).append((r.s2 / rows - mean * mean, _INDEX[r.letter], mean))
    out = {}
    for length, rows in by_length.items():
        total = totals[length]
        levels = max(0, math.ceil(math.log2(total / cell_words))) if total > cell_words else 0
        rows.sort(key=lambda x: (-x[0], x[1]))
        out[length] = [(letter, math.floor(mean)) for _, letter, mean in rows[:levels]]
    return out


def _cell(vector: np.ndarray, splits: list[tuple[int, float]]) -> int:
    cell = 0
    for letter, threshold in splits:
        cell = cell * 2 + int(vector[letter] > threshold)
    return cell


def _cells_within(vector: np.ndarray, splits: list[tuple[int, float]], radius: int) -> list[int]:
    """Cells whose box lies within L1 ``radius`` of the vector."""
    out = []

    def walk(level: int, cell: int, spent: int) -> None:
        if level == len(splits):
            out.append(cell)
            return
        letter, threshold = splits[level]
        c = int(vector[letter])
        for bit, away in ((0, max(0, c - threshold)), (1, max(0, threshold + 1 - c))):
            if spent + away <= radius:
                walk(level + 1, cell * 2 + bit, spent + away)

    walk(0, 0, 0)
    return out


def _near_pairs(words: DataFrame, splits: dict) -> DataFrame:
    """(word, other, other_n) for every ordered pair of near words."""

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for word, n, length in zip(*(batch.column(c).to_pylist() for c in ("word", "n", "length"))):
                v = letter_counts(word)
                rows.append((length, _cell(v, splits.get(length, [])), word, n, 0))
                for target, radius in ((length, 2), (length + 1, 1)):
                    if target in splits:
                        rows.extend((target, c, word, n, 1) for c in _cells_within(v, splits[target], radius))
            columns = list(zip(*rows)) if rows else [()] * 5
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["length", "cell", "word", "n", "asks"])

    schema = "length long, cell long, word string, n long, asks int"
    routed = words.select("word", "n", "length").mapInArrow(dealt, schema)
    # Both sides come from one table: fresh names keep the cogroup from mixing their columns.
    fresh = [F.col(c).alias(c) for c in ("length", "cell", "word", "n")]
    held = routed.where("asks = 0").select(*fresh)
    asking = routed.where("asks = 1").select(*fresh)

    def search(key: tuple, targets: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        return _search_cell(int(key[0]), targets, queries)

    keys = ["length", "cell"]
    return held.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInPandas(search, "word string, other string, other_n long")


def one_edit(a: str, b: str) -> bool:
    """True when b is a with one code point replaced, or with one inserted."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) + 1 != len(b):
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i:] == b[i + 1 :]


def _unary(points: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Counts in unary code, 64 bits to a word: the L1 distance of two rows is the number of bits that differ.

    ``levels`` has the largest count of each column; larger ones are cut to it.
    """
    columns = np.repeat(np.arange(len(levels)), levels)
    steps = np.arange(len(columns)) - np.repeat(np.cumsum(levels) - levels, levels)
    out = np.zeros((len(points), max(1, -(-len(columns) // 64)) * 64), bool)
    for first in range(0, len(points), _CODED_ROWS):
        out[first : first + _CODED_ROWS, : len(columns)] = points[first : first + _CODED_ROWS][:, columns] > steps
    return np.packbits(out, axis=1).view(np.uint64)


def _bits(words: np.ndarray) -> np.ndarray:
    return np.bitwise_count(words).sum(axis=1, dtype=np.int32)


class CountTree:
    """k-d tree over letter-count vectors with tight boxes, searched in batches.

    Counts are in unary code, so a split (a letter, a threshold) is one bit, and
    the box of a node is the AND (least counts) and the OR (largest ones) of its
    points. Each node is split at the bit that halves it best.
    """

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.levels = points.max(axis=0).astype(np.int64) if len(points) else np.zeros(points.shape[1], np.int64)
        self.points = _unary(points, self.levels)
        self.order = np.arange(len(points))
        self.lo, self.hi, self.kids, self.spans = [], [], [], []
        flags = np.unpackbits(self.points.view(np.uint8), axis=1).view(bool)
        todo = [(0, len(points), -1, 0)]
        while todo:
            start, end, parent, side = todo.pop()
            node, own = len(self.lo), self.order[start:end]
            if parent >= 0:
                self.kids[parent][side] = node
            part = self.points[own]
            self.lo.append(np.bitwise_and.reduce(part, axis=0))
            self.hi.append(np.bitwise_or.reduce(part, axis=0))
            self.kids.append([-1, -1])
            self.spans.append((start, end))
            if end - start <= leaf or (self.lo[node] == self.hi[node]).all():
                continue
            ones = flags[own].sum(axis=0, dtype=np.int64)
            upper = flags[own, int(np.argmin(np.abs(2 * ones - len(own))))]
            self.order[start:end] = np.concatenate([own[~upper], own[upper]])
            middle = end - int(upper.sum())
            todo += [(middle, end, node, 1), (start, middle, node, 0)]
        self.lo, self.hi = np.array(self.lo), np.array(self.hi)
        self.kids, self.spans = np.array(self.kids, np.int64), np.array(self.spans, np.int64)

    def within(self, queries: np.ndarray, radius: int, chunk: int = QUERY_CHUNK) -> tuple[np.ndarray, np.ndarray]:
        """All (query, point) index pairs with L1 distance at most ``radius``."""
        found = list(self.chunks(queries, radius, chunk=chunk))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([q for q, _ in found]), np.concatenate([p for _, p in found])

    def chunks(self, queries: np.ndarray, radius: int, more: int | None = None, less: int | None = None, chunk: int = QUERY_CHUNK):
        """The same pairs, piece by piece, so that a caller can thin them as they come.

        ``more`` and ``less`` bound by how much the counts of a point may lie
        above and below the query's, each summed over the letters.
        """
        most = [radius if x is None else min(x, radius) for x in (more, less)]
        for first in range(0, len(queries), chunk):
            part = queries[first : first + chunk]
            # Counts over the largest of all points are below the query's in every point.
            over = np.maximum(part.astype(np.int64) - self.levels, 0).sum(axis=1)
            for qs, ps in self._within(_unary(part, self.levels), over, radius, *most):
                yield qs + first, ps

    def _within(self, queries: np.ndarray, over: np.ndarray, radius: int, more: int, less: int):
        q_at = np.arange(len(queries))
        nodes = np.zeros(len(queries), np.int64)
        stack = [(q_at, nodes)]
        while stack:
            q_at, nodes = stack.pop()
            if len(q_at) > _FRONT:
                half = len(q_at) // 2
                stack += [(q_at[half:], nodes[half:]), (q_at[:half], nodes[:half])]
                continue
            q = queries[q_at]
            above, below = _bits(self.lo[nodes] & ~q), _bits(q & ~self.hi[nodes]) + over[q_at]
            near = (above <= more) & (below <= less) & (above + below <= radius)
            q_at, nodes = q_at[near], nodes[near]
            leaf = self.kids[nodes, 0] < 0
            if leaf.any():
                # Every point of every leaf reached, with its query, checked at once.
                yield from self._in_leaves(queries, over, q_at[leaf], self.spans[nodes[leaf]], radius)
            inner = ~leaf
            if inner.any():
                stack.append((np.repeat(q_at[inner], 2), self.kids[nodes[inner]].reshape(-1)))

    def _in_leaves(self, queries: np.ndarray, over: np.ndarray, q_at: np.ndarray, spans: np.ndarray, radius: int):
        ends = np.cumsum(spans[:, 1] - spans[:, 0])
        first = 0
        while first < len(q_at):
            # Leaves of equal points may be large; so many pairs at a time, and a leaf at least.
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + _FRONT, side="right")))
            starts, sizes = spans[first:last, 0], spans[first:last, 1] - spans[first:last, 0]
            shift = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
            points = self.order[shift + np.arange(int(sizes.sum()))]
            owners = np.repeat(q_at[first:last], sizes)
            close = _bits(self.points[points] ^ queries[owners]) + over[owners] <= radius
            yield owners[close], points[close]
            first = last


def _half_counts(codes: np.ndarray, cut: int) -> np.ndarray:
    """Letter counts of the first ``cut`` code points of each word, beside those of the rest."""
    letters = len(ALPHABET) + 1
    out = np.zeros((len(codes), 2 * letters), np.uint8)
    rows = np.arange(len(codes))
    for place in range(codes.shape[1]):
        column = codes[:, place].astype(np.int64) + (letters if place >= cut else 0)
        held = out[rows, column]
        # Cut at 127: that never makes two counts further apart, so no pair is lost.
        out[rows, column] = np.minimum(held + 1, 127)
    # Code 0 is the padding after a word.
    return np.delete(out, [0, letters], axis=1)


def _search_cell(length: int, targets: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    """Near pairs between the words held in a cell and the words that ask it."""
    if targets.empty or queries.empty:
        return _pairs([])
    t_words, q_words = targets["word"].tolist(), queries["word"].tolist()
    t_n, q_n = targets["n"].to_numpy(), queries["n"].to_numpy()
    t_codes, q_codes = _codes(t_words, length), _codes(q_words, length)
    # One edit is in one half of a word, so the counts of both halves differ by no more than those of the whole.
    cut = length // 2
    t_vectors = _half_counts(t_codes, cut)
    used = np.flatnonzero(t_vectors.any(axis=0))
    unused = np.setdiff1d(np.arange(t_vectors.shape[1]), used)
    tree = CountTree(np.column_stack([t_vectors[:, used], np.zeros(len(t_words), np.uint8)]))
    lengths = np.array([len(w) for w in q_words])
    parts = []
    for same in (True, False):
        asking = np.flatnonzero((lengths == length) == same)
        kept_q, kept_p = [], []
        # A letter inserted before the cut moves the cut of the shorter word by one.
        for at in (cut,) if same else (cut, cut - 1):
            vectors = _half_counts(q_codes[asking], at)
            # Letters that no word of the cell has are all below the query's counts.
            beyond = vectors[:, unused].sum(axis=1, dtype=np.int64)
            left = np.flatnonzero(beyond <= (1 if same else 0))
            chosen, vectors = asking[left], np.column_stack([vectors[left][:, used], beyond[left].astype(np.uint8)])
            for qs, ps in tree.chunks(vectors, 2 if same else 1, 1, 1 if same else 0):
                qs = chosen[qs]
                # Letter order, checked for all pairs of a chunk at once; only near pairs are held.
                good = _one_edit_codes(q_codes[qs], t_codes[ps], same)
                kept_q.append(qs[good])
                kept_p.append(ps[good])
        if not kept_q:
            continue
        pairs = np.unique(np.concatenate(kept_q) * len(t_words) + np.concatenate(kept_p))
        qs, ps = pairs // len(t_words), pairs % len(t_words)
        parts.append(pd.DataFrame({"word": np.array(q_words, object)[qs], "other": np.array(t_words, object)[ps], "other_n": t_n[ps]}))
        if not same:
            parts.append(pd.DataFrame({"word": np.array(t_words, object)[ps], "other": np.array(q_words, object)[qs], "other_n": q_n[qs]}))
    if not parts:
        return _pairs([])
    return pd.concat(parts, ignore_index=True).astype({"other_n": "int64"})


def _codes(words: list[str], width: int) -> np.ndarray:
    """Each word's letters by their numbers in the alphabet, from 1, padded with zeros to ``width``."""
    points = np.array([w[:width] for w in words], f"<U{width}").view("<u4").reshape(len(words), width)
    return _NUMBERS[points]


def _one_edit_codes(a: np.ndarray, b: np.ndarray, same: bool) -> np.ndarray:
    """Per row: b is a with one code point replaced (same length), or with one inserted.

    In the second case a is one shorter and padded with a zero at its end.
    """
    if same:
        return (a != b).sum(axis=1) == 1
    width = b.shape[1]
    # a[:i] == b[:i] and a[i:] == b[i+1:] for some i: a common prefix and suffix cover a.
    prefix = np.cumprod(a[:, : width - 1] == b[:, : width - 1], axis=1).sum(axis=1)
    shifted = a[:, : width - 1] == b[:, 1:]
    suffix = np.cumprod(shifted[:, ::-1], axis=1).sum(axis=1)
    return prefix + suffix >= width - 1


def _pairs(rows: list) -> pd.DataFrame:
    """Pairs as a frame with fixed types, empty ones included."""
    words, others, counts = zip(*rows) if rows else ((), (), ())
    return pd.DataFrame(
        {"word": pd.Series(words, dtype=object), "other": pd.Series(others, dtype=object), "other_n": pd.Series(counts, dtype="int64")}
    )


def _with_roots(forms: DataFrame) -> DataFrame:
    """Add ``root`` by pointer jumping over the forms; counts rise along them, so there is no cycle."""
    hop = forms.select("word", F.coalesce("form", "word").alias("root"))
    while True:
        ahead = hop.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = hop.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), (F.col("next").isNotNull() & (F.col("next") != F.col("root"))).alias("moved"))
        moved = stored(moved, "variant-roots")
        if moved.where("moved").limit(1).count() == 0:
            hop = moved.drop("moved")
            break
        hop = moved.drop("moved")
    return forms.join(hop, "word")

"""Quality classifier: a generalised additive model with pairwise interactions.

Boosting goes round the features, one shallow tree on one feature at a time, and
then round the strongest pairs of features. The trees of a feature add up to a
lookup table over its bins, so a score is a sum of table entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release_encoders, resting, shingle_hashes, text_chunks, text_or_empty, word_hashes

# Labelled rows the model is fitted on, about; they are chosen by a hash of doc_id.
TRAIN_ROWS = 20_000
BINS = 48
PAIR_BINS = 12
PAIRS = 8
ROUNDS = 120
RATE = 0.15
# Rows filtered at a time.
_ROWS = 1024
# Predicted good from this score.
GOOD = 0.7

FEATURES = (
    "log_bytes log_words word_bytes word_spread longest upper digits bangs bars symbols stops lines "
    "non_ascii distinct_words top_word distinct_shingles short_words long_words plain_words capital_words vowels"
).split()


def _class(characters: str) -> np.ndarray:
    held = np.zeros(256, bool)
    held[list(characters.encode())] = True
    return held


_UPPER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _UPPER | _class("abcdefghijklmnopqrstuvwxyz")
_LETTER[128:] = True
_COUNTED = {
    "upper": _UPPER,
    "digits": _class("0123456789"),
    "bangs": _class("!"),
    "bars": _class("|"),
    "symbols": _class("#$%&*@^~=+<>\\/_{}[]"),
    "stops": _class(".,;:?"),
    "lines": _class("\n"),
    "vowels": _class("aeiouAEIOU"),
    "non_ascii": np.arange(256) > 127,
    "letters": _LETTER,
}
_SPACE = _class("\t\n\x0b\x0c\r ")


def features(texts: list[str]) -> np.ndarray:
    """A row of numbers per whole text."""
    out = [np.zeros((0, len(FEATURES)), np.float32)]
    for a, b in text_chunks(texts):
        out.append(_features([t.encode("utf-8", "surrogatepass") for t in texts[a:b]]))
    return np.concatenate(out)


def _features(texts: list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    n = ends - begins

    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[ends] - total[begins]

    counts = {name: per_text(held[raw]) for name, held in _COUNTED.items()}
    space = _SPACE[raw]
    before = np.concatenate([[True], space[:-1]])
    starts, stops = np.flatnonzero(before & ~space), np.flatnonzero(space & ~before)
    length = (stops - starts).astype(np.float64)
    odd = np.concatenate([[0], np.cumsum(~_LETTER[raw], dtype=np.int64)])
    odd = odd[stops] - odd[starts]
    at = np.searchsorted(starts, np.append(begins, len(raw)))
    words = np.diff(at)

    def per_words(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
        return (total[at[1:]] - total[at[:-1]]) / np.maximum(words, 1)

    mean = per_words(length)
    hashes, _ = word_hashes(texts)
    shingles, first = shingle_hashes(texts)
    distinct, top, fresh, longest = (np.zeros(len(texts)) for _ in range(4))
    for i in range(len(texts)):
        if words[i]:
            seen = np.unique(hashes[at[i]:at[i + 1]], return_counts=True)[1]
            distinct[i], top[i] = len(seen) / words[i], seen.max() / words[i]
            longest[i] = length[at[i]:at[i + 1]].max()
            fresh[i] = len(np.unique(shingles[first[i]:first[i + 1]])) / (first[i + 1] - first[i])
    some, letters = np.maximum(n, 1), np.maximum(counts["letters"], 1)
    made = {
        "log_bytes": np.log1p(n), "log_words": np.log1p(words), "word_bytes": mean,
        "word_spread": np.sqrt(np.maximum(per_words(length * length) - mean * mean, 0)),
        "longest": np.log1p(longest), "upper": counts["upper"] / letters, "digits": counts["digits"] / some,
        "bangs": counts["bangs"] / np.maximum(words, 1), "bars": counts["bars"] / np.maximum(words, 1),
        "symbols": counts["symbols"] / some, "stops": counts["stops"] / np.maximum(words, 1),
        "lines": counts["lines"] / np.maximum(words, 1), "non_ascii": counts["non_ascii"] / some,
        "distinct_words": distinct, "top_word": top, "distinct_shingles": fresh,
        "short_words": per_words(length <= 3), "long_words": per_words(length >= 15),
        "plain_words": per_words(odd <= 1), "capital_words": per_words(_UPPER[raw[starts]]),
        "vowels": counts["vowels"] / letters,
    }
    return np.stack([made[name] for name in FEATURES], axis=1).astype(np.float32)


@dataclass
class AdditiveModel:
    """Cuts of each feature, a table per feature and a table per pair."""

    start: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        for j, (cuts, held) in enumerate(zip(self.cuts, self.tables)):
            total += held[np.searchsorted(cuts, x[:, j])]
        for (i, j), held in self.pairs.items():
            total += held[np.searchsorted(self.pair_cuts[i], x[:, i]), np.searchsorted(self.pair_cuts[j], x[:, j])]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _cuts(x: np.ndarray, bins: int) -> np.ndarray:
    """Bin borders between the values that stand at even shares of the rows."""
    return np.unique(np.quantile(x, np.arange(1, bins) / bins, method="inverted_cdf"))


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, damp: float) -> np.ndarray:
    """Newton step of a tree with a few leaves on ordered bins: a value per bin."""
    out = np.empty(len(g))
    borders = [0, len(g)]

    def best(a: int, b: int) -> tuple[float, int]:
        if b - a < 2:
            return 0.0, a
        gs, hs = np.cumsum(g[a:b]), np.cumsum(h[a:b])
        left = gs[:-1] ** 2 / (hs[:-1] + damp)
        right = (gs[-1] - gs[:-1]) ** 2 / (hs[-1] - hs[:-1] + damp)
        at = int(np.argmax(left + right))
        return float(left[at] + right[at] - gs[-1] ** 2 / (hs[-1] + damp)), a + at + 1

    while len(borders) <= leaves:
        gain, at = max(best(a, b) for a, b in zip(borders, borders[1:]))
        if gain <= 1e-9:
            break
        borders = sorted([*borders, at])
    for a, b in zip(borders, borders[1:]):
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + damp)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, damp: float) -> tuple[float, np.ndarray]:
    """The best cut of a grid into four quadrants: its gain and a value per cell."""
    gs = np.pad(g, ((1, 0), (1, 0))).cumsum(0).cumsum(1)
    hs = np.pad(h, ((1, 0), (1, 0))).cumsum(0).cumsum(1)

    def quarters(s: np.ndarray) -> list[np.ndarray]:
        a, up, left, whole = s[1:-1, 1:-1], s[1:-1, -1:], s[-1:, 1:-1], s[-1, -1]
        return [a, up - a, left - a, whole - up - left + a]

    if min(g.shape) < 2:
        return 0.0, np.zeros_like(g)
    gain = sum(x * x / (y + damp) for x, y in zip(quarters(gs), quarters(hs)))
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    out = np.empty_like(g)
    for rows in (slice(0, i + 1), slice(i + 1, None)):
        for columns in (slice(0, j + 1), slice(j + 1, None)):
            out[rows, columns] = g[rows, columns].sum() / (h[rows, columns].sum() + damp)
    return float(gain[i, j]), out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, rate: float = RATE, pairs: int = PAIRS) -> AdditiveModel:
    """Fit by cyclic boosting on the logistic loss; the same rows give the same model.

    Without rows the score is 0.5 everywhere; with one label only it is near it.
    """
    damp = 4.0
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = AdditiveModel(start=float(np.log(share / (1 - share))) if len(y) else 0.0)
    if not len(y) or y.min() == y.max():
        return model
    width = x.shape[1]
    model.cuts = [_cuts(x[:, j], BINS) for j in range(width)]
    model.pair_cuts = [_cuts(x[:, j], PAIR_BINS) for j in range(width)]
    fine = [np.searchsorted(model.cuts[j], x[:, j]) for j in range(width)]
    coarse = [np.searchsorted(model.pair_cuts[j], x[:, j]) for j in range(width)]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    margin = np.full(len(y), model.start)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-margin))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j in range(width):
            g, h = slopes()
            size = len(model.tables[j])
            step = rate * _tree(np.bincount(fine[j], g, size), np.bincount(fine[j], h, size), 3, damp)
            model.tables[j] += step
            margin += step[fine[j]]

    def grid(i: int, j: int, values: np.ndarray) -> np.ndarray:
        shape = (len(model.pair_cuts[i]) + 1, len(model.pair_cuts[j]) + 1)
        return np.bincount(coarse[i] * shape[1] + coarse[j], values, shape[0] * shape[1]).reshape(shape)

    g, h = slopes()
    gains = {(i, j): _quadrants(grid(i, j, g), grid(i, j, h), damp)[0] for i in range(width) for j in range(i)}
    chosen = sorted(gains, key=lambda p: (-gains[p], p))[:pairs]
    model.pairs = {(i, j): np.zeros((len(model.pair_cuts[i]) + 1, len(model.pair_cuts[j]) + 1)) for i, j in chosen}
    for _ in range(rounds // 2):
        for i, j in chosen:
            g, h = slopes()
            step = rate * _quadrants(grid(i, j, g), grid(i, j, h), damp)[1]
            model.pairs[i, j] += step
            margin += step[coarse[i], coarse[j]]
    return model


def is_held_out(key: str = "doc_id"):
    """Rows kept out of training: crc32 of the id's text is 2 modulo 4."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> AdditiveModel:
    """Fit on about ``rows`` labelled documents that are not held out.

    The bound is on the rows that reach the driver, as numbers; which rows they
    are follows from a hash of doc_id, not from the layout of the tables. Null
    labels and ids are left out; a text with two labels counts twice.
    """
    usable = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out())
    usable = usable.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("quality"))
    many = usable.count()
    span = 1 << 30
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(span)) < int(span * min(1.0, rows / max(many, 1)))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    chosen = texts.join(F.broadcast(usable.where(chance)), "doc_id").select("doc_id", "quality", "text")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(batch.column(2).to_pylist())
            yield pa.record_batch([batch.column(0), batch.column(1), *x.T], ["doc_id", "quality", *FEATURES])

    shape = "doc_id long, quality double, " + ", ".join(f"{f} float" for f in FEATURES)
    table = chosen.mapInArrow(resting(measure), shape).toArrow()
    table = table.sort_by([(name, "ascending") for name in ("doc_id", "quality", "log_bytes", "word_bytes")])
    x = np.stack([table.column(f).to_numpy() for f in FEATURES], axis=1)
    return fit(x, table.column("quality").to_numpy())


def score(docs: DataFrame, model: AdditiveModel) -> DataFrame:
    """doc_id, score and predicted of every whole text; null texts are empty ones."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_encoders()
        for batch in batches:
            got = model.score(features(batch.column(1).to_pylist()))
            yield pa.record_batch({
                "doc_id": batch.column(0), "score": pa.array(got, pa.float64()),
                "predicted": pa.array((got >= GOOD).astype(np.int32)),
            })

    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    return rows.mapInArrow(resting(judge), "doc_id long, score double, predicted int")


def kept(docs: DataFrame, model: AdditiveModel) -> DataFrame:
    """The documents that the model calls good, with all their columns."""
    names = docs.columns
    rows = docs.withColumn("_text", text_or_empty())

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_encoders()
        for batch in batches:
            for a in range(0, batch.num_rows, _ROWS):
                part = batch.slice(a, _ROWS)
                got = model.score(features(part.column(part.num_columns - 1).to_pylist()))
                held = part.filter(pa.array(got >= GOOD))
                yield pa.record_batch(held.columns[:-1], names)

    return rows.mapInArrow(resting(sift), docs.schema)

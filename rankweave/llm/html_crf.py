"""Main text of web pages: a linear-chain conditional random field over leaf blocks.

A block is part of the article or not. Its features are the tags and names it
stands under and its text; neighbouring labels are scored together; the most
likely labels of a page are found by the Viterbi algorithm.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .html_blocks import Block, blocks
from .html_pages import labelled_pages

TRAIN_PAGES = 400
_TAGS = ("article main section nav header footer aside form fieldset table ul ol li td p div h1 h2 h3 h4 "
         "blockquote pre figure dl").split()
_NAMED = {
    "advert": r"\bads?\b|\bad[-_]|[-_]ads?\b|advert|sponsor|promo|banner",
    "menu": r"nav|menu|breadcrumb|toc\b|pager|pagination",
    "head": r"header|masthead|\btop|logo|branding",
    "foot": r"foot|copyright|legal|colophon",
    "side": r"side|widget|rail\b|related|recommend|trending|popular",
    "comment": r"comment|repl(?:y|ies)|disqus|discussion|respond",
    "notice": r"notice|cookie|consent|gdpr|alert|warning|popup|modal|message",
    "form": r"form|search|subscri|newsletter|signup|login|contact",
    "share": r"share|social|\btags?\b|meta\b|byline",
    "content": r"content|article|post|entry|story|\bmain|\bbody|\btext",
}
_NAME_PATTERNS = {k: re.compile(v) for k, v in _NAMED.items()}
_TEXT = ("long middling short one_word ends_stop all_linked half_linked copyright commas digits first early late "
         "last outside_article outside_main").split()
FEATURES = [f"in_{t}" for t in _TAGS] + [f"own_{t}" for t in _TAGS] + [f"named_{k}" for k in _NAMED] + _TEXT + ["always"]
_AT = {f: i for i, f in enumerate(FEATURES)}
_MARKUP = len(_TAGS) * 2 + len(_NAMED)


def block_features(page: list[Block]) -> np.ndarray:
    """A row of 0/1 features per block of a page."""
    out = np.zeros((len(page), len(FEATURES)), np.float32)
    paths: dict[tuple, list[int]] = {}
    has_article = any("article" in b.path for b in page)
    has_main = any("main" in b.path for b in page)
    for i, b in enumerate(page):
        key = (b.path, b.names)
        on = paths.get(key)
        if on is None:
            on = [_AT[f"in_{t}"] for t in set(b.path) if f"in_{t}" in _AT]
            if b.path and f"own_{b.path[-1]}" in _AT:
                on.append(_AT[f"own_{b.path[-1]}"])
            on += [_AT[f"named_{k}"] for k, p in _NAME_PATTERNS.items() if b.names and p.search(b.names)]
            if has_article and "article" not in b.path:
                on.append(_AT["outside_article"])
            if has_main and "main" not in b.path:
                on.append(_AT["outside_main"])
            on.append(_AT["always"])
            paths[key] = on
        text, n = b.text, len(b.text)
        words = text.count(" ") + 1
        flags = on + [_AT["long" if n >= 250 else "middling" if n >= 80 else "short"]]
        if words == 1:
            flags.append(_AT["one_word"])
        if text[-1] in ".!?:…\"»”":
            flags.append(_AT["ends_stop"])
        if b.linked * 10 >= n * 9:
            flags.append(_AT["all_linked"])
        elif b.linked * 2 >= n:
            flags.append(_AT["half_linked"])
        if "©" in text or "copyright" in text[:60].lower():
            flags.append(_AT["copyright"])
        if "," in text:
            flags.append(_AT["commas"])
        if any(map(str.isdigit, text[:40])):
            flags.append(_AT["digits"])
        place = (i + 0.5) / len(page)
        if i == 0:
            flags.append(_AT["first"])
        if i == len(page) - 1:
            flags.append(_AT["last"])
        if place < 0.2:
            flags.append(_AT["early"])
        elif place > 0.8:
            flags.append(_AT["late"])
        out[i, flags] = 1
    return out


@dataclass
class ChainModel:
    """Weights of each feature per label, of label pairs, and of the first label."""

    weights: np.ndarray
    moves: np.ndarray
    begin: np.ndarray

    def decode(self, x: np.ndarray) -> np.ndarray:
        """The most likely labels of a page (Viterbi)."""
        if not len(x):
            return np.zeros(0, np.int64)
        scores = (x @ self.weights).tolist()
        (m00, m01), (m10, m11) = self.moves.tolist()
        a, b = scores[0][0] + self.begin[0], scores[0][1] + self.begin[1]
        came: list[tuple[int, int]] = []
        for s0, s1 in scores[1:]:
            x0, y0, x1, y1 = a + m00, b + m10, a + m01, b + m11
            came.append((int(y0 > x0), int(y1 > x1)))
            a, b = max(x0, y0) + s0, max(x1, y1) + s1
        labels = [int(b > a)]
        for back in reversed(came):
            labels.append(back[labels[-1]])
        return np.array(labels[::-1])


def train(pages: list[tuple[str, list[int]]], steps: int = 250, rate: float = 0.1, decay: float = 1e-3) -> ChainModel:
    """Fit by gradient steps on the log-likelihood, marginals by forward-backward.

    Every page counts once more with half of its markup features hidden, so that
    the text features carry pages whose markup says nothing.
    """
    rng = np.random.default_rng(7)
    rows, labels = [], []
    for html, held in pages:
        found = blocks(html)
        if len(found) != len(held) or not found:
            continue
        x = block_features(found)
        for hide in (0.0, 0.5):
            y = x.copy()
            y[:, :_MARKUP] *= rng.random(_MARKUP) >= hide
            if hide:
                y[:, [_AT["outside_article"], _AT["outside_main"]]] *= rng.random(2) >= hide
            rows.append(y)
            labels.append(np.array(held))
    n, most, width = len(rows), max(map(len, rows), default=1), len(FEATURES)
    x = np.zeros((n, most, width), np.float32)
    y = np.zeros((n, most), np.int64)
    there = np.zeros((n, most), bool)
    for i, (a, b) in enumerate(zip(rows, labels)):
        x[i, : len(a)], y[i, : len(a)], there[i, : len(a)] = a, b, True
    model = ChainModel(np.zeros((width, 2)), np.zeros((2, 2)), np.zeros(2))
    if not n:
        return model
    truth = np.eye(2)[y] * there[..., None]
    seen_w = np.einsum("ntd,ntk->dk", x, truth)
    seen_m = np.einsum("nta,ntb->ab", truth[:, :-1], truth[:, 1:])
    seen_b = truth[:, 0].sum(axis=0)
    params = [model.weights, model.moves, model.begin]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    total = there.sum()
    for step in range(1, steps + 1):
        e = np.exp(x @ model.weights)
        m = np.exp(model.moves)
        forward, backward = np.ones((n, most, 2)), np.ones((n, most, 2))
        forward[:, 0] = e[:, 0] * np.exp(model.begin)
        forward[:, 0] /= forward[:, 0].sum(axis=1, keepdims=True)
        for t in range(1, most):
            f = (forward[:, t - 1] @ m) * e[:, t]
            forward[:, t] = np.where(there[:, t, None], f / f.sum(axis=1, keepdims=True), forward[:, t - 1])
        for t in range(most - 2, -1, -1):
            b = (e[:, t + 1] * backward[:, t + 1]) @ m.T
            backward[:, t] = np.where(there[:, t + 1, None], b / b.sum(axis=1, keepdims=True), 1.0)
        single = forward * backward
        single *= there[..., None] / single.sum(axis=2, keepdims=True)
        pair = forward[:, :-1, :, None] * m * (e * backward)[:, 1:, None, :]
        pair *= there[:, 1:, None, None] / pair.sum(axis=(2, 3), keepdims=True)
        slopes = [
            (seen_w - np.einsum("ntd,ntk->dk", x, single)) / total - decay * model.weights,
            (seen_m - pair.sum(axis=(0, 1))) / total - decay * model.moves,
            (seen_b - single[:, 0].sum(axis=0)) / total - decay * model.begin,
        ]
        for p, g, a, b in zip(params, slopes, first, second):
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            p += rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-9)
    return model


def trained(pages: int = TRAIN_PAGES) -> ChainModel:
    """The model fitted on so many labelled pages; the same for the same number."""
    return train(labelled_pages(pages))


def main_text(model: ChainModel, html: str | None) -> str:
    """Article blocks of a whole page in page order, one a line; empty if there are none."""
    found = blocks(html)
    if not found:
        return ""
    labels = model.decode(block_features(found))
    return "\n".join(b.text for b, keep in zip(found, labels) if keep)


def extract(pages: DataFrame, model: ChainModel) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page.

    A null or empty html has an empty text. Rows are taken one by one, so
    repeated rows have equal results. Other columns are not read.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(model, html) for html in batch.column(2).to_pylist()]
            yield pa.record_batch({
                "page_id": batch.column(0), "url": batch.column(1), "text": pa.array(texts, pa.string()),
                "n_chars": pa.array([len(t) for t in texts], pa.int64()),
            })

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html")
    return rows.mapInArrow(read, "page_id long, url string, text string, n_chars long")

"""Removal of repeated 200-byte strings by bounded interval expansion.

Every window of 200 bytes has an anchor: the 100 bytes in it with the smallest
hash. Equal windows have equal anchors at equal offsets, so windows only need to
meet under their anchor. Windows that follow each other mostly share an anchor
and make one block of text. Blocks met under an anchor that are equal are
repeats as a whole. Where the blocks of an anchor differ, their texts are put
together; a Burrows-Wheeler transform of them is extended backwards, interval
by interval, breadth first, which gives the common prefixes of neighbouring
suffixes by increasing length. What is still open at 200 is a repeat.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.runtime import is_small

from .common import _BYTE, _powers, chunk_home, mixed, stored, text_or_empty
from .ngram_join import _batches, _from_planes, _planes, _runs, _schema

LENGTH = 200
ANCHOR = 100
# Bytes hashed at a time, and bytes of text under one chunk number.
PIECE = 1 << 21
CHUNK = 1 << 24
KEPT_BITS = 40
# An anchor with more different blocks is cut into its windows, which meet by themselves.
MOST_BLOCKS = 2048
# Bytes of block texts under one transform.
TRANSFORM = 1 << 21
MAX_ROWS = 2_000_000

REPEAT, ASKED, CUT = 1, 2, 4


# -- common prefixes ---------------------------------------------------------------


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes by their first ``depth`` codes or more, by doubling."""
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    n, step = len(codes), 1
    while step < depth:
        after = np.zeros(n, np.int64)
        after[: max(n - step, 0)] = rank[step:] + 1
        keys = rank * (n + 2) + after
        order = np.argsort(keys, kind="stable")
        held = keys[order]
        rank[order] = np.cumsum(np.concatenate([[0], held[1:] != held[:-1]]))
        if n == 0 or rank[order[-1]] == n - 1:
            break
        step *= 2
    return order


def long_prefixes(codes: np.ndarray, length: int) -> np.ndarray:
    """Positions whose next ``length`` codes also start elsewhere.

    ``codes`` has a separator of its own after each text, so that no common
    prefix passes one. ``known[i]`` says that the common prefix of the suffixes
    i-1 and i of the order is shorter than the lengths tried so far; expansion
    goes on from the intervals that newly tell two suffixes apart, and stops at
    ``length``.
    """
    n = len(codes)
    if n == 0:
        return np.zeros(0, np.int64)
    order = suffix_array(codes, length)
    before = codes[order - 1]  # the text is a ring; every text ends with its own separator
    # Where the suffix one code longer stands: the ranks of all suffixes shifted.
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    longer = rank[(order - 1) % n]
    known = np.zeros(n + 1, bool)
    known[0] = known[n] = True
    lows, highs = np.array([0]), np.array([n])
    for _ in range(length):
        if not len(lows):
            break
        widths = highs - lows
        owner = np.repeat(np.arange(len(lows)), widths)
        at = np.arange(widths.sum()) - np.repeat(np.cumsum(widths) - widths, widths) + lows[owner]
        symbol, to = before[at], longer[at]
        keys = np.lexsort((to, symbol, owner))
        symbol, owner, to = symbol[keys], owner[keys], to[keys]
        first = np.concatenate([[True], (symbol[1:] != symbol[:-1]) | (owner[1:] != owner[:-1])])
        starts = np.flatnonzero(first)
        new_low, new_high = to[starts], to[np.append(starts[1:], len(to)) - 1] + 1
        fresh = ~known[new_high]
        known[new_high] = True
        # Intervals at the end of the order have no suffix after them, but their extensions may.
        fresh |= (new_high == n) & ~((new_low == 0) & (new_high == n))
        keep = fresh
        lows, highs = new_low[keep], new_high[keep]
    same = ~known[1:n]
    out = np.zeros(n, bool)
    out[order[:-1][same]] = True
    out[order[1:][same]] = True
    return np.flatnonzero(out)


def repeats_in(texts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """Per text, the starts of its strings of ``length`` bytes that occur again in these texts."""
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes + 1)
    codes = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
    raw = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    codes[:] = raw[: len(codes)]
    codes[ends - 1] = 256 + np.arange(len(texts))
    found = long_prefixes(codes, length)
    cuts = np.searchsorted(found, np.concatenate([[0], ends]))
    return [found[a:b] - e for a, b, e in zip(cuts[:-1], cuts[1:], np.concatenate([[0], ends[:-1]]))]


# -- anchors -------------------------------------------------------------------------


def _sums(raw: np.ndarray) -> np.ndarray:
    """Running polynomial sums: the hash of any stretch from two of them."""
    up, _ = _powers(len(raw) + 1)
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[raw] * up[: len(raw)], dtype=np.uint64)])


def _stretches(total: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = _powers(len(total))
    return mixed((total[ends] - total[starts]) * down[starts])


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` values in a row, by running minima within and across cells."""
    n = len(values) - width + 1
    size = -(-len(values) // width) * width
    held = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    held[: len(values)] = values
    cells = held.reshape(-1, width)
    left = np.minimum.accumulate(cells, axis=1).ravel()
    right = np.minimum.accumulate(cells[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1:width - 1 + n])


def block_table(pieces: list[bytes], length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Blocks of the pieces: piece, first and last start in it, anchor hash, hash of the block's text.

    A block is a run of window starts in one piece with the same anchor. The
    anchor's place in the block is part of the text's hash.
    """
    raw = np.frombuffer(b"".join(pieces), np.uint8)
    sizes = np.array([len(p) for p in pieces], np.int64)
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    if len(raw) < length:
        return none
    total = _sums(raw)
    at = np.arange(len(raw) - anchor + 1)
    hashes = _stretches(total, at, at + anchor)
    low = np.uint64((1 << 24) - 1)
    least = _sliding_least((hashes & ~low) | at.astype(np.uint64), length - anchor + 1)
    anchors = (least & low).astype(np.int64)
    begins = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(pieces)), np.maximum(sizes - length + 1, 0))
    if not len(owner):
        return none
    counts = np.bincount(owner, minlength=len(pieces))
    start = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + begins[owner]
    held = anchors[start]
    new = np.flatnonzero(np.concatenate([[True], (held[1:] != held[:-1]) | (owner[1:] != owner[:-1])]))
    last = np.append(new[1:], len(owner)) - 1
    first_at, last_at, a = start[new], start[last], held[new]
    text = _stretches(total, first_at, last_at + length)
    text = mixed(text + (a - first_at).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (last_at - first_at).astype(np.uint64))
    piece = owner[new]
    return piece, first_at - begins[piece], last_at - begins[piece], hashes[a], text


_CUT = "kind int, fragment int, chunk long, anchors binary, texts binary, places binary, flags binary, ids binary, keys binary"
_NAMES = [c.split()[0] for c in _CUT.split(", ")]
_PLACE = np.dtype([("doc", "<u4"), ("first", "<i8"), ("more", "<u2")])
_ASK = np.dtype([("first", "<i8"), ("more", "<u2"), ("flag", "u1"), ("group", "<u8")])


def _row(**held) -> dict:
    return {c: held.get(c) for c in _NAMES}


def _chunk(texts: list[bytes], ids: list, keys: list[int], chunk: int, bits: int) -> Iterator[dict]:
    """Blocks of a chunk by fragment of their anchors, one of each kind; copies stay here."""
    tables, pieces, owners, offsets, size = [], [], [], [], 0

    def close() -> None:
        nonlocal pieces, owners, offsets, size
        if pieces:
            piece, first, last, anchors, held = block_table(pieces)
            places = np.zeros(len(piece), _PLACE)
            places["doc"], places["first"] = np.array(owners)[piece], np.array(offsets)[piece] + first
            places["more"] = last - first
            tables.append((anchors, held, places))
        pieces, owners, offsets, size = [], [], [], 0

    for i, text in enumerate(texts):
        for a in range(0, len(text) - LENGTH + 1, PIECE):
            part = text[a:a + PIECE + LENGTH - 1]
            pieces.append(part)
            owners.append(i)
            offsets.append(a)
            size += len(part)
            if size >= PIECE:
                close()
    close()
    joined = [np.concatenate(c) for c in zip(*tables)] if tables else [np.zeros(0, np.uint64)] * 2 + [np.zeros(0, _PLACE)]
    anchors, held, places = joined
    anchors = anchors >> np.uint64(64 - bits - KEPT_BITS)
    order = np.lexsort((held, anchors))
    anchors, held, places = anchors[order], held[order], places[order]
    new = np.concatenate([[True], (anchors[1:] != anchors[:-1]) | (held[1:] != held[:-1])]) if len(anchors) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    counts = np.diff(np.append(starts, len(anchors)))
    several = np.repeat(counts > 1, counts)
    nulls = np.array([i is None for i in ids], np.uint8)
    yield _row(kind=1, fragment=chunk_home(chunk, 1 << bits), chunk=chunk, places=places[several].tobytes(),
               flags=nulls.tobytes(), ids=np.array([i or 0 for i in ids], "<i8").tobytes(),
               keys=np.array(keys, "<i8").tobytes())
    anchors, held, places, many = anchors[starts], held[starts], places[starts], (counts > 1).astype(np.uint8)
    cuts = np.append(np.searchsorted(anchors, np.arange(1 << bits, dtype=np.uint64) << np.uint64(KEPT_BITS)), len(anchors))
    low = np.uint64((1 << KEPT_BITS) - 1)
    for f in np.flatnonzero(np.diff(cuts)):
        a, b = cuts[f], cuts[f + 1]
        yield _row(kind=0, fragment=int(f), chunk=chunk, anchors=_planes(anchors[a:b] & low),
                   texts=held[a:b].astype("<u8").tobytes(), places=places[a:b].tobytes(), flags=many[a:b].tobytes())


def _met(rows: list[dict]) -> Iterator[dict]:
    """What the blocks of a fragment are: repeats, to be asked for their text, to be cut."""
    sizes = [len(r["flags"]) for r in rows]
    anchors = np.concatenate([_from_planes(r["anchors"]) for r in rows])
    texts = np.concatenate([np.frombuffer(r["texts"], "<u8") for r in rows])
    many = np.concatenate([np.frombuffer(r["flags"], np.uint8) for r in rows])
    order = np.lexsort((texts, anchors))
    a, t, m = anchors[order], texts[order], many[order]
    new_a = np.concatenate([[True], a[1:] != a[:-1]])
    new_t = np.concatenate([[True], new_a[1:] | (t[1:] != t[:-1])])
    group, kind = np.cumsum(new_a) - 1, np.cumsum(new_t) - 1
    copies = np.bincount(kind, weights=1 + m)[kind]
    kinds = np.bincount(group[new_t])[group]
    flag = np.where(copies > 1, REPEAT, 0) | np.where(new_t & (kinds > 1), np.where(kinds > MOST_BLOCKS, ASKED | CUT, ASKED), 0)
    flags = np.empty(len(order), np.uint8)
    flags[order] = flag
    begin = 0
    for row, size in zip(rows, sizes):
        keep = np.flatnonzero(flags[begin:begin + size])
        if len(keep):
            yield _row(kind=0, fragment=row["fragment"], chunk=row["chunk"],
                       anchors=_planes(anchors[begin:begin + size][keep]), flags=flags[begin:begin + size][keep].tobytes(),
                       places=np.frombuffer(row["places"], _PLACE)[keep].tobytes())
        begin += size


_DOCS = "doc_id long, key long, repeats binary, asks binary"


def _assembled(rows: list[dict]) -> Iterator[dict]:
    """Per document of a chunk, the starts that are repeats and the blocks to ask for."""
    head = next(r for r in rows if r["kind"] == 1)
    ids, keys = np.frombuffer(head["ids"], "<i8"), np.frombuffer(head["keys"], "<i8")
    nulls = np.frombuffer(head["flags"], np.uint8)
    places = [np.frombuffer(head["places"], _PLACE)]
    flags, groups = [np.full(len(places[0]), REPEAT, np.uint8)], [np.zeros(len(places[0]), np.uint64)]
    for r in rows:
        if r["kind"] == 0:
            places.append(np.frombuffer(r["places"], _PLACE))
            flags.append(np.frombuffer(r["flags"], np.uint8))
            groups.append(_from_planes(r["anchors"]) | np.uint64(r["fragment"] << KEPT_BITS))
    places, flags, groups = (np.concatenate(x) for x in (places, flags, groups))
    order = np.argsort(places["doc"], kind="stable")
    places, flags, groups = places[order], flags[order], groups[order]
    cuts = np.searchsorted(places["doc"], np.arange(len(ids) + 1))
    for i in np.flatnonzero(np.diff(cuts)):
        p, f, g = (x[cuts[i]:cuts[i + 1]] for x in (places, flags, groups))
        whole, asked = (f & REPEAT) > 0, (f & ASKED) > 0
        spans = np.stack([p["first"][whole], p["first"][whole] + p["more"][whole] + LENGTH], axis=1)
        asks = np.zeros(int(asked.sum()), _ASK)
        asks["first"], asks["more"], asks["flag"], asks["group"] = p["first"][asked], p["more"][asked], f[asked], g[asked]
        yield {"doc_id": None if nulls[i] else int(ids[i]), "key": int(keys[i]),
               "repeats": merged(spans).astype("<i8").tobytes(), "asks": asks.tobytes() if len(asks) else None}


def merged(spans: np.ndarray) -> np.ndarray:
    """Spans (begin, end) that overlap or touch as one, in order."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.flatnonzero(np.concatenate([[True], spans[1:, 0] > reach[:-1]]))
    return np.stack([spans[new, 0], reach[np.append(new[1:], len(spans)) - 1]], axis=1)


# -- over a table ----------------------------------------------------------------------


def _with_key(docs: DataFrame) -> DataFrame:
    """doc_id, a key of the text, and the text. Rows of equal id and text have equal results."""
    text = text_or_empty()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("text"))


def _near(docs: DataFrame, found: DataFrame, how: str = "left_semi") -> DataFrame:
    """Documents with (or without) a row in ``found``; the keys are broadcast where their count allows it."""
    keys = found.select(F.xxhash64(F.coalesce("doc_id", F.lit(-1)), "key").alias("_k")).distinct()
    small = is_small(keys, max_rows=MAX_ROWS, max_bytes=64 * MAX_ROWS)
    held = docs.withColumn("_k", F.xxhash64(F.coalesce("doc_id", F.lit(-1)), "key"))
    return held.join(F.broadcast(keys) if small else keys, "_k", how).drop("_k")


def _joined(docs: DataFrame, found: DataFrame, columns: list[str]) -> DataFrame:
    d, f = docs.alias("d"), found.alias("f")
    same = F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.key") == F.col("f.key"))
    return d.join(f, same).select("d.doc_id", "d.key", "d.text", *[f"f.{c}" for c in columns])


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, key, spans): bytes that some repeated 200-byte string covers, as begin and end pairs."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = max(6, (2 * parts - 1).bit_length())
    shape, out = _schema(_CUT), _schema(_DOCS)
    rows = _with_key(docs)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 24
        for batch in batches:
            ids, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            texts = [t.encode("utf-8", "surrogatepass") for t in batch.column(2).to_pylist()]
            begin = size = 0
            for i, text in enumerate(texts, 1):
                size += len(text)
                if size >= CHUNK or i == len(texts):
                    yield from _batches(_chunk(texts[begin:i], ids[begin:i], keys[begin:i], chunk, bits), shape)
                    begin, size, chunk = i, 0, chunk + 1

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for _, run in _runs(batches, "fragment"):
                yield from (r for r in run if r["kind"] == 1)
                pieces = [r for r in run if r["kind"] == 0]
                if pieces:
                    yield from _met(pieces)

        yield from _batches(rows(), shape)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches((r for _, run in _runs(batches, "chunk") for r in _assembled(run)), out)

    pieces = rows.mapInArrow(cut, _CUT).repartition(parts, "fragment").sortWithinPartitions("fragment")
    known = pieces.mapInArrow(meet, _CUT).repartition(parts, "chunk").sortWithinPartitions("chunk")
    known = stored(known.mapInArrow(assemble, _DOCS), "repeats")

    # Rows of equal id and text may each be asked for a part of the blocks.
    asking = known.where(F.col("asks").isNotNull()).groupBy("doc_id", "key").agg(F.collect_list("asks").alias("asks"))
    block = "part long, doc_id long, key long, first long, cut int, text binary"

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for batch in batches:
                for doc_id, key, text, asks in zip(*(c.to_pylist() for c in batch.columns)):
                    raw = text.encode("utf-8", "surrogatepass")
                    for ask in np.frombuffer(b"".join(asks), _ASK):
                        first = int(ask["first"])
                        yield {"part": int(ask["group"].astype(np.int64)), "doc_id": doc_id, "key": key, "first": first,
                               "cut": int(ask["flag"] & CUT), "text": raw[first:first + int(ask["more"]) + LENGTH]}

        yield from _batches(rows(), _schema(block))

    texts = _joined(_near(rows, asking), asking, ["asks"]).mapInArrow(blocks, block)
    texts = stored(texts, "blocks")
    span = "doc_id long, key long, begin long, end long"

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def close() -> Iterator[dict]:
            for row, starts in zip(held, repeats_in([r["text"] for r in held])):
                for a, b in merged(np.stack([starts, starts + 1], axis=1)) if len(starts) else ():
                    yield {"doc_id": row["doc_id"], "key": row["key"], "begin": row["first"] + int(a),
                           "end": row["first"] + int(b) - 1 + LENGTH}

        for _, run in _runs(batches, "part"):
            held += run
            size += sum(len(r["text"]) for r in run)
            if size >= TRANSFORM:
                yield from _batches(close(), _schema(span))
                held, size = [], 0
        if held:
            yield from _batches(close(), _schema(span))

    whole = texts.where("cut = 0").drop("cut").repartition(parts, "part").sortWithinPartitions("part")
    found = stored(whole.mapInArrow(expand, span), "block-repeats")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, key, first, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "key", "first", "text"))):
                total, at = _sums(np.frombuffer(text, np.uint8)), np.arange(len(text) - LENGTH + 1)
                hashes = _stretches(total, at, at + LENGTH)
                n = len(at)
                yield pa.record_batch({
                    "window": pa.array(hashes.astype(np.int64)), "doc_id": pa.array([doc_id] * n, pa.int64()),
                    "key": pa.array([key] * n, pa.int64()), "begin": pa.array(first + at, pa.int64()),
                })

    cut_ones = texts.where("cut > 0").mapInArrow(windows, "window long, doc_id long, key long, begin long")
    again = cut_ones.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
    more = cut_ones.join(again, "window").select("doc_id", "key", "begin", (F.col("begin") + LENGTH).alias("end"))
    joined = found.unionByName(more).groupBy("doc_id", "key").agg(F.collect_list(F.struct("begin", "end")).alias("later"))
    base = known.dropDuplicates(["doc_id", "key"]).select("doc_id", "key", "repeats")
    b, j = base.alias("b"), joined.alias("j")
    same = F.col("b.doc_id").eqNullSafe(F.col("j.doc_id")) & (F.col("b.key") == F.col("j.key"))
    all_ = b.join(j, same, "left").select("b.doc_id", "b.key", "b.repeats", "j.later")

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for raw, later in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                held = np.frombuffer(raw, "<i8").reshape(-1, 2)
                new = np.array([(x["begin"], x["end"]) for x in later or ()], np.int64).reshape(-1, 2)
                spans.append(merged(np.concatenate([held, new])).astype("<i8").tobytes())
            yield pa.record_batch({"doc_id": batch.column(0), "key": batch.column(1), "spans": pa.array(spans, pa.binary())})

    united = all_.mapInArrow(unite, "doc_id long, key long, spans binary").where(F.octet_length("spans") > 0)
    return stored(united, "repeated-spans")


def remove_repeats(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document (and ``kept``, if asked).

    A byte goes when a 200-byte string over it also starts anywhere else, in the
    same document or another. Null texts are empty; texts under 200 bytes lose
    nothing; repeated rows are copies of each other; a null doc_id takes part.
    Other columns are not read. What is kept may end inside a character, so it
    is binary.
    """
    spans = repeated_spans(docs)
    rows = _with_key(docs)
    shape = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_text

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: dict[str, list] = {c.split()[0]: [] for c in shape.split(", ")}
            held = batch.column(3).to_pylist() if batch.num_columns > 3 else [b""] * batch.num_rows
            for doc_id, text, cut in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), held):
                raw = text.encode("utf-8", "surrogatepass")
                pairs = np.frombuffer(cut, "<i8").reshape(-1, 2)
                ends = [0, *pairs[:, 1].tolist()]
                rest = b"".join(raw[a:b] for a, b in zip(ends, [*pairs[:, 0].tolist(), len(raw)]))
                values = (doc_id, len(raw), len(raw) - len(rest), len(pairs), hashlib.sha256(rest).hexdigest(), rest)
                for column, value in zip(made.values(), values):
                    column.append(value)
            kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
            schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in shape.split(", ")])
            yield pa.RecordBatch.from_pydict(made, schema)

    with_spans = _joined(_near(rows, spans), spans, ["spans"]).mapInArrow(kept, shape)
    return _near(rows, spans, "left_anti").mapInArrow(kept, shape).unionByName(with_spans)

"""N-gram Jaccard join of documents by vertical partitioning.

The distinct word shingles of all documents stand in one global order. It is cut
into fragments; each fragment counts by itself in how many documents its
shingles occur, and the counts are summed per document. Only documents of which
enough shingles occur elsewhere can have a partner. Their rarest shingles give
candidates, and the overlap of a candidate pair is again counted fragment by
fragment and summed per pair.

Two documents link when |A and B| / |A or B| >= 3/4, which is 7 |A and B| >= 3
(|A| + |B|). Groups of near copies are first joined to one of their members
each; of the pairs left, only those between different groups are counted, so no
link between groups is lost and a group's pairs are not all made. Nor are the
pairs of a long list of sets that do not link: its sets meet in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.runtime import is_small

from .common import (
    WINDOW_BYTES,
    chunk_home,
    mixed,
    release_encoders,
    resting,
    shingle_hashes,
    stored,
    text_or_empty,
    text_slices,
)

WORDS = 5
# Bytes of text, and documents, whose shingles travel together.
CHUNK_CHARS = 1 << 24
CHUNK_DOCS = 1 << 16
# A shingle of so many documents of one chunk does not meet those of others in one place.
HOT = 64
HOT_CLASS = 255
# Kept bits of a shingle hash besides those that name its fragment.
KEPT_BITS = 40
# Cuts of the global order in which the overlap of a pair is counted.
PAIR_FRAGMENTS = 4
# Row numbers (8 bytes each) up to which a set of rows is broadcast.
MAX_ROWS = 2_000_000
# Members of a group up to which its pairs with other groups are made one by one;
# larger ones meet a set in blocks of about so many members.
MOST_PAIRED = 16
BLOCK_SETS = 512
# Sets of small groups up to which the pairs of a list are made one by one; those of
# longer lists meet in blocks, of about so many values at most.
MOST_LISTED = 64
BLOCK_VALUES = 1 << 20


def _planes(values: np.ndarray) -> bytes:
    """40-bit values byte plane by byte plane: planes of sorted values compress."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].T.tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(raw, np.uint8).reshape(5, -1).T
    return out.view("<u8").ravel()


def _classes(counts: np.ndarray) -> np.ndarray:
    """Document counts in classes, rarer first: eight to a doubling, below the hot class."""
    return np.minimum(8 * np.log2(np.maximum(counts, 1)), HOT_CLASS - 1).astype(np.uint8)


_CUT = "kind int, fragment int, chunk long, values binary, docs binary, more binary, ids binary, sizes binary, keys binary"
_COLUMNS = [c.split()[0] for c in _CUT.split(", ")]


def _row(**held) -> dict:
    return {c: held.get(c) for c in _COLUMNS}


def _chunk(texts: pa.Array, ids: list, chunk: int, bits: int, words: int) -> Iterator[dict]:
    """Shingles of a chunk by fragment, and the chunk's documents."""
    sets, keys = [], []
    for part in text_slices(pa.record_batch([texts], ["text"]), 0, WINDOW_BYTES):
        hashes, first = shingle_hashes(part.column(0).cast(pa.binary()).to_pylist(), words)
        for x, y in zip(first[:-1], first[1:]):
            own = np.unique(hashes[x:y])
            sets.append(own)
            two = np.array([mixed(own).sum(dtype=np.uint64), mixed(own * np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)])
            keys.append(two)
    sizes = np.array([len(s) for s in sets], "<i8")
    docs = np.repeat(np.arange(len(sizes), dtype="<u2"), sizes)
    values = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    del sets
    values >>= np.uint64(64 - bits - KEPT_BITS)
    order = np.argsort(values, kind="stable")
    values, docs = values[order], docs[order]
    del order
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, int)
    counts = np.diff(np.append(starts, len(values)))
    hot = np.repeat(counts >= HOT, counts)
    hot_values = values[starts[counts >= HOT]]
    nulls = np.array([i is None for i in ids], np.uint8)
    names = np.array([i or 0 for i in ids], "<i8")
    yield _row(kind=1, fragment=chunk_home(chunk, 1 << bits), chunk=chunk, values=values[hot].astype("<u8").tobytes(),
               docs=docs[hot].tobytes(), more=nulls.tobytes(), ids=names.tobytes(), sizes=sizes.tobytes(),
               keys=np.array(keys, "<u8").tobytes())
    values, docs = values[~hot], docs[~hot]
    limits = np.arange(1 << bits, dtype=np.uint64) << np.uint64(KEPT_BITS)
    cuts, hot_cuts = (np.append(np.searchsorted(v, limits), len(v)) for v in (values, hot_values))
    low = np.uint64((1 << KEPT_BITS) - 1)
    for f in range(1 << bits):
        a, b, c, d = cuts[f], cuts[f + 1], hot_cuts[f], hot_cuts[f + 1]
        if b > a or d > c:
            yield _row(kind=0, fragment=f, chunk=chunk, values=_planes(values[a:b] & low), docs=docs[a:b].tobytes(),
                       more=_planes(hot_values[c:d] & low))


def _batches(rows: Iterator[dict], schema: pa.Schema, most: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row.values() if isinstance(v, bytes))
        if size >= most or len(held) >= 4096:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


_KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def _schema(text: str) -> pa.Schema:
    return pa.schema([(c.split()[0], _KINDS[c.split()[1]]) for c in text.split(", ")])


def _fragment(rows: list[dict]) -> Iterator[dict]:
    """Shingles of one fragment that occur in two documents or more, back to their chunks."""
    parts = [_from_planes(r["values"]) for r in rows]
    values = np.concatenate(parts)
    flagged = np.unique(np.concatenate([_from_planes(r["more"]) for r in rows]))
    _, at, counts = np.unique(values, return_inverse=True, return_counts=True)
    kinds = _classes(counts)[at]
    kept = counts[at] > 1
    if len(flagged):
        hot = np.isin(values, flagged)
        kinds[hot], kept = HOT_CLASS, kept | hot
    begin = 0
    for row, part in zip(rows, parts):
        end = begin + len(part)
        keep = kept[begin:end]
        if keep.any():
            yield _row(kind=0, fragment=row["fragment"], chunk=row["chunk"], values=_planes(part[keep]),
                       docs=np.frombuffer(row["docs"], "<u2")[keep].tobytes(), more=kinds[begin:end][keep].tobytes())
        begin = end


_DOCS = "row long, doc_id long, n_shingles long, shared long, key binary, values binary"


def _assembled(chunk: int, rows: list[dict]) -> Iterator[dict]:
    """Documents of a chunk with the shingles that occur elsewhere, rarest first.

    The shingles of a document that cannot have a partner are left out.
    """
    head = next(r for r in rows if r["kind"] == 1)
    sizes = np.frombuffer(head["sizes"], "<i8")
    hot = np.frombuffer(head["values"], "<u8")
    values, docs, kinds = [hot], [np.frombuffer(head["docs"], "<u2")], [np.full(len(hot), HOT_CLASS, np.uint8)]
    for r in rows:
        if r["kind"] == 0:
            values.append(_from_planes(r["values"]) | np.uint64(r["fragment"] << KEPT_BITS))
            docs.append(np.frombuffer(r["docs"], "<u2"))
            kinds.append(np.frombuffer(r["more"], np.uint8))
    values, docs, kinds = (np.concatenate(x) for x in (values, docs, kinds))
    shared = np.bincount(docs, minlength=len(sizes))
    open_ = (4 * shared >= 3 * sizes) & (sizes > 0)
    keep = open_[docs]
    values, docs, kinds = values[keep], docs[keep], kinds[keep]
    order = np.lexsort((values, kinds, docs))
    values = values[order]
    ends = np.cumsum(np.bincount(docs, minlength=len(sizes)))
    nulls, names = np.frombuffer(head["more"], np.uint8), np.frombuffer(head["ids"], "<i8")
    for i in range(len(sizes)):
        begin = ends[i] - (shared[i] if open_[i] else 0)
        yield {
            "row": chunk << 16 | i, "doc_id": None if nulls[i] else int(names[i]), "n_shingles": int(sizes[i]),
            "shared": int(shared[i]), "key": head["keys"][16 * i:16 * i + 16],
            "values": values[begin:ends[i]].tobytes() if open_[i] else None,
        }


def _runs(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[int, list[dict]]]:
    """Consecutive rows of equal value."""
    at, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if held and row[column] != at:
                yield at, held
                held = []
            at = row[column]
            held.append(row)
    if held:
        yield at, held


def shared_shingles(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """A row per document: row number, doc_id, set size, shingles that occur elsewhere and how many.

    ``values`` has these shingles in the global order, 8 bytes each, where at
    least three quarters of the document's set occur elsewhere; else null.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = max(6, (2 * parts - 1).bit_length())
    shape, out = _schema(_CUT), _schema(_DOCS)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_encoders()
        chunk = TaskContext.get().partitionId() << 24
        for batch in batches:
            for part in text_slices(batch, 1, CHUNK_CHARS):
                for a in range(0, part.num_rows, CHUNK_DOCS):
                    held = part.slice(a, CHUNK_DOCS)
                    made = _chunk(held.column(1), held.column(0).to_pylist(), chunk, bits, words)
                    yield from _batches(made, shape, 1 << 22)
                    chunk += 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for _, run in _runs(batches, "fragment"):
                yield from (r for r in run if r["kind"] == 1)
                pieces = [r for r in run if r["kind"] == 0]
                if pieces:
                    yield from _fragment(pieces)

        yield from _batches(rows(), shape)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches((r for chunk, run in _runs(batches, "chunk") for r in _assembled(chunk, run)), out)

    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    pieces = rows.mapInArrow(resting(cut), _CUT).repartition(parts, "fragment").sortWithinPartitions("fragment")
    counted = pieces.mapInArrow(resting(count), _CUT).repartition(parts, "chunk").sortWithinPartitions("chunk")
    return stored(counted.mapInArrow(resting(assemble), _DOCS), "shared-shingles")


def _only(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows whose number is wanted; the numbers are broadcast where their count allows it."""
    small = is_small(wanted, max_rows=MAX_ROWS, max_bytes=64 * MAX_ROWS)
    return rows.join(F.broadcast(wanted) if small else wanted, "row", "left_semi")


def _prefixes(sets: DataFrame) -> DataFrame:
    """(value, row, n, shared, at): the first shingles of each set, of which any partner has one.

    Partners share at least 3/4 of a set, so they miss at most the rest; one
    shingle more than these, from the rare end, cannot be missed altogether.
    """

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 2048):
                part = batch.slice(a, 2048)
                rows, n, shared = (part.column(c).to_numpy() for c in range(3))
                most = shared - (3 * n + 3) // 4 + 1
                held = [np.frombuffer(v, "<i8")[:k] for v, k in zip(part.column(3).to_pylist(), most)]
                sizes = np.array([len(h) for h in held])
                at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                values = np.concatenate(held) if held else np.zeros(0, np.int64)
                yield pa.record_batch({
                    "value": pa.array(values, pa.int64()),
                    **{k: pa.array(np.repeat(v, sizes), pa.int64()) for k, v in (("row", rows), ("n", n), ("shared", shared))},
                    "at": pa.array(at, pa.int64()),
                })

    return sets.select("row", "n", "shared", "values").mapInArrow(resting(explode), "value long, row long, n long, shared long, at long")


def _possible(a: str, b: str, first: bool = False) -> Column:
    """Whether two sets that share the shingle at these places can overlap enough.

    At most the shingles before the nearer place, itself, and those after the
    farther one in the shorter rest. With ``first`` it is the first one that both
    have, so they share none before it; every pair that links has such a list.
    """
    x, y = (lambda c: F.col(f"{a}.{c}")), (lambda c: F.col(f"{b}.{c}"))
    most = 1 + F.least(x("shared") - x("at") - 1, y("shared") - y("at") - 1)
    most = most if first else F.least(x("at"), y("at")) + most
    return (7 * most >= 3 * (x("n") + y("n"))) & (4 * x("n") >= 3 * y("n")) & (4 * y("n") >= 3 * x("n"))


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose similarity is 3/4 or more.

    The values of a set are cut into fragments of the order; overlaps are
    counted in each and summed per pair.
    """
    wanted = pairs.select(F.col("a").alias("row")).union(pairs.select("b")).distinct()

    def fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                part = batch.slice(a, 1024)
                made = {"row": [], "n": [], "piece": [], "values": []}
                for row, n, raw in zip(*(part.column(c).to_pylist() for c in range(3))):
                    values = np.sort(np.frombuffer(raw, "<u8"))
                    piece = mixed(values) >> np.uint64(62)
                    for k in range(PAIR_FRAGMENTS):
                        made["row"].append(row)
                        made["n"].append(n)
                        made["piece"].append(k)
                        made["values"].append(values[piece == k].tobytes())
                yield pa.RecordBatch.from_pydict(made, _schema("row long, n long, piece int, values binary"))

    cut = _only(sets, wanted).select("row", "n", "values").mapInArrow(resting(fragments), "row long, n long, piece int, values binary")

    def overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())
            got = [len(np.intersect1d(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), assume_unique=True)) for x, y in both]
            yield pa.record_batch([*batch.columns[:4], pa.array(got, pa.int64())], [*batch.schema.names[:4], "partial"])

    x = cut.select(F.col("row").alias("a"), F.col("n").alias("na"), "piece", F.col("values").alias("x"))
    y = cut.select(F.col("row").alias("b"), F.col("n").alias("nb"), "piece", F.col("values").alias("y"))
    met = pairs.join(x, "a").join(y, ["b", "piece"]).select("a", "b", "na", "nb", "x", "y")
    counted = met.mapInArrow(resting(overlap), "a long, b long, na long, nb long, partial long")
    total = counted.groupBy("a", "b", "na", "nb").agg(F.sum("partial").alias("both"))
    return total.where(7 * F.col("both") >= 3 * (F.col("na") + F.col("nb"))).select("a", "b")


def _linked_to_groups(held: DataFrame, groups: DataFrame, sets: DataFrame) -> DataFrame:
    """A link (a, b) of a set to a member of every large group that shares a list with it, if there is one.

    The members of a group are dealt into blocks, the set meets each block, and
    one link a block is enough to join the groups; pairs are not made as rows.
    """
    large = stored(held.where(F.col("size") > MOST_PAIRED).select("value", "component", "size").distinct(), "large-groups")
    asks = held.alias("x").join(large.alias("g"), F.col("x.value") == F.col("g.value"))
    # Of two large groups the members of one ask for the other.
    other = (F.col("x.component") != F.col("g.component")) & (
        (F.col("x.size") <= MOST_PAIRED) | (F.col("x.component") < F.col("g.component")))
    blocks = F.ceil(F.col("g.size") / BLOCK_SETS)
    asks = asks.where(other).select("x.row", F.col("g.component").alias("component"), blocks.alias("blocks")).distinct()
    asks = stored(asks, "group-asks")
    met = asks.select("component", "blocks").distinct()
    members = groups.join(met, "component").select("row", "component", F.pmod(F.xxhash64("row"), "blocks").alias("block"))
    asking = asks.select("row", "component", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    both = members.withColumn("asks", F.lit(0)).unionByName(asking.withColumn("asks", F.lit(1)))
    both = both.join(sets.select("row", "n", "values"), "row").select("component", "block", "asks", "row", "n", "values")
    parts = int(held.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = both.repartition(parts, "component", "block").sortWithinPartitions("component", "block", "asks", "row")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows, sizes, values, cuts, links = None, [], [], [], None, []
        for batch in batches:
            for component, block, asks, row, n, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if (component, block) != at:
                    at, rows, sizes, values, cuts = (component, block), [], [], [], None
                own = np.frombuffer(raw, "<u8")
                if not asks:
                    rows.append(row)
                    sizes.append(n)
                    values.append(own)
                elif rows:
                    if cuts is None:
                        cuts = np.cumsum([0] + [len(v) for v in values])[:-1]
                        values, sizes = np.concatenate(values), np.array(sizes)
                    shared = np.add.reduceat(np.isin(values, own).astype(np.int64), cuts)
                    good = np.flatnonzero(7 * shared >= 3 * (sizes + n))
                    if len(good):
                        links.append((row, rows[good[0]]))
            if links:
                yield pa.record_batch({k: pa.array(v, pa.int64()) for k, v in zip("ab", zip(*links))})
                links = []

    return dealt.mapInArrow(resting(meet), "a long, b long")


def _with_partners(rows: DataFrame) -> DataFrame:
    """The rows of lists whose set can reach a partner that it meets there first, with their list's size.

    What it shares from the list's shingle on must be enough for the smallest set of the list.
    """
    least = rows.groupBy("value").agg(F.min("n").alias("least"))
    need = 3 * (F.col("n") + F.greatest("least", F.ceil(3 * F.col("n") / 4)))
    kept = rows.join(least, "value").where(7 * (F.col("shared") - F.col("at")) >= need).drop("least")
    sizes = kept.groupBy("value").agg(F.count("*").alias("many"), F.sum("shared").alias("weight"))
    return kept.join(sizes.where("many > 1"), "value")


class _Block:
    """Sets that others meet, by value; gives the links that join groups not joined so far."""

    def __init__(self, rows: list[int], groups: list[int], sizes: list[int], sets: list[np.ndarray]):
        self.rows, self.groups, self.sizes, self.sets = rows, np.array(groups, np.int64), np.array(sizes, np.int64), sets
        values = np.concatenate(sets)
        order = np.argsort(values, kind="stable")
        self.docs = np.repeat(np.arange(len(sets)), [len(v) for v in sets])[order]
        self.values, begins = np.unique(values[order], return_index=True)
        self.begins = np.append(begins, len(values))

    def links(self, row: int, group: int, n: int, own: np.ndarray) -> Iterator[tuple[int, int]]:
        if (self.groups == group).all():
            return
        at = np.minimum(np.searchsorted(self.values, own), len(self.values) - 1)
        at = at[self.values[at] == own]
        sizes = self.begins[at + 1] - self.begins[at]
        take = np.arange(sizes.sum()) + np.repeat(self.begins[at] - np.cumsum(sizes) + sizes, sizes)
        both = np.bincount(self.docs[take], minlength=len(self.rows))
        good = np.flatnonzero(7 * both >= 3 * (self.sizes + n))
        while len(good := good[self.groups[good] != group]):
            yield row, self.rows[good[0]]
            self.groups[self.groups == self.groups[good[0]]] = group

    def own_links(self) -> Iterator[tuple[int, int]]:
        for i, own in enumerate(self.sets):
            yield from self.links(self.rows[i], self.groups[i], self.sizes[i], own)


def _linked_in_lists(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between the groups of sets in long lists, enough to join all groups that link there.

    The sets of a list are dealt into blocks, each block meets itself and the
    sets of half the others; pairs are not made as rows. Blocks grow with the
    root of a list, up to BLOCK_VALUES, so that its sets are sent less often.
    """
    block_sets = F.greatest(F.lit(float(BLOCK_SETS)), 16 * F.sqrt("many"))
    blocks = F.ceil(F.greatest(F.col("many") / block_sets, F.col("weight") / BLOCK_VALUES))
    rows = rows.select("value", "row", "component", blocks.alias("blocks"))
    members = rows.withColumn("block", F.pmod(F.xxhash64("row"), "blocks")).withColumn("asks", F.lit(0))
    others = F.explode(F.sequence(F.lit(1).cast("long"), F.floor(F.col("blocks") / 2)))
    asking = members.where("blocks > 1").withColumn("step", others)
    asking = asking.withColumn("block", F.pmod(F.col("block") + F.col("step"), "blocks")).withColumn("asks", F.lit(1))
    both = members.unionByName(asking.drop("step"))
    held = _only(sets.select("row", "n", "values"), rows.select("row").distinct())
    both = both.join(held, "row").select("value", "block", "asks", "row", "component", "n", "values")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = both.repartition(parts, "value", "block").sortWithinPartitions("value", "block", "asks", "row")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple[int, int]]:
            at, held, block = None, [], None
            for batch in batches:
                for a in range(0, batch.num_rows, 1024):
                    part = batch.slice(a, 1024)
                    for value, number, asks, row, component, n, raw in zip(*(c.to_pylist() for c in part.columns)):
                        if (value, number) != at:
                            if held:
                                yield from _Block(*zip(*held)).own_links()
                            at, held, block = (value, number), [], None
                        own = np.frombuffer(raw, "<u8")
                        if not asks:
                            held.append((row, component, n, own))
                            continue
                        if held:
                            block, held = _Block(*zip(*held)), []
                            yield from block.own_links()
                        if block:
                            yield from block.links(row, component, n, own)
            if held:
                yield from _Block(*zip(*held)).own_links()

        links = found()
        while some := list(islice(links, 4096)):
            yield pa.record_batch({k: pa.array(v, pa.int64()) for k, v in zip("ab", zip(*some))})

    return dealt.mapInArrow(resting(meet), "a long, b long")


def components(nodes: DataFrame, links: DataFrame, key: str = "row") -> DataFrame:
    """(row, component): the smallest row that links reach; each round also jumps over pointers."""
    both = stored(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stored(nodes.select(key, F.col(key).alias("component")), "labels")
    while True:
        near = both.join(labels.select(F.col(key).alias("b"), "component"), "b").groupBy("a").agg(F.min("component").alias("near"))
        step = labels.join(near.withColumnRenamed("a", key), key, "left")
        step = stored(step.select(key, "component", F.least("component", F.coalesce("near", "component")).alias("new")), "labels")
        jump = step.select(F.col(key).alias("new"), F.col("new").alias("far"))
        done = stored(step.join(jump, "new", "left").select(key, F.least("new", F.coalesce("far", "new")).alias("component"), F.col("component").alias("old")), "labels")
        changed = done.where("component < old").limit(1).count()
        labels = done.select(key, "component")
        if not changed:
            return labels


def ngram_join(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links) of every document.

    Null and empty texts, and texts without words, have no shingles and are
    alone. A text of fewer than ``words`` words has one. Repeated rows are
    documents of equal sets, which link. A null doc_id takes part; a component
    of nulls only has a null id. Other columns are not read.
    """
    all_ = shared_shingles(docs, words)
    open_ = all_.where(F.col("values").isNotNull())
    # Documents of equal sets are one set; the copies only point to it.
    same = stored(open_.groupBy("key", "n_shingles").agg(F.min("row").alias("set_row")), "sets")
    sets = _only(open_, same.select(F.col("set_row").alias("row")))
    sets = stored(sets.select("row", F.col("n_shingles").alias("n"), "shared", "values"), "set-values")
    postings = _prefixes(sets)
    rare = postings.groupBy("value").agg(F.count("*").alias("many"), F.min("row").alias("first")).where("many > 1")
    lists = stored(postings.join(rare.select("value", "first"), "value"), "lists")

    # Each set against the first one of its lists: joins most groups in one step.
    head = lists.where("row = first").select("value", "row", "n", "shared", "at")
    rest = lists.where("row <> first").select("value", "row", "n", "shared", "at")
    stars = rest.alias("x").join(head.alias("y"), (F.col("x.value") == F.col("y.value")) & _possible("x", "y"))
    stars = stored(stars.select(F.col("y.row").alias("a"), F.col("x.row").alias("b")).distinct(), "star-pairs")
    links = stored(linked(stars, sets), "star-links")
    groups = components(sets, links)

    # What is left are pairs of different groups in a list.
    sizes = groups.groupBy("component").agg(F.count("*").alias("size"))
    held = lists.select("value", "row", "n", "shared", "at").join(groups.join(sizes, "component"), "row")
    several = held.groupBy("value").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    held = stored(held.join(several.select("value"), "value"), "open-lists")
    small = stored(_with_partners(held.where(F.col("size") <= MOST_PAIRED)), "small-groups")
    short, long = small.where(F.col("many") <= MOST_LISTED), small.where(F.col("many") > MOST_LISTED)
    across = short.alias("x").join(short.alias("y"), (F.col("x.value") == F.col("y.value"))
                                   & (F.col("x.component") < F.col("y.component")) & _possible("x", "y", first=True))
    across = stored(across.select(F.col("x.row").alias("a"), F.col("y.row").alias("b")).distinct(), "open-pairs")
    found = links.union(linked(across, sets)).union(_linked_to_groups(held, groups, sets))
    found = stored(found.union(_linked_in_lists(long, sets)), "all-links")
    groups = components(sets, found)

    named = same.join(groups.withColumnRenamed("row", "set_row"), "set_row").select("key", "n_shingles", "component")
    members = all_.select("row", "doc_id", "n_shingles", "key", F.col("values").isNotNull().alias("open"))
    members = members.join(named, ["key", "n_shingles"], "left")
    group = F.when(F.col("open"), F.col("component")).otherwise(-1 - F.col("row"))
    members = members.select("doc_id", "n_shingles", group.alias("group"))
    least = members.where("group >= 0").groupBy("group").agg(F.min("doc_id").alias("least"))
    out = members.join(least, "group", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))

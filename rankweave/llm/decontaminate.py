"""Benchmark passages in training documents, by a positional inverted index.

Only DataFrame operations. The index holds (term, row, position) of every
training token that is a term of the benchmark. A window of benchmark words is
looked up from its rarest terms: their posting lists, moved back by the term's
offset in the window, are intersected, and what is left is held against the
postings of all terms of the window.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankweave.runtime import is_small

from .common import stored

PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
# Contaminated: at least one word in this many is hit.
SHARE = 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Stands after the last word of a document; no word is empty.
_AFTER = ""
# Rows with an open start up to which they are broadcast (as 64-bit numbers).
MAX_OPEN_ROWS = 2_000_000


def words_of(text: str) -> Column:
    """Lower-cased words of a text column; none for null."""
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit(PATTERN), F.lit(0))


def windows_of(benchmark: DataFrame, size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Distinct windows by term, and the items of each window.

    (window, length, offset, term) and (window, item_id). Every item's
    consecutive ``size`` words are a window; an item of fewer words is one, an
    item without words has none.
    """
    rows = benchmark.select("item_id", words_of("text").alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (size - 1), F.lit(1)))
    cut = rows.select("item_id", "words", F.explode(starts).alias("at"))
    cut = cut.select("item_id", F.slice("words", F.col("at"), size).alias("held"))
    cut = cut.select("item_id", "held", F.xxhash64("held").alias("window"))
    items = cut.select("window", "item_id").distinct()
    whole = cut.select("window", "held").distinct()
    terms = whole.select("window", F.size("held").alias("length"), F.posexplode("held").alias("offset", "word"))
    return terms.select("window", "length", "offset", F.xxhash64("word").alias("term")), items


@dataclass
class PositionalIndex:
    """Written postings (term, row, doc_id, pos) and documents (row, doc_id, n_words).

    A row of the table is a document, so repeated doc_ids stay apart.
    """

    postings: DataFrame
    documents: DataFrame


def build_index(docs: DataFrame, terms: DataFrame) -> PositionalIndex:
    """Index the positions of the given terms (64-bit hashes of words) over whole texts.

    One pass over the texts: a token meets the terms where it is read, if these
    pass the size check, and is not shuffled.
    """
    after = F.xxhash64(F.lit(_AFTER))
    known = terms.select("term").distinct().union(docs.sparkSession.range(1).select(after.alias("term"))).distinct()
    rows = docs.select(
        F.col("doc_id").cast("long"), F.concat(words_of("text"), F.array(F.lit(_AFTER))).alias("words")
    ).withColumn("row", F.monotonically_increasing_id())
    tokens = rows.select("row", "doc_id", F.posexplode("words").alias("pos", "word"))
    tokens = tokens.select(F.xxhash64("word").alias("term"), "row", "doc_id", "pos")
    known = F.broadcast(known) if is_small(known) else known
    postings = stored(tokens.join(known, "term"), "postings")
    documents = postings.where(F.col("term") == after).select("row", "doc_id", F.col("pos").alias("n_words"))
    return PositionalIndex(postings.where(F.col("term") != after), documents)


def _small_side(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if is_small(df) else df


def _ranked(index: PositionalIndex, terms: DataFrame) -> DataFrame:
    """Terms of each window with their rank, 1 for the rarest in the corpus.

    A window with a term that no document has is left out.
    """
    counts = index.postings.groupBy("term").agg(F.count("*").alias("n"))
    joined = terms.join(counts, "term", "left")
    whole = Window.partitionBy("window")
    order = whole.orderBy(F.col("n").asc_nulls_first(), "offset")
    ranked = joined.withColumns({"rarity": F.row_number().over(order), "least": F.min(F.coalesce("n", F.lit(0))).over(whole)})
    return stored(ranked.where("least > 0").drop("least"), "window-terms")


def _starts(index: PositionalIndex, ranked: DataFrame, rarity: int) -> DataFrame:
    """Starts at which a window could stand, from its term of the given rarity."""
    asked = _small_side(ranked.where(F.col("rarity") == rarity).select("term", "window", "offset", "length"))
    start = F.col("pos") - F.col("offset")
    found = index.postings.join(asked, "term").select("window", "row", start.alias("start"), "length")
    return found.where("start >= 0")


def phrase_matches(index: PositionalIndex, terms: DataFrame) -> DataFrame:
    """Every exact occurrence of a window: (window, row, start, length)."""
    ranked = _ranked(index, terms)
    first, second = _starts(index, ranked, 1), _starts(index, ranked, 2).drop("length")
    both = first.where("length > 1").join(second, ["window", "row", "start"])
    open_ = stored(both.union(first.where("length = 1").select(both.columns)), "phrase-starts")
    # Places of all terms of the starts left; a place that several starts need is asked for once.
    places = open_.join(_small_side(ranked.select("window", "offset", "term")), "window")
    places = places.select("window", "row", "start", "length", (F.col("start") + F.col("offset")).alias("pos"), "term")
    asked = places.select("row", "pos", "term").distinct()
    # Only postings of rows with an open start move; the rows are numbers, 8 bytes each.
    rows = stored(open_.select("row").distinct(), "phrase-rows")
    rows = F.broadcast(rows) if is_small(rows, max_rows=MAX_OPEN_ROWS, max_bytes=64 * MAX_OPEN_ROWS) else rows
    near = index.postings.select("row", "pos", "term").join(rows, "row", "left_semi")
    held = stored(near.join(asked, ["row", "pos", "term"]), "phrase-held")
    met = places.join(held, ["row", "pos", "term"]).groupBy("window", "row", "start", "length").count()
    return met.where(F.col("count") == F.col("length")).drop("count")


def proximity_matches(index: PositionalIndex, terms: DataFrame, slack: int) -> DataFrame:
    """Places near which all terms of a window stand, in any order: (window, row, near).

    ``near`` is where the window would start by an occurrence of its rarest
    term; every distinct term has to occur from ``slack`` words before there to
    ``slack`` words after the window's end.
    """
    ranked = _ranked(index, terms)
    asked = _small_side(ranked.select("window", "term").distinct())
    near = _starts_near(index, ranked)
    wanted = near.join(asked, "window")
    found = wanted.join(index.postings.select("row", "term", "pos"), ["row", "term"])
    inside = (F.col("pos") >= F.col("near") - slack) & (F.col("pos") < F.col("near") + F.col("length") + slack)
    met = found.where(inside).groupBy("window", "row", "near").agg(F.count_distinct("term").alias("met"))
    needed = asked.groupBy("window").agg(F.count("*").alias("needed"))
    return met.join(needed, "window").where("met = needed").select("window", "row", "near")


def _starts_near(index: PositionalIndex, ranked: DataFrame) -> DataFrame:
    asked = _small_side(ranked.where("rarity = 1").select("term", "window", "offset", "length"))
    near = (F.col("pos") - F.col("offset")).alias("near")
    return index.postings.join(asked, "term").select("window", "row", near, "length").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, share: int = SHARE) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A word inside any occurrence of a window is hit; a document is contaminated
    when 1 in ``share`` of its words is. Null and empty texts have no words and
    are clean; repeated rows are judged each by itself; an empty benchmark hits
    nothing. Other columns of either table are not read.
    """
    terms, items = windows_of(benchmark, size)
    terms, items = stored(terms, "windows"), stored(items, "window-items")
    index = build_index(docs, terms)
    matches = stored(phrase_matches(index, terms), "matches")
    inside = F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("pos")
    hit = matches.select("row", inside).distinct().groupBy("row").agg(F.count("*").alias("n_hit"))
    named = matches.select("row", "window").distinct().join(_small_side(items), "window")
    named = named.select("row", F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item")).distinct()
    listed = named.groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items"))
    out = index.documents.join(hit, "row", "left").join(listed, "row", "left")
    n_hit, none = F.coalesce("n_hit", F.lit(0).cast("long")), F.array().cast("array<string>")
    held = F.coalesce("items", none)
    return out.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(held).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", held).cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
    )

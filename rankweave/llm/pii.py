"""Personal data, and terms that give it away, by information theory.

Only DataFrame operations. Patterns find the protected entities. The terms near
them are weighed by the corpus: with PMI(term, entity) = log p(entity | term) /
p(entity) and IC(entity) = -log p(entity), a term whose PMI comes close to the
IC says nearly as much as the entity itself, and is generalised or removed
wherever it stands.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankweave.runtime import is_small

from .common import stored

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
# Same matches as the plain forms of the contract, without backtracking: a match
# starts where its run of characters does, and loops never give back.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_SIGN = {"email": "@", "ip": ".", "card": None, "phone": "+"}
# Documents added to those of a term as if they lacked the entity but by chance. A share
# of few documents is thereby low, and no count of documents is left out.
UNSEEN = 1.0
# Share of the entity's information from which a term is generalised, and removed.
GENERALISE = 0.9
REMOVE = 0.98
# Characters on each side in which a term counts as near.
NEAR = 120
WORD = r"\p{L}{3,}"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Sum of the digits, every second from the right doubled, is divisible by ten."""
    places = F.split(F.reverse(digits), "")
    values = F.transform(places, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)))
    return F.aggregate(values, F.lit(0), lambda a, b: a + F.coalesce(b, F.lit(0))) % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    """Whether a match of the pattern is an entity."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        # A part has digits by the pattern; after its zeros there may be none left.
        return value.rlike(r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?)?(?:\.(?!$)|$)){4}$")
    count = F.length(_digits(value))
    if kind == "phone":
        return (count >= 10) & (count <= 15)
    return F.when((count >= 14) & (count <= 19), _luhn(_digits(value))).otherwise(False)


def _keeps(kind: str) -> Callable[[Column], Column]:
    return lambda span: _holds(kind, span["value"])


def _of(kind: str) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == kind


def _spans(text: Column, pattern: Column, matches: Column, kind: str) -> Column:
    """(start, kind, end, value) of each match: its place follows from the text between matches."""
    between = F.split(text, pattern, -1)
    zero = F.struct(
        F.lit(0).alias("at"),
        F.array().cast("array<struct<start:int,kind:string,end:int,value:string>>").alias("out"),
    )
    pieces = F.transform(matches, lambda m, i: F.struct(m.alias("m"), F.get(between, i).alias("gap")))

    def step(held: Column, piece: Column) -> Column:
        start = held["at"] + F.length(piece["gap"])
        end = start + F.length(piece["m"])
        one = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), piece["m"].alias("value"))
        return F.struct(end.alias("at"), F.concat(held["out"], F.array(one)).alias("out"))

    return F.aggregate(pieces, zero, step)["out"]


_NONE = "array<struct<start:int,kind:string,end:int,value:string>>"


def base_spans(docs: DataFrame) -> DataFrame:
    """Adds ``_text`` (null as empty) and ``_spans``: the entities of every kind, by start and kind."""
    out = docs.withColumn("_text", F.coalesce(F.col("text"), F.lit("")))
    none = F.array().cast("array<string>")
    for kind in KINDS:
        sign = _SIGN[kind]
        all_ = F.regexp_extract_all("_text", F.lit(PATTERNS[kind]), F.lit(0))
        guard = F.contains("_text", F.lit(sign)) if sign else F.lit(True)
        out = out.withColumn(f"_m_{kind}", F.when(guard, all_).otherwise(none))
    parts = []
    for kind in KINDS:
        held = F.col(f"_m_{kind}")
        found = F.filter(_spans(F.col("_text"), F.lit(PATTERNS[kind]), held, kind), _keeps(kind))
        parts.append(F.when(F.size(held) > 0, found).otherwise(F.array().cast(_NONE)))
    return out.withColumn("_spans", _ordered(F.concat(*parts))).drop(*[f"_m_{k}" for k in KINDS])


def _ordered(spans: Column) -> Column:
    """By start, then by kind in the listed order, the method's own kind last."""
    order = F.array(*map(F.lit, (*KINDS, TERM)))
    keyed = F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(order, s["kind"]).alias("no"), s["end"].alias("end"),
        s["kind"].alias("kind"), s["value"].alias("value")))
    return F.transform(F.array_sort(keyed), lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["value"].alias("value")))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


# Between an entity and a term; neither holds it.
_CUT = "\0"


def disclosing_terms(
    docs: DataFrame, found: DataFrame, unseen: float = UNSEEN, generalise: float = GENERALISE
) -> tuple[DataFrame, DataFrame]:
    """Terms whose disclosure of some entity passes the threshold, and where they stand.

    (term, disclosure) and (doc_id, hash, term, disclosure). ``found`` has the
    entities of every document with the words around them. Counts are of
    documents, copies included: of terms over all, of entities over all that
    were found. p(entity | term) is smoothed by ``unseen`` documents.
    """
    total = F.lit(float(found.count()))

    def entity(e: Column) -> Column:
        return F.concat_ws(":", e["kind"], F.lower(e["value"]))

    def beside(e: Column) -> Column:
        return F.transform(F.array_distinct(e["words"]), lambda w: F.concat(entity(e), F.lit(_CUT), w))

    def counted(values: Column, name: str, count: str) -> DataFrame:
        """Documents that have each value."""
        return found.select(F.explode(F.array_distinct(values)).alias(name)).groupBy(name).agg(F.count("*").alias(count))

    def side(df: DataFrame, name: str) -> DataFrame:
        return F.broadcast(df) if is_small(df, F.octet_length(name)) else df

    entities = stored(counted(F.transform("entities", entity), "entity", "n_entity"), "pii-entities")
    seen = stored(counted(F.flatten(F.transform("entities", lambda e: e["words"])), "term", "n_seen"), "pii-seen")
    both = counted(F.flatten(F.transform("entities", beside)), "pair", "n_both").select(
        F.substring_index("pair", _CUT, 1).alias("entity"), F.substring_index("pair", _CUT, -1).alias("term"), "n_both")
    chance = F.col("n_entity") / total
    information = -F.log2(chance)

    def disclosure(times: str) -> Column:
        # PMI / IC; an entity of every document has no information to give away.
        given = F.log2(F.least((F.col("n_both") + unseen * chance) / (F.col(times) + unseen), F.lit(1.0)))
        return F.when(information > 0, 1 + given / information).otherwise(F.lit(0.0))

    # A term is in at least the documents in which it was seen near entities, so
    # what cannot pass with that count cannot pass with the corpus count either.
    both = both.join(side(entities, "entity"), "entity").join(side(seen, "term"), "term")
    both = stored(both.where(disclosure("n_seen") >= generalise), "pii-pairs")
    texts = docs.select("doc_id", F.xxhash64("_text").alias("hash"), F.explode(F.array_distinct(_words(F.col("_text")))).alias("term"))
    # All words are counted: those asked for can be most of the words there are.
    counts = texts.groupBy("term").agg(F.count("*").alias("n_term"))
    weighed = both.join(counts, "term")
    terms = weighed.groupBy("term").agg(F.max(disclosure("n_term")).alias("disclosure")).where(F.col("disclosure") >= generalise)
    terms = stored(terms, "pii-terms")
    return terms, texts.join(side(terms, "term"), "term")


def find_personal_data(
    docs: DataFrame, unseen: float = UNSEEN, generalise: float = GENERALISE, remove: float = REMOVE
) -> DataFrame:
    """Per document: doc_id, hash of its text, base and all spans.

    Spans are (start, kind, end, value) in code points. A span of kind ``term``
    was added by the method; its value is empty where the term is to be removed
    and otherwise what it is generalised to. Null and empty texts have none.
    Repeated rows count as so many documents. Other columns are not read.
    """
    rows = base_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).drop("text")

    def around(s: Column) -> Column:
        # One character more than is near tells whether the first or last word is a whole one.
        before = F.substring(F.col("_text"), F.greatest(s["start"] - NEAR - 1, F.lit(0)) + 1, F.least(s["start"], F.lit(NEAR + 1)))
        before = F.when(s["start"] > NEAR, F.regexp_replace(before, r"^\p{L}+", "")).otherwise(before)
        after = F.substring(F.col("_text"), s["end"] + 1, F.lit(NEAR + 1))
        after = F.when(F.length(after) > NEAR, F.regexp_replace(after, r"\p{L}+\z", "")).otherwise(after)
        return F.struct(s["kind"].alias("kind"), s["value"].alias("value"), F.concat(_words(before), _words(after)).alias("words"))

    entities = F.when(F.size("_spans") > 0, F.transform("_spans", around)).otherwise(
        F.array().cast("array<struct<kind:string,value:string,words:array<string>>>"))
    found = stored(rows.select("doc_id", F.xxhash64("_text").alias("hash"), F.col("_spans").alias("base"),
                               entities.alias("entities")), "pii-found")
    _, places = disclosing_terms(rows, found, unseen, generalise)
    met = places.groupBy("doc_id", "hash").agg(
        F.sort_array(F.collect_set("term")).alias("terms"),
        F.sort_array(F.collect_set(F.when(F.col("disclosure") >= remove, F.col("term")))).alias("removed"),
    )
    met = stored(met, "pii-met")
    met = F.broadcast(met) if is_small(met, F.octet_length(F.concat_ws("", "terms"))) else met
    texts = rows.select("doc_id", F.xxhash64("_text").alias("hash"), "_text")
    same = ["doc_id", "hash"]
    hit = texts.alias("t").join(met.alias("m"), [F.col("t.doc_id").eqNullSafe(F.col("m.doc_id")), F.col("t.hash") == F.col("m.hash")])
    hit = hit.select("t.doc_id", "t.hash", "_text", "terms", "removed")
    # The terms are runs of letters, so they stand in a pattern as they are.
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.concat_ws("|", "terms"), F.lit(r")(?!\p{L})"))
    hit = hit.withColumns({"_pattern": pattern}).withColumn("_m", F.regexp_extract_all("_text", "_pattern", F.lit(0)))
    added = _spans(F.col("_text"), F.col("_pattern"), F.col("_m"), TERM)
    added = F.transform(added, lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"),
        F.when(F.array_contains("removed", F.lower(s["value"])), F.lit("")).otherwise(F.lit("[word]")).alias("value")))
    added = hit.select(*same, added.alias("added")).dropDuplicates(same)
    f, a = found.alias("f"), added.alias("a")
    joined = f.join(a, [F.col("f.doc_id").eqNullSafe(F.col("a.doc_id")), F.col("f.hash") == F.col("a.hash")], "left")
    more = F.coalesce("a.added", F.array().cast(_NONE))
    return joined.select("f.doc_id", "f.hash", "f.base", _ordered(F.concat("f.base", more)).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts of each kind, the digest of the base spans, and all spans as text."""
    counts = [F.size(F.filter("base", _of(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))


def sanitised(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The documents with every span replaced: an entity by its kind in brackets, a term as found says.

    Of overlapping spans the first one that starts is replaced, and the rest of
    a later one is cut. Documents without spans keep their text, null included.
    """
    spans = found.where(F.size("spans") > 0).select("doc_id", "hash", "spans").dropDuplicates(["doc_id", "hash"])
    spans = stored(spans, "pii-spans")
    spans = F.broadcast(spans) if is_small(spans, 64 * F.size("spans")) else spans
    d = docs.withColumn("_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    s = spans.select(F.col("doc_id").alias("_id"), F.col("hash").alias("_key"), F.col("spans").alias("_found"))
    joined = d.join(s, [d["doc_id"].cast("long").eqNullSafe(s["_id"]), d["_hash"] == s["_key"]], "left")

    def step(held: Column, s: Column) -> Column:
        new = F.when(s["kind"] == TERM, s["value"]).otherwise(F.concat(F.lit("["), s["kind"], F.lit("]")))
        begin = F.greatest(held["at"], s["start"])
        kept = F.substring(F.col("text"), held["at"] + 1, begin - held["at"])
        out = F.when(s["start"] >= held["at"], F.concat(held["out"], kept, new)).otherwise(held["out"])
        return F.struct(F.greatest(held["at"], s["end"]).alias("at"), out.alias("out"))

    held = F.aggregate("_found", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step)
    whole = F.concat(held["out"], F.substring(F.col("text"), held["at"] + 1, F.length("text")))
    text = F.when(F.col("_found").isNotNull() & F.col("text").isNotNull(), whole).otherwise(F.col("text"))
    return joined.withColumn("text", text).select(*docs.columns)

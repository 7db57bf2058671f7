"""Text expressions: content assembly, query prefix, and token analysers.

An analyser is a function from a text column to an ``array<string>`` column
of tokens, in reading order and with repeats.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Analyzer = Callable[[Column], Column]

# Fixed value: what the evaluation puts before a query.
QUERY_PREFIX = "Query: "

# The published Snowball stop words for English.
ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his "
    "himself she her hers herself it its itself they them their theirs themselves what "
    "which who whom this that these those am is are was were be been being have has had "
    "having do does did doing a an the and but if or because as until while of at by for "
    "with about against between into through during before after above below to from up "
    "down in out on off over under again further then once here there when where why how "
    "all any both each few more most other some such no nor not only own same so than too "
    "very s t can will just don should now"
).split()

_NON_WORD = r"[^\p{L}\p{N}]+"
_HANGUL = r"가-힣"
_SCRIPT_RUNS = rf"([{_HANGUL}]+|[\p{{L}}\p{{N}}&&[^{_HANGUL}]]+)"


def build_content(
    text: Column, title: Column | None = None, max_chars: int | None = None
) -> Column:
    """Document content: the title on its own line, then the text; whole unless a length is given."""
    whole = text if title is None else F.concat(title, F.lit("\n"), text)
    return whole if max_chars is None else F.substring(whole, 1, max_chars)


def with_prefix(text: Column, prefix: str = QUERY_PREFIX) -> Column:
    return F.concat(F.lit(prefix), text)


def first_part(text: Column, separator: str = " - ") -> Column:
    """What stands before the first separator (the whole text if there is none)."""
    return F.substring_index(text, separator, 1)


def analyze_simple(text: Column) -> Column:
    """Lower case, split at everything that is neither letter nor digit."""
    return F.array_remove(F.split(F.lower(text), _NON_WORD), "")


def analyze_english(text: Column) -> Column:
    """Simple tokens without stop words, plurals reduced.

    The plural rules are those of Harman's S-stemmer: "ies" becomes "y" unless
    a or e stands before it; any other final "s" goes, unless it follows u, s,
    or an e that itself follows a, e, i or o. They run over the joined tokens,
    so that a row needs two regular expressions and not two for each token.
    """
    words = F.filter(analyze_simple(text), lambda w: ~w.isin(ENGLISH_STOP_WORDS))
    joined = F.concat_ws(" ", words)
    joined = F.regexp_replace(joined, r"(?<=\S)(?<![ae])ies(?= |$)", "y")
    joined = F.regexp_replace(joined, r"(?<=\S\S)(?<![us])(?<![aeio]e)s(?= |$)", "")
    return F.array_remove(F.split(joined, " "), "")


def analyze_korean(text: Column) -> Column:
    """Overlapping syllable pairs for Hangul, whole words for other scripts."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(_SCRIPT_RUNS), 1)

    def pieces(run: Column) -> Column:
        pairs = F.transform(
            F.sequence(F.lit(1), F.length(run) - 1), lambda i: F.substring(run, i, F.lit(2))
        )
        return F.when(run.rlike(f"^[{_HANGUL}]{{2}}"), pairs).otherwise(F.array(run))

    return F.flatten(F.transform(runs, pieces))


ANALYZERS: dict[str, Analyzer] = {
    "simple": analyze_simple,
    "english": analyze_english,
    "korean": analyze_korean,
    "public.korean": analyze_korean,
}


def analyzer(config: str | Analyzer) -> Analyzer:
    """Look an analyser up by name; a function is taken as it is.

    Pass a function to plug in a stemmer or morpheme analyser, for example
    one that wraps an Arrow UDF.
    """
    if callable(config):
        return config
    if config not in ANALYZERS:
        raise ValueError(f"unknown text configuration {config!r}; known: {sorted(ANALYZERS)}")
    return ANALYZERS[config]

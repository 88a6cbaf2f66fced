"""Text cleaning, as Column -> Column expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns. They must match the published data sets character for character.
ID_PREFIX = r"^t[0-9]_"
SPEAKER = r"(?:^|(?:[.!?][ \t\n\x0B\f\r]))([a-zA-Z0-9_]+):"
BRACKETED = r"[\[(]([^\n]*?)[\])]"
EDGE_CHARACTERS = " -\n"
TOKEN = r"[\p{L}\p{N}_]{2,}+"

# Everything up to the last place where a letter or digit meets something else.
_LAST_WORD_BOUNDARY = (
    r"(?s)^(.*)(?:(?<=[\p{L}\p{N}])(?=[^\p{L}\p{N}])|(?<=[^\p{L}\p{N}])(?=[\p{L}\p{N}]))"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise_id(c: Column | str) -> Column:
    """Strip the type prefix of a comment or thread id (``t1_abc`` -> ``abc``)."""
    return F.regexp_replace(_col(c), ID_PREFIX, "")


def trim(c: Column | str, max_length: int) -> Column:
    """At most ``max_length`` characters, cut only where a word starts or ends; else empty."""
    text = _col(c)
    return F.when(F.length(text) <= max_length, text).otherwise(
        F.regexp_extract(F.substring(text, 1, max_length + 1), _LAST_WORD_BOUNDARY, 1)
    )


def is_trimmed(c: Column | str, max_length: int) -> Column:
    """Whether :func:`trim` would shorten the text."""
    return F.length(_col(c)) > max_length


def strip_speaker(c: Column | str) -> Column:
    """Remove one-word speaker names followed by a colon, at the start or after a sentence end."""
    text = _col(c)
    return F.when(F.contains(text, F.lit(":")), F.regexp_replace(text, SPEAKER, "")).otherwise(text)


def strip_brackets(c: Column | str) -> Column:
    """Remove bracketed remarks such as ``[noise]`` or ``(laughing)``."""
    return F.regexp_replace(_col(c), BRACKETED, "")


def strip_edges(c: Column | str) -> Column:
    """Strip blanks, hyphens and line breaks from both ends."""
    return F.btrim(_col(c), F.lit(EDGE_CHARACTERS))


def preprocess_line(c: Column | str) -> Column:
    """Clean one dialogue line: speaker, brackets, edges, in that order.

    Most lines hold no bracket, and a plain search is far cheaper than the pattern. It looks at the
    raw line, as removing a speaker adds none.
    """
    text = _col(c)
    spoken = strip_speaker(text)
    has_bracket = F.contains(text, F.lit("[")) | F.contains(text, F.lit("("))
    return strip_edges(F.when(has_bracket, strip_brackets(spoken)).otherwise(spoken))


def word_count(c: Column | str) -> Column:
    """Number of pieces between single spaces; empty pieces count."""
    return F.size(F.split(_col(c), " ", -1))


def word_count_between(c: Column | str, min_words: int, max_words: int) -> Column:
    """Whether the word count lies in the closed range."""
    return word_count(c).between(min_words, max_words)


def tokens(c: Column | str) -> Column:
    """Lower-case words of two or more characters, in order, as ``array<string>``."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(TOKEN), 0)


def token_counts(c: Column | str) -> Column:
    """``array<struct<term, tf>>``: each distinct token of one text and how often it occurs.

    Sorts the tokens and measures the runs, so a text is counted where it lies: no row per token, no
    aggregation. One-element arrays bind the sorted tokens and the run starts to a name.
    """

    def runs(words: Column) -> Column:
        starts = F.array_compact(
            F.transform(words, lambda w, i: F.when(~w.eqNullSafe(F.get(words, i - 1)), i))
        )
        return F.get(F.transform(F.array(starts), lambda at: counted(words, at)), F.lit(0))

    def counted(words: Column, at: Column) -> Column:
        return F.transform(
            at,
            lambda start, i: F.struct(
                F.get(words, start).alias("term"),
                (F.coalesce(F.get(at, i + 1), F.size(words)) - start).cast("long").alias("tf"),
            ),
        )

    return F.get(F.transform(F.array(F.sort_array(tokens(c))), runs), F.lit(0))

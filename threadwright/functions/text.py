"""Row-level text expressions (no UDFs)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .vocab import GLITCH_MARK, KEYWORD_STOP_WORDS
from .patterns import WORD


# every character but a-z, 0-9, the apostrophe and white space, by ranges: Java takes some ten times as long over [^a-z0-9'\s]
_NOT_KEPT = r"[\x00-\x08\x0E-\x1F!-&(-/:-`{-\x{10FFFF}]"


def strip(text: Column) -> Column:
    """Remove leading and trailing white space including line breaks."""
    return F.btrim(text, F.lit(" \t\n\r\x0b\x0c"))


def flatten_lines(text: Column) -> Column:
    return F.translate(text, "\n", " ")


def truncated(text: Column, width: int) -> Column:
    """Cut to ``width`` characters; an ellipsis marks only texts that were longer."""
    return F.when(F.length(text) > width, F.concat(F.substring(text, 1, width), F.lit("…"))).otherwise(text)


def clean_text(text: Column) -> Column:
    """Drop links and mentions, lower-case, keep letters, digits and apostrophes."""
    no_links = F.regexp_replace(text, r"http\S+", "")
    no_mentions = F.regexp_replace(no_links, "@" + WORD + "+", "")
    return F.regexp_replace(F.lower(no_mentions), _NOT_KEPT, " ")


def keywords(text: Column, stop_words: Sequence[str] = KEYWORD_STOP_WORDS) -> Column:
    """Array of cleaned words longer than two characters that are not stop words."""
    words = F.split(clean_text(text), r"\s+")
    return F.filter(words, lambda w: (F.length(w) > 2) & ~w.isin(*stop_words))


def is_glitch(text: Column) -> Column:
    low = F.lower(text)
    letter = low.contains("letter") | low.contains('"i"') | low.contains("'i'")
    return text.contains(GLITCH_MARK) | low.contains("question mark") | (low.contains("autocorrect") & letter)


def first_line(text: Column, width: int | None = None) -> Column:
    line = F.substring_index(text, "\n", 1)
    return line if width is None else F.substring(line, 1, width)


def first_customer_message(context: Column) -> Column:
    """Text of the first ``CUSTOMER:`` line, or the whole trimmed context without one."""
    lines = F.filter(F.split(context, "\n"), lambda line: line.startswith("CUSTOMER:"))
    return F.coalesce(strip(F.substring(F.get(lines, 0), len("CUSTOMER:") + 1, 2147483647)), strip(context))


def strip_leading_mention(text: Column) -> Column:
    return F.regexp_replace(strip(text), r"^@\S+\s*", "")


def is_filled(column: Column) -> Column:
    """Blank and null both mean "not decided yet"."""
    return strip(F.coalesce(column, F.lit(""))) != ""


def word_tokens(text: Column, stop_words: Sequence[str]) -> Column:
    """Lower-cased word tokens of at least two characters without stop words."""
    tokens = F.regexp_extract_all(F.lower(text), F.lit("(" + WORD + "{2,})"), F.lit(1))
    return F.filter(tokens, lambda t: ~t.isin(*stop_words)) if stop_words else tokens


def ngrams(tokens: Column, max_n: int = 2) -> Column:
    """Unigrams, and for ``max_n`` 2 also bigrams, of a token array.

    Pass a column rather than an expression: the tokens are used several times.
    """
    if max_n < 2:
        return tokens
    count = F.greatest(F.size(tokens) - 1, F.lit(0))
    pairs = F.zip_with(
        F.slice(tokens, F.lit(1), count), F.slice(tokens, F.lit(2), count), lambda a, b: F.concat_ws(" ", a, b)
    )
    return F.concat(tokens, pairs)

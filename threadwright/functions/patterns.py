"""Engine-neutral regular expressions.

``\\w`` and ``\\b`` mean different things in Java, RE2 and Python for accented letters and
variation selectors, so both are spelled out as explicit character classes.

Java tries every alternative at every position, and a boundary costs it far more than a letter. Plain
alternatives are therefore searched as strings, and a boundary is looked at only where its word was found.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]"
NON_WORD = r"[^\p{L}\p{N}_]"
_BOUNDARY = rf"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"
_LITERAL = re.compile(r"[\w ',/:-]+", re.ASCII)
_BOUNDED = re.compile(r"\\b([a-z0-9]+)\\b")


def java_pattern(pattern: str) -> str:
    """The pattern with ``\\b``, ``\\w``, ``\\W`` replaced by explicit Unicode classes."""
    pattern = _BOUNDED.sub(lambda found: rf"{found[1]}(?<!{WORD}{found[1]})(?!{WORD})", pattern)
    return pattern.replace(r"\b", _BOUNDARY).replace(r"\w", WORD).replace(r"\W", NON_WORD)


def alternatives(pattern: str) -> list[str]:
    """The pattern cut at the bars outside of all brackets."""
    parts, depth = [""], 0
    for token in re.findall(r"\\.|\[(?:\\.|[^\]])*\]|.", pattern, re.DOTALL):
        depth += (token == "(") - (token == ")")
        if token == "|" and not depth:
            parts.append("")
        else:
            parts[-1] += token
    return parts


def matches(text: Column, pattern: str) -> Column:
    """Whether the pattern occurs in the text."""
    parts = alternatives(pattern)
    found = [F.contains(text, F.lit(part)) for part in parts if _LITERAL.fullmatch(part)]
    others = [part for part in parts if not _LITERAL.fullmatch(part)]
    if others:
        found.append(text.rlike(java_pattern("|".join(others))))
    return reduce(Column.__or__, found)


def first_match(text: Column, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """Name of the first rule whose pattern occurs in ``text`` as one CASE expression."""
    branches = F
    for name, pattern in rules:
        branches = branches.when(matches(text, pattern), F.lit(name))
    return branches.otherwise(F.lit(default))


def lookup(key: Column, mapping: dict[str, str], default: str | None = None) -> Column:
    """Map a closed vocabulary onto another one; unknown keys become ``default``."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))

"""Ordered text rules folded into single CASE expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab as V
from .patterns import first_match, lookup, matches
from .text import is_glitch


def issue_tags(text: Column) -> dict[str, Column]:
    """Non-exclusive tags, one boolean column each, plus the glitch flag."""
    low = F.lower(text)
    tags = {name: matches(low, pattern) for name, pattern in V.ISSUE_TAGS.items()}
    tags["i_autocorrect_bug"] = is_glitch(text)
    return tags


def classify_reply(text: Column) -> Column:
    """Single reply class; the order of the patterns is the priority."""
    low = F.lower(text)
    branches = F
    for name, pattern in V.REPLY_PATTERNS.items():
        branches = branches.when(matches(low, pattern), F.lit(name))
    return branches.when(text.contains("?"), F.lit("clarifying_question")).otherwise(
        F.lit("unclear_no_observable_resolution")
    )


def response_type(reply_class: Column) -> Column:
    return lookup(reply_class, V.RESPONSE_TYPE_OF_CLASS)


def response_behavior(response: Column) -> Column:
    return lookup(response, V.BEHAVIOR_OF_RESPONSE_TYPE, "unclear")


def length_bucket(size: Column) -> Column:
    return F.when(size <= 2, "short").when(size <= 4, "medium").otherwise("long")


def size_bucket(size: Column) -> Column:
    """Buckets 2, 3 and 4+; a single-message thread counts as 4+ by definition."""
    return F.when(size == 2, "2").when(size == 3, "3").otherwise("4+")


def topic_bucket(text: Column) -> Column:
    return first_match(F.lower(text), V.TOPIC_BUCKETS, V.TOPIC_OTHER)


def matched_intents(text: Column) -> Column:
    """All priority intents whose pattern occurs, in priority order."""
    low = F.lower(text)
    hits = F.array(*[F.when(matches(low, p), F.lit(name)).otherwise("") for name, p, _, _ in V.PRIORITY_RULES])
    return F.array_remove(hits, "")  # a lambda would keep the rules from being compiled


def is_ambiguous(text: Column) -> Column:
    return F.size(matched_intents(text)) > 1


def weak_label(text: Column) -> Column:
    """Struct (intent, note, confidence) of the first rule that applies."""

    def verdict(intent: str, note: str, confidence: str) -> Column:
        return F.struct(
            F.lit(intent).alias("intent"), F.lit(note).alias("note"), F.lit(confidence).alias("confidence")
        )

    low = F.lower(text)
    bug = "Software / App Bug Report"
    branches = F.when(is_glitch(text), verdict(bug, V.NOTE_GLITCH, "high"))
    for intent, pattern, note, confidence in V.PRIORITY_RULES:
        branches = branches.when(matches(low, pattern), verdict(intent, note, confidence))
    complaint = matches(low, V.COMPLAINT)
    return (
        branches.when(matches(low, V.SPECIFIC_BUG), verdict(bug, V.NOTE_SPECIFIC_BUG, "medium"))
        .when(
            matches(low, V.PRE_PURCHASE) & ~complaint,
            verdict("General / Pre-Purchase Inquiry", V.NOTE_PRE_PURCHASE, "medium"),
        )
        .when(complaint, verdict(bug, V.NOTE_COMPLAINT, "low"))
        .otherwise(verdict(V.UNCLEAR, V.NOTE_UNCLEAR, "none"))
    )


def with_weak_label(df, text_col: str):
    """Adds intent, note, confidence, matched categories and the ambiguity flag."""
    label = weak_label(F.col(text_col))
    return (
        df.withColumn("__label", label)
        .withColumn("matched", matched_intents(F.col(text_col)))
        .select("*", "__label.intent", "__label.note", "__label.confidence", (F.size("matched") > 1).alias("ambiguous"))
        .drop("__label")
    )

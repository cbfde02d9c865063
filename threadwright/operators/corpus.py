"""Request/reply pairs for retrieval."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import classify_reply, response_type
from ..functions.text import flatten_lines
from ..functions.vocab import UNCLEAR
from .distribution import lookup_join
from .threads import packed_time


def first_reply_after(
    rows: DataFrame, hot_roots: Sequence[int] = (), openings: DataFrame | None = None
) -> DataFrame:
    """First support message strictly after the thread's first customer message.

    Without one (or without a usable time) it is the thread's first support message. Both passes
    are hash aggregates over numbers; the support rows meet their thread's customer time by a lookup that broadcasts
    the few threads with very many rows, and the reply's text is looked up by its id. ``openings`` (root, first_ts,
    ...) restricts the threads; its other columns are joined to the replies found.
    """
    if openings is None:
        openings = rows.filter("is_customer").groupBy("root").agg(F.min_by("ts", packed_time()).alias("first_ts"))
    carried = [c for c in openings.columns if c not in ("root", "first_ts")]
    support = rows.filter("is_support")
    answered = lookup_join(support.select("root", "ts", "tweet_id"), openings.select("root", "first_ts"), "root", "inner", hot_roots)
    later = F.when(F.col("ts") > F.col("first_ts"), packed_time())
    picked = answered.groupBy("root").agg(
        F.coalesce(F.min_by("tweet_id", later), F.min_by("tweet_id", packed_time())).alias("reply_id")
    )
    texts = support.select("root", F.col("tweet_id").alias("reply_id"), F.col("ts").alias("reply_ts"), F.col("text").alias("support_text"))
    found = picked.join(texts, ["root", "reply_id"]).select("root", "reply_id", "reply_ts", "support_text")
    return found.join(openings.select("root", *carried), "root") if carried else found


def build_corpus(
    rows: DataFrame,
    brand: str,
    labels: DataFrame | None = None,
    hot_roots: Sequence[int] = (),
) -> DataFrame:
    """One row per qualifying thread: first request, the reply to it, its type, optional intent.

    One hash aggregate finds the ids of each thread's first message, request and first support message. The brand
    is that message's author, and the request is looked up by its id; only the support messages of the
    threads that qualify are then looked at.
    """
    support_key = F.when(F.col("is_support") & F.col("author_id").isNotNull(), packed_time())
    request_key = F.when(F.col("is_customer"), packed_time())
    firsts = rows.groupBy("root").agg(
        F.min_by("tweet_id", support_key).alias("first_support"),
        F.min_by("tweet_id", packed_time()).alias("thread_root_tweet_id"),
        F.min_by("tweet_id", request_key).alias("tweet_id"),
    )
    own = rows.filter(F.col("is_support") & (F.col("author_id") == brand)).select("root", F.col("tweet_id").alias("first_support"))
    requests = rows.filter("is_customer").select("root", "tweet_id", F.col("ts").alias("first_ts"), "text")
    openings = (
        firsts.join(own, ["root", "first_support"], "left_semi")
        .join(requests, ["root", "tweet_id"])
        .select("root", "first_ts", "tweet_id", "text", "thread_root_tweet_id")
    )
    corpus = first_reply_after(rows, hot_roots, openings).select(
        "tweet_id",
        "root",
        "thread_root_tweet_id",
        flatten_lines(F.coalesce("text", F.lit(""))).alias("customer_text"),
        flatten_lines(F.coalesce("support_text", F.lit(""))).alias("support_text"),
        response_type(classify_reply(F.coalesce("support_text", F.lit("")))).alias("response_type"),
    )
    if labels is None:
        return corpus.withColumn("intent", F.lit(None).cast("string"))
    return attach_labels(corpus, labels)


def attach_labels(df: DataFrame, labels: DataFrame) -> DataFrame:
    """Left join of known intents; the escape-hatch label and missing labels become null."""
    known = labels.filter(F.col("intent") != UNCLEAR).select("tweet_id", "intent")
    return df.join(known, "tweet_id", "left")


def corpus_profile(corpus: DataFrame) -> DataFrame:
    return corpus.groupBy("response_type").agg(
        F.count(F.lit(1)).alias("n"), F.count("intent").alias("n_labelled")
    )

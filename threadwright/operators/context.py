"""Ordered views of a thread: first messages, transcripts as text, labelling sheets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import flatten_lines, truncated
from ..functions.vocab import CONTEXT_MESSAGES, CONTEXT_WIDTH
from ..sources.messages import role_label
from .threads import packed_time, time_order


def first_customer_messages(rows: DataFrame) -> DataFrame:
    """First customer message of each thread; unparsed times sort last.

    A hash aggregate over numbers finds the id, so each task sends one candidate per thread;
    the message is then looked up by its id, which must be unique within the thread.
    """
    customers = rows.filter("is_customer")
    first = customers.groupBy("root").agg(F.min_by("tweet_id", packed_time()).alias("tweet_id"))
    messages = customers.select("root", "tweet_id", "ts", "created_at", "text")
    return first.join(messages, ["root", "tweet_id"]).select("root", "tweet_id", "ts", "created_at", "text")


def thread_context(
    rows: DataFrame,
    max_messages: int = CONTEXT_MESSAGES,
    width: int = CONTEXT_WIDTH,
    support_label: str = "APPLESUPPORT",
) -> DataFrame:
    """(root, conversation_context): the first messages as ``ROLE: text`` lines.

    Only ``max_messages + 1`` rows per thread survive the rank filter (applied before the shuffle
    as a group limit), so the collected list is bounded; the extra row tells whether to add
    the truncation note.
    """
    line = F.concat(
        role_label(F.col("is_support"), support_label, "CUSTOMER"),
        F.lit(": "),
        truncated(flatten_lines(F.coalesce("text", F.lit(""))), width),
    )
    rank = F.row_number().over(Window.partitionBy("root").orderBy(*time_order()))
    first = rows.select("root", "ts", "tweet_id", line.alias("line")).withColumn("rn", rank)
    first = first.filter(F.col("rn") <= max_messages + 1)
    lines = F.array_sort(F.collect_list(F.when(F.col("rn") <= max_messages, F.struct("rn", "line"))))
    note = F.when(F.max("rn") > max_messages, F.lit(" [thread truncated]")).otherwise("")
    return first.groupBy("root").agg(
        F.concat(F.array_join(F.transform(lines, lambda x: x["line"]), "\n"), note).alias("conversation_context")
    )


def labeling_rows(rows: DataFrame, max_messages: int = CONTEXT_MESSAGES, width: int = CONTEXT_WIDTH) -> DataFrame:
    """One row per thread with a customer message, labels left blank."""
    stats = (
        rows.groupBy("root")
        .agg(
            F.min_by("tweet_id", packed_time()).alias("thread_root_tweet_id"),
            F.count(F.lit(1)).alias("thread_size"),
            F.count_if("is_customer").alias("num_customer_messages"),
            F.count_if("is_support").alias("num_support_messages"),
            F.min_by("tweet_id", F.when(F.col("is_customer"), packed_time())).alias("tweet_id"),
        )
        .filter("num_customer_messages > 0")
    )
    primary = rows.filter("is_customer").select("root", "tweet_id", "created_at", "text")
    return stats.join(thread_context(rows, max_messages, width), "root").join(primary, ["root", "tweet_id"]).select(
        "root",
        "tweet_id",
        "thread_root_tweet_id",
        "thread_size",
        "num_customer_messages",
        "num_support_messages",
        "created_at",
        flatten_lines(F.coalesce("text", F.lit(""))).alias("customer_text"),
        "conversation_context",
        F.lit("").alias("intent"),
        F.lit("").alias("labeling_notes"),
    )

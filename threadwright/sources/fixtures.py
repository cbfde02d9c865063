"""Support-shaped messages derived from the ``events`` table.

Each user's events, in time order, are cut into chains of ``2 + user_id % 5`` messages that
alternate between customer and support. See ``FIXTURES.md``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.distribution import exact_rank, values_frame

CUSTOMER_PHRASES = [
    "@Brand0 my battery drains so fast since the update",
    "My WiFi keeps disconnecting on my phone",
    "All my photos disappeared after the update",
    "I was charged twice, how do I get a refund",
    "Screen cracked, what is the warranty process",
    "FaceTime will not ring on my tablet",
    "why does the keyboard glitch so much",
    "How much is financing for a new watch",
    "please help, everything is ruined",
    "hello there",
    "Typing i gives a question mark in a box",
    "my laptop is slow and the bluetooth drops",
    "@Brand1 I️ cannot type properly",
    "I need my Apple ID password reset",
    "iTunes will not sync my playlist",
    "can i buy it unlocked but it is broken",
]
SUPPORT_PHRASES = [
    "@cust1 We're glad to hear it fixed itself!",
    "@cust2 Please send us a DM with your country",
    "@cust3 Our team at the Apple Store can look at it",
    "@cust4 We're looking into this, thanks for waiting",
    "@cust5 Here's what you can do to work around the issue until it's fixed: https://t.co/abc",
    "@cust6 Have you tried to restart your phone?",
    "@cust7 Which model do you have?",
    "@cust8 Noted.",
]


def event_chains(events: DataFrame) -> DataFrame:
    """(event_id, ts, user_id, chunk, turn, prev, next) without gathering a user in one task."""
    size = F.col("user_id") % 5 + 2
    ranked = exact_rank(
        events.select("event_id", "ts", "user_id"),
        ["user_id"],
        [F.col("ts"), F.col("event_id")],
        F.date_trunc("hour", "ts"),
        "rn",
    ).withColumn("rn", F.col("rn") - 1)
    chained = ranked.withColumn("turn", F.col("rn") % size).withColumn("chunk", F.floor(F.col("rn") / size))
    before = chained.select("user_id", (F.col("rn") + 1).alias("rn"), F.col("event_id").alias("prev"))
    after = chained.select("user_id", (F.col("rn") - 1).alias("rn"), F.col("event_id").alias("next"))
    joined = chained.join(before, ["user_id", "rn"], "left").join(after, ["user_id", "rn"], "left")
    return joined.withColumn("prev", F.when(F.col("turn") > 0, F.col("prev"))).withColumn(
        "next", F.when(F.col("turn") + 1 < size, F.col("next"))
    )


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seven raw string columns, with bad times, foreign parents and odd texts mixed in."""
    chains = event_chains(spark.read.parquet(f"{sf_dir}/events.parquet"))
    customer = values_frame(spark, list(enumerate(CUSTOMER_PHRASES)), "ci bigint, customer string")
    support = values_frame(spark, list(enumerate(SUPPORT_PHRASES)), "si bigint, support string")
    e = F.col("event_id")
    is_customer = F.col("turn") % 2 == 0
    phrase = F.when(is_customer, F.col("customer")).otherwise(F.col("support"))
    tail = F.when(e % 29 == 0, "\nmore below").when(e % 61 == 0, F.repeat(F.lit(" and so on"), 40)).otherwise("")
    stamp = F.concat(F.date_format("ts", "EEE MMM dd HH:mm:ss"), F.lit(" +0000 "), F.date_format("ts", "yyyy"))
    first = F.col("turn") == 0
    return (
        chains.join(customer, F.col("ci") == e % 16)
        .join(support, F.col("si") == e % 8)
        .select(
            e.cast("string").alias("tweet_id"),
            F.when(is_customer | (e % 211 == 0), F.concat(F.lit("cust"), F.col("user_id")))
            .otherwise(F.concat(F.lit("Brand"), (F.col("user_id") + F.col("chunk")) % 6))
            .alias("author_id"),
            F.when(is_customer, "True").otherwise("False").alias("inbound"),
            F.when(e % 103 != 0, F.when(e % 101 == 0, "not a date").otherwise(stamp)).alias("created_at"),
            F.when(e % 307 == 0, "   ").otherwise(F.concat(phrase, tail)).alias("text"),
            F.when(e % 53 == 0, F.concat_ws(",", F.col("next"), e + 2000000000))
            .otherwise(F.col("next").cast("string"))
            .alias("response_tweet_id"),
            F.when(first & (e % 97 == 0), (e + 1000000000).cast("string"))
            .when(first & (e % 89 == 0), "n/a")
            .otherwise(F.col("prev").cast("string"))
            .alias("in_response_to_tweet_id"),
        )
    )

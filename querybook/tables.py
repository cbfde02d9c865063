"""Tables the queries share, derived once per session and data folder.

Messages, threads and the request/reply corpus are stored (Parquet in the staging folder), as a
deployment would keep them; label sheets and predictions are views on top.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadwright.functions import vocab as V
from threadwright.functions.patterns import lookup
from threadwright.functions.rules import topic_bucket, weak_label
from threadwright.functions.scoring import add_heuristic_scores
from threadwright.operators import context, corpus, retrieval, threads
from threadwright.sources.fixtures import raw_messages
from threadwright.sources.messages import read_message_table, typed_messages
from threadwright.sources.staging import new_path, stage

BRAND = "Brand0"

INTENT_OF_TOPIC = {
    "hardware_repair_warranty": "Hardware, Repair & Warranty",
    "account_purchase_billing": "Account, Purchases & Billing",
    "music_sync_dataloss": "Apple Music / iCloud Sync & Data Loss",
    "connectivity": "Connectivity",
    "messaging_facetime": "Messaging & Communication",
    "battery_performance": "Battery & Performance",
    "software_bug_generic": "Software / App Bug Report",
    "other_uncategorized": "UNCLEAR",
}


def pick(values: list[str], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


class Book:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def path(self, name: str) -> str:
        return new_path(self.spark, name)

    @cached_property
    def raw(self) -> DataFrame:
        path = self.path("raw_messages")
        raw_messages(self.spark, self.sf_dir).write.parquet(path)
        return read_message_table(self.spark, path)

    @cached_property
    def messages(self) -> DataFrame:
        return typed_messages(self.raw)

    @cached_property
    def threads(self) -> threads.Threads:
        return threads.build_threads(self.messages)

    @property
    def rows(self) -> DataFrame:
        return self.threads.rows

    @cached_property
    def stats(self) -> DataFrame:
        return stage(threads.thread_stats(self.rows), "thread_stats")

    @cached_property
    def openings(self) -> DataFrame:
        """First customer message of every thread: (tweet_id, text)."""
        first = context.first_customer_messages(self.rows)
        return stage(first.select("tweet_id", F.coalesce("text", F.lit("")).alias("text")), "openings")

    @cached_property
    def silver(self) -> DataFrame:
        """Rule labels of every opening message: (tweet_id, intent, confidence, note)."""
        labelled = self.openings.select("tweet_id", weak_label(F.col("text")).alias("l"))
        return labelled.select("tweet_id", "l.intent", "l.confidence", "l.note")

    @cached_property
    def corpus(self) -> DataFrame:
        built = corpus.build_corpus(self.rows, BRAND, self.silver, self.threads.hot_roots)
        return stage(built, "corpus")

    @cached_property
    def index(self) -> retrieval.Index:
        return retrieval.build_index(self.corpus, "tweet_id", "customer_text", "intent")

    @cached_property
    def document_index(self) -> retrieval.Index:
        return retrieval.build_index(self.table("documents"), "doc_id", "text", "source")

    @cached_property
    def predictions(self) -> DataFrame:
        """Stand-in predictions for every opening message (see FIXTURES.md section 3)."""
        i = F.col("tweet_id")
        topic = lookup(topic_bucket(F.col("text")), INTENT_OF_TOPIC)
        return (
            self.openings.select(
                "tweet_id",
                "text",
                weak_label(F.col("text"))["intent"].alias("golden_intent"),
                F.when(i % 11 == 0, V.INTENTS[6]).otherwise(topic).alias("predicted_intent"),
                F.when(i % 3 == 0, "AUTO-HANDLE").otherwise("ESCALATE").alias("golden_handling"),
                F.when(i % 5 < 2, "AUTO-HANDLE").otherwise("ESCALATE").alias("predicted_handling"),
                pick(V.BEHAVIORS, i % 6).alias("golden_behavior"),
                pick(V.BEHAVIORS, F.floor(i / 2) % 6).alias("predicted_response_behavior"),
                (i % 50 / 50.0).alias("top_similarity"),
                ((i % 40) / 80.0 + 0.1).alias("confidence"),
            )
            .withColumn("intent_correct", F.col("golden_intent") == F.col("predicted_intent"))
            .withColumn("handling_correct", F.col("golden_handling") == F.col("predicted_handling"))
            .withColumn("behavior_correct", F.col("golden_behavior") == F.col("predicted_response_behavior"))
        )

    @cached_property
    def scored(self) -> DataFrame:
        """Predictions with heuristic scores and a second rater."""
        i = F.col("tweet_id")
        rated = add_heuristic_scores(self.predictions)
        return rated.withColumns(
            {
                "human_relevance": 1 + i * 7 % 5,
                "human_groundedness": 1 + i * 11 % 5,
                "human_helpfulness": 1 + i * 13 % 5,
                "human_safety": F.lit(5).cast("long"),
            }
        )

    @cached_property
    def golden_sheet(self) -> DataFrame:
        """Label sheet in which every seventh row is already decided."""
        i = F.col("tweet_id")
        decided = i % 7 == 0
        return self.predictions.select(
            "tweet_id",
            F.when(decided, F.col("golden_intent")).otherwise("").alias("intent"),
            F.when(decided, F.col("golden_behavior")).otherwise("").alias("expected_response_behavior"),
            F.when(decided, F.col("golden_handling")).otherwise("").alias("expected_handling"),
            F.when(decided, F.lit("by hand")).otherwise("").alias("labeling_notes"),
        )

    @cached_property
    def review_sheet(self) -> DataFrame:
        """Proposals for every row, every fifth individually approved, some overridden."""
        approved = F.col("tweet_id") % 5 == 0
        return self.predictions.select(
            "tweet_id",
            F.col("predicted_intent").alias("proposed_intent"),
            F.col("predicted_response_behavior").alias("proposed_response_behavior"),
            F.col("predicted_handling").alias("proposed_handling"),
            F.concat(F.lit("similar to "), F.col("predicted_intent")).alias("labeling_reason"),
            F.when(approved, F.col("golden_intent")).otherwise("").alias("approved_intent"),
            F.when(approved, F.col("golden_behavior")).otherwise("").alias("approved_response_behavior"),
            F.when(approved, F.col("golden_handling")).otherwise("").alias("approved_handling"),
            F.when(approved, F.lit("checked")).otherwise("").alias("labeling_notes"),
        )

    @cached_property
    def golden_contexts(self) -> DataFrame:
        """Golden sheet with contexts for the whole-plan evaluation."""
        sheet = context.labeling_rows(self.rows).select("tweet_id", "conversation_context")
        labels = self.predictions.select(
            "tweet_id",
            F.col("predicted_intent").alias("intent"),
            F.col("golden_handling").alias("expected_handling"),
            F.col("golden_behavior").alias("expected_response_behavior"),
        )
        return sheet.join(labels, "tweet_id")


_BOOKS: dict[tuple[str, str], Book] = {}


def book(spark: SparkSession, sf_dir: str) -> Book:
    """The shared tables of this application and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BOOKS:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        _BOOKS[key] = Book(spark, sf_dir)
    return _BOOKS[key]

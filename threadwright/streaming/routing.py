"""Routing of an unbounded message feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators.retrieval import Index
from ..plans.scoring import Classify, route_messages, rule_classifier, score_messages
from ..sources.staging import staged_scope

MESSAGE_SCHEMA = StructType([StructField("message_id", LongType()), StructField("message", StringType())])


def read_feed(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """File feed of (message_id, message) with a fixed schema."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def route_stream(
    feed: DataFrame,
    index: Index,
    corpus: DataFrame,
    out_path: str,
    checkpoint: str,
    classify: Classify = rule_classifier,
) -> StreamingQuery:
    """Run the batch plan on each micro-batch against a static index.

    Every micro-batch overwrites its own ``batch_id`` folder, so a batch that is replayed after a
    failure leaves the same output, and discards its intermediate tables.
    """

    def route(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        with staged_scope():
            routed = route_messages(score_messages(batch, index, corpus, classify))
            routed.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
        batch.unpersist()

    return (
        feed.writeStream.foreachBatch(route)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def routed_table(spark: SparkSession, out_path: str) -> DataFrame:
    return spark.read.parquet(out_path).withColumn("batch_id", F.col("batch_id").cast("long"))

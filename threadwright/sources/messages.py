"""Message tables: raw string scans and the typed projection used by every operator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .records import read_quoted_csv

RAW_COLUMNS = [
    "tweet_id",
    "author_id",
    "inbound",
    "created_at",
    "text",
    "response_tweet_id",
    "in_response_to_tweet_id",
]
RAW_SCHEMA = StructType([StructField(c, StringType()) for c in RAW_COLUMNS])

CORPUS_SCHEMA = StructType(
    [
        StructField("tweet_id", LongType()),
        StructField("thread_root_tweet_id", LongType()),
        StructField("customer_text", StringType()),
        StructField("support_text", StringType()),
        StructField("response_type", StringType()),
        StructField("intent", StringType()),
    ]
)


def read_messages(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Raw message CSV: every column a string, only the empty string is null.

    Files are read in byte ranges by many tasks, also with line breaks inside quotes
    (:mod:`threadwright.sources.records`). Without any, ``multi_line=False`` saves that module's first step.
    """
    if multi_line:
        return read_quoted_csv(spark, path, RAW_SCHEMA, nullValue="", emptyValue="")
    reader = spark.read.schema(RAW_SCHEMA).options(header=True, quote='"', escape='"', nullValue="", emptyValue="")
    return reader.options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def read_message_table(spark: SparkSession, path: str) -> DataFrame:
    """Raw messages stored as Parquet (splittable and column-pruned)."""
    return spark.read.schema(RAW_SCHEMA).parquet(path)


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Typed scan of a stored request/reply corpus with 64-bit ids."""
    return read_quoted_csv(spark, path, CORPUS_SCHEMA, nullValue="")


def parse_created_at(created_at: Column) -> Column:
    """``Tue Oct 31 22:10:47 +0000 2017`` as an instant; anything unparseable is null."""
    return F.try_to_timestamp(F.substring(created_at, 5, 64), F.lit("MMM dd HH:mm:ss Z yyyy"))


def numeric_id(column: Column) -> Column:
    return column.try_cast("bigint")


def typed_messages(raw: DataFrame) -> DataFrame:
    """Numeric ids, nullable parent, role flags and parsed time next to the raw strings.

    Rows whose own id is not numeric get a null ``tweet_id``; gate them with
    :func:`threadwright.operators.quality.non_numeric_ids` before threading.
    """
    return raw.select(
        numeric_id(F.col("tweet_id")).alias("tweet_id"),
        "author_id",
        "inbound",
        F.coalesce(F.col("inbound") == "True", F.lit(False)).alias("is_customer"),
        F.coalesce(F.col("inbound") == "False", F.lit(False)).alias("is_support"),
        "created_at",
        parse_created_at(F.col("created_at")).alias("ts"),
        "text",
        "response_tweet_id",
        numeric_id(F.col("in_response_to_tweet_id")).alias("parent_id"),
    )


def role_label(is_support: Column, support: str = "SUPPORT", customer: str = "customer") -> Column:
    return F.when(is_support, F.lit(support)).otherwise(F.lit(customer))


def child_ids(response_tweet_id: Column) -> Column:
    """Comma-separated child pointers as an array of ids (profiling only, not threading)."""
    return F.transform(F.split(response_tweet_id, ","), lambda s: F.trim(s).try_cast("bigint"))


def has_many_children(response_tweet_id: Column) -> Column:
    return response_tweet_id.contains(",")

"""Label sheets and JSON records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .records import read_flat_json, read_quoted_csv

PROPOSAL_SCHEMA = StructType(
    [
        StructField("tweet_id", LongType()),
        StructField("intent", StringType()),
        StructField("confidence", StringType()),
        StructField("reason", StringType()),
    ]
)
JUDGE_SCHEMA = StructType(
    [
        StructField("tweet_id", LongType()),
        StructField("relevance", LongType()),
        StructField("groundedness", LongType()),
        StructField("helpfulness", LongType()),
        StructField("safety", LongType()),
        StructField("reasoning", StringType()),
    ]
)


def read_labels(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Label sheet CSV: all strings, a blank stays an empty string ("not decided")."""
    schema = StructType([StructField(c, StringType()) for c in columns])
    return read_quoted_csv(spark, path, schema).na.fill("")


def read_json_records(spark: SparkSession, path: str, schema: StructType, whole_files: bool = False) -> DataFrame:
    """Array(s) of flat JSON objects, a file's byte ranges read by many tasks.

    ``whole_files`` reads each file in one task instead, and takes nested objects as well.
    """
    if whole_files:
        return spark.read.schema(schema).option("multiLine", True).json(path)
    return read_flat_json(spark, path, schema)


def add_blank_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.lit("") for name in names})

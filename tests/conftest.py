from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from querybook.tables import book

    return book(spark, SF_DIR)


MESSAGE_COLUMNS = "tweet_id, author_id, is_customer, is_support, created_at, ts, text, response_tweet_id, parent_id".split(", ")


@pytest.fixture(scope="session")
def messages(spark):
    """Build typed messages from (id, parent, author, role, second, text) tuples."""
    from threadwright.sources.messages import RAW_SCHEMA, typed_messages

    def build(rows):
        raw = []
        for tid, parent, author, role, second, text in rows:
            stamp = None if second is None else f"Tue Oct 31 22:{second // 60:02d}:{second % 60:02d} +0000 2017"
            raw.append(
                (
                    str(tid),
                    author,
                    "True" if role == "c" else "False",
                    stamp,
                    text,
                    None,
                    None if parent is None else str(parent),
                )
            )
        return typed_messages(spark.createDataFrame(raw, RAW_SCHEMA))

    return build

"""Intermediate tables in the cluster's shared checkpoint folder.

Iterative operators cut their lineage by writing a Parquet table here and reading it back, so
a lost executor never loses an intermediate result. The folder is the session's
``spark.checkpoint.dir``; only a local session without one gets a temporary folder.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

_LOCATIONS: WeakKeyDictionary[DataFrame, tuple[str, str | None]] = WeakKeyDictionary()
_TABLES: set[str] = set()  # catalog names of bucketed tables that still exist
_SCOPES = threading.local()


def staging_root(spark: SparkSession) -> str:
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="threadwright-"))
        root = sc.getCheckpointDir()
    return f"{root.rstrip('/')}/threadwright/{sc.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet and return the table that was written."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return track(spark.read.schema(df.schema).parquet(path), path)


def stage_bucketed(df: DataFrame, name: str, key: str, buckets: int, **options) -> DataFrame:
    """Write ``df`` hash-bucketed by ``key`` so that later work on ``key`` needs no shuffle; ``options`` are the writer's.

    ``df`` should already be hash-partitioned by ``key`` into ``buckets`` parts; otherwise every
    task writes a piece of every bucket.
    """
    spark = df.sparkSession
    table, path = f"{name}_{uuid.uuid4().hex}", new_path(spark, name)
    df.write.format("parquet").bucketBy(buckets, key).options(path=path, **options).saveAsTable(table)
    _TABLES.add(table)
    return track(spark.table(table), path, table)


def track(df: DataFrame, path: str, table: str | None = None) -> DataFrame:
    """Note where a staged table lies, so that it can be discarded."""
    _LOCATIONS[df] = (path, table)
    for scope in getattr(_SCOPES, "open", [])[-1:]:
        scope.append(df)
    return df


def discard(df: DataFrame) -> None:
    """Delete a staged table that nothing reads any more."""
    path, table = _LOCATIONS.pop(df)
    if table:
        drop_table(df.sparkSession, table)
    drop_path(df.sparkSession, path)


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    _TABLES.discard(table)


@contextmanager
def staged_scope() -> Iterator[None]:
    """Discard on exit whatever this thread staged inside, for example per micro-batch."""
    scopes = _SCOPES.__dict__.setdefault("open", [])
    scopes.append([])
    try:
        yield
    finally:
        for df in scopes.pop():
            if df in _LOCATIONS:
                discard(df)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def drop_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def release_staging(spark: SparkSession) -> None:
    """Delete everything this application staged; call it when no result is read any more."""
    for table in list(_TABLES):
        drop_table(spark, table)
    drop_path(spark, staging_root(spark))

"""Reply-forest operators: parent resolution, thread roots and thread statistics."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import discard, drop_path, new_path, stage, stage_bucketed, staged_scope, track
from .distribution import HOT_ROWS, hot_keys, lookup_join

NO_TIME = 4 * 10**18  # microseconds, later than any timestamp


@dataclass(frozen=True)
class Threads:
    """Messages with their thread root, plus the roots that hold a great many rows."""

    rows: DataFrame
    hot_roots: tuple[int, ...] = ()


def time_order() -> list[Column]:
    """Time order inside a thread: unparsed times last, ties by id."""
    return [F.col("ts").asc_nulls_last(), F.col("tweet_id").asc()]


def packed_time() -> Column:
    """The order of :func:`time_order` as one number: microseconds above the 64 bits of the id, null times beyond the year 9999.

    A struct in an aggregation buffer makes Spark sort the rows; numbers are combined in a hash table.
    """
    micros = F.coalesce(F.unix_micros("ts"), F.lit(NO_TIME)).cast("decimal(19,0)")
    return (micros * F.lit(Decimal(1 << 64)) + F.col("tweet_id").cast("decimal(19,0)")).cast("decimal(38,0)")


def resolve_parents(messages: DataFrame, hot: tuple = ()) -> DataFrame:
    """(tweet_id, parent, dangling): the parent if it exists, else the row itself.

    A row is dangling only when it declares a numeric parent that is absent.
    """
    declared = messages.select("tweet_id", "parent_id")
    known = messages.select(F.col("tweet_id").alias("parent_id"), F.col("tweet_id").alias("__found"))
    joined = lookup_join(declared, known, "parent_id", hot=hot)
    return joined.select(
        "tweet_id",
        F.coalesce("__found", "tweet_id").alias("parent"),
        (F.col("parent_id").isNotNull() & F.col("__found").isNull()).alias("dangling"),
    )


def dangling_parents(messages: DataFrame) -> DataFrame:
    """Rows whose declared parent is not among the messages."""
    ids = messages.select(F.col("tweet_id").alias("parent_id"))
    return messages.filter(F.col("parent_id").isNotNull()).join(ids, "parent_id", "left_anti")


def jump(active: DataFrame, pointers: DataFrame, hot: tuple = ()) -> DataFrame:
    """(tweet_id, ptr, done) after every active row took over the pointer of the row it points to."""
    met = lookup_join(active.select("tweet_id", "ptr"), pointers, "ptr", how="inner", hot=hot)
    return met.select("tweet_id", F.col("next").alias("ptr"), F.col("settled").alias("done"))


def store_pointers(pointers: DataFrame, active: DataFrame) -> DataFrame:
    """The rows of ``pointers`` that an active row points to, bucketed by their id.

    The join of the next round then needs no exchange of this side.
    """
    buckets = int(pointers.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = pointers.join(active.select("ptr").distinct(), "ptr", "left_semi")
    return stage_bucketed(asked.select("ptr", "next", "settled").repartition(buckets, "ptr"), "pointers", "ptr", buckets)


def thread_roots(messages: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(tweet_id, root, dangling) for every row by pointer doubling.

    A row whose parents lead into a cycle has no root: it becomes its own and is flagged dangling;
    all other threads are not touched by it. As long as a row with a root is unfinished, some row
    finishes in every round, so a round that finishes none ends the loop.

    After round k an active row points to its ancestor 2^k steps up. Each round joins only the unfinished rows with
    only the pointers they ask for. A row asked for that is not a root itself was asked for in the round before (the ancestor
    half-way between points to it), so the next round's pointers are a part of this round's: both sides shrink,
    and nothing finished is read again. Pointers are stored bucketed by id and looked up without being
    shuffled. About log2(depth) + 1 rounds run. Only the two id columns are ever shuffled.
    """
    spark = messages.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    links = messages.select("tweet_id", "parent_id").repartition(buckets, "tweet_id")
    links = stage_bucketed(links, "links", "tweet_id", buckets)
    resolved = stage(resolve_parents(links, tuple(hot_keys(links, "parent_id", hot_rows))), "parents")

    is_root = F.col("parent") == F.col("tweet_id")
    active = resolved.filter(~is_root).select("tweet_id", F.col("parent").alias("ptr"))
    pointers = resolved.select(F.col("tweet_id").alias("ptr"), F.col("parent").alias("next"), is_root.alias("settled"))
    finished: list[DataFrame] = []
    previous = table = None
    remaining = active.count()
    before = -1
    while remaining not in (0, before):
        before = remaining
        asked = store_pointers(pointers, active)
        if table is not None:
            discard(table)
        table = asked
        hot = hot_keys(active, "ptr", hot_rows) if remaining >= hot_rows else []
        jumped = jump(active, table, tuple(hot))
        path = new_path(spark, "jump")
        jumped.write.partitionBy("done").parquet(path)
        if previous:
            drop_path(spark, f"{previous}/done=false")
        previous = path
        written = track(spark.read.schema(jumped.schema).parquet(path), path)
        finished.append(written.filter("done"))
        active = written.filter("NOT done").select("tweet_id", "ptr")
        moved = written.select(F.col("tweet_id").alias("ptr"), F.col("ptr").alias("next"), F.col("done").alias("settled"))
        pointers = table.filter("settled").unionByName(moved)
        remaining = active.count()
    if table is not None:
        discard(table)
    # a dangling row is its own root, so the flag needs no join
    found = resolved.filter(is_root).select("tweet_id", F.col("tweet_id").alias("root"), "dangling")
    for part in finished:
        found = found.unionByName(part.select("tweet_id", F.col("ptr").alias("root"), F.lit(False).alias("dangling")))
    cyclic = active.select("tweet_id", F.col("tweet_id").alias("root"), F.lit(True).alias("dangling"))
    return found.unionByName(cyclic)


def build_threads(messages: DataFrame, hot_rows: int = HOT_ROWS) -> Threads:
    """Attach ``root`` and ``dangling`` to every message and store the table once."""
    spark = messages.sparkSession
    path = new_path(spark, "threads")
    with staged_scope():
        threaded = messages.join(thread_roots(messages, hot_rows), "tweet_id")
        schema = threaded.schema
        threaded.write.parquet(path)
    rows = spark.read.schema(schema).parquet(path)
    return Threads(rows, tuple(hot_keys(rows, "root", hot_rows)))


def thread_stats(rows: DataFrame) -> DataFrame:
    """One row per root: sizes by role, first support author and distinct support authors.

    Rows are first combined per (root, author), so no task ever sees all rows of a huge thread.
    """
    per_author = rows.groupBy("root", "author_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("is_support").alias("n_support"),
        F.count_if("is_customer").alias("n_customer"),
        F.min(F.when(F.col("is_support") & F.col("author_id").isNotNull(), packed_time())).alias("first_support"),
    )
    return per_author.groupBy("root").agg(
        F.sum("n").alias("size"),
        F.sum("n_support").alias("n_support"),
        F.sum("n_customer").alias("n_customer"),
        F.min_by("author_id", "first_support").alias("brand"),
        F.count_if((F.col("n_support") > 0) & F.col("author_id").isNotNull()).alias("n_distinct_brands"),
    )


def qualifying_threads(stats: DataFrame, brand: str) -> DataFrame:
    """Threads of a brand with at least one customer and one support message."""
    return stats.filter((F.col("brand") == brand) & (F.col("n_customer") > 0) & (F.col("n_support") > 0))


def rows_of_threads(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """All messages of the given roots (a small root list is broadcast by its size)."""
    return rows.join(roots.select("root").distinct(), "root", "left_semi")


def without_threads(rows: DataFrame, roots: DataFrame) -> DataFrame:
    return rows.join(roots.select("root").distinct(), "root", "left_anti")


"""Building blocks that keep a dominant key from landing in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
MAX_HOT_KEYS = 1000
BUCKET_ROWS = 65536
COARSE_DIGITS, MAX_DIGITS = 3, 6


def values_frame(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A literal relation (optimizer-visible, so it is broadcast by size)."""

    def sql_literal(v) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return str(v).upper()
        if isinstance(v, (int, float)):
            return repr(v)
        return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"

    fields = [f.strip().rsplit(" ", 1) for f in schema.split(",")]
    body = ", ".join("(" + ", ".join(sql_literal(v) for v in row) + ")" for row in rows)
    names = ", ".join(name for name, _ in fields)
    table = spark.sql(f"SELECT * FROM VALUES {body} AS t({names})")
    return table.select(*[F.col(name).cast(kind).alias(name) for name, kind in fields])


def exact_rank(
    df: DataFrame,
    within: Sequence[str],
    order: Sequence[Column],
    bucket: Column,
    name: str = "rank",
    coarse: Column | None = None,
) -> DataFrame:
    """1-based row number inside each ``within`` group that never gathers a whole group.

    ``bucket`` must be non-null and non-decreasing along ``order`` (a hash prefix, an hour, ...).
    Rows are ranked inside (group, bucket); the bucket sizes, not the rows, are summed along the
    group to get each bucket's offset. Ranking and counting share one shuffle. Group columns must
    not be null (the offsets are joined on them). ``coarse``, non-null and non-decreasing along ``bucket``, splits a
    group with many buckets: their sizes are then summed inside (group, coarse), and only the
    sums of the coarse parts along the group.
    """
    parts = [] if coarse is None else ["__coarse"]
    keys = [*within, *parts, "__bucket"]
    tagged = df.withColumn("__bucket", bucket)
    if coarse is not None:
        tagged = tagged.withColumn("__coarse", coarse)

    def before(size: str, along: str, *groups: str) -> Column:
        earlier = Window.partitionBy(*groups).orderBy(along).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(size).over(earlier), F.lit(0))

    sizes = tagged.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    offsets = sizes.select(*keys, before("__n", "__bucket", *within, *parts).alias("__offset"))
    if coarse is not None:
        whole = sizes.groupBy(*within, "__coarse").agg(F.sum("__n").alias("__n"))
        whole = whole.select(*within, "__coarse", before("__n", "__coarse", *within).alias("__start"))
        offsets = offsets.join(whole, [*within, "__coarse"]).select(*keys, (F.col("__offset") + F.col("__start")).alias("__offset"))
    local = Window.partitionBy(*keys).orderBy(*order)
    return (
        tagged.withColumn("__local", F.row_number().over(local))
        .join(offsets, keys)
        .withColumn(name, F.col("__local") + F.col("__offset"))
        .drop("__local", "__offset", "__bucket", "__coarse")
    )


def seeded_hash(seed: int, *ids: Column) -> Column:
    """Reproducible pseudo-random sort key; equal in any engine with MD5."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[i.cast("string") for i in ids]))


def hash_rank(df: DataFrame, within: Sequence[str], seed: int, id_col: str, name: str = "rank") -> DataFrame:
    """Random order inside each group, exact for groups of any size.

    Groups are cut by as many digits of the hash as the number of rows asks for (at most about
    ``BUCKET_ROWS`` rows a bucket), and many buckets once more by the first of these digits. The rows are counted first.
    """
    ordered = df.withColumn("__hash", seeded_hash(seed, F.col(id_col)))
    buckets = max(2, -(-df.count() // BUCKET_ROWS))
    digits = min(math.ceil(math.log(buckets, 16)), MAX_DIGITS)
    coarse = F.substring("__hash", 1, COARSE_DIGITS) if digits > COARSE_DIGITS else None
    order = [F.col("__hash"), F.col(id_col)]
    return exact_rank(ordered, within, order, F.substring("__hash", 1, digits), name, coarse).drop("__hash")


def hash_key(seed: int, id_col: str) -> Column:
    """What :func:`hash_rank` orders by, as one comparable struct."""
    return F.struct(seeded_hash(seed, F.col(id_col)).alias("hash"), F.col(id_col).alias("id"))


def hash_cuts(df: DataFrame, within: Sequence[str], seed: int, id_col: str, ranks: DataFrame) -> DataFrame:
    """``ranks`` (the group columns and wanted ranks) with each rank replaced by the :func:`hash_key` found there.

    Null stands for a rank that no row has. Only ids are ranked; a row is then told to lie before
    or after a rank by its own key, so the rows themselves need not be moved. Ids must be unique.
    """
    wanted = [c for c in ranks.columns if c not in within]
    ranked = hash_rank(df.select(*within, id_col), within, seed, id_col, "__rank").join(ranks, list(within))
    at = [F.max(F.when(F.col("__rank") == F.col(c), hash_key(seed, id_col))).alias(c) for c in wanted]
    hit = ranked.filter(F.array_contains(F.array(*[F.col(c).cast("long") for c in wanted]), F.col("__rank").cast("long")))
    return hit.groupBy(*within).agg(*at)


def hot_keys(df: DataFrame, key: str, min_rows: int = HOT_ROWS, limit: int = MAX_HOT_KEYS) -> list:
    """The at most ``limit`` most frequent keys with at least ``min_rows`` rows.

    Counts are combined map-side; any key left out holds less than ``1/limit`` of the rows or
    fewer than ``min_rows`` of them.
    """
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    top = counts.filter(F.col("__n") >= min_rows).orderBy(F.desc("__n"), key).limit(limit)
    return [row[0] for row in top.collect()]


def lookup_join(left: DataFrame, right: DataFrame, key: str, how: str = "left", hot: Sequence = ()) -> DataFrame:
    """Join many rows to a table that is unique on ``key``.

    Rows of ``hot`` keys (at most ``MAX_HOT_KEYS``) meet their few matches by broadcast and are
    never shuffled on that key; all other rows take the ordinary join.
    """
    if len(hot) > MAX_HOT_KEYS:
        raise ValueError(f"at most {MAX_HOT_KEYS} hot keys can be broadcast")
    if not hot:
        return left.join(right, key, how)
    is_hot = F.coalesce(F.col(key).isin(list(hot)), F.lit(False))
    heavy = left.filter(is_hot).join(F.broadcast(right.filter(F.col(key).isin(list(hot)))), key, how)
    return heavy.unionByName(left.filter(~is_hot).join(right, key, how))

"""Reproducible samples: order by a seeded hash, take exact shares.

Only the ids are ordered. Fixed-size samples use a top-n (each task keeps n candidates);
samples that grow with a group rank the ids by :func:`hash_rank`, which splits groups of any size, and take
the rows up to the key found at the wanted rank. The tables of these keys have one row per group; they are stored, so
that the planner knows their size when it joins the rows with them. Ids must be unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import size_bucket
from ..functions.vocab import TRAINING_FRACTION
from ..sources.staging import stage
from .distribution import hash_cuts, hash_key, seeded_hash
from .threads import qualifying_threads, rows_of_threads


def sample_ids(ids: DataFrame, id_col: str, n: int, seed: int) -> DataFrame:
    """``n`` ids in hash order, without replacement."""
    key = seeded_hash(seed, F.col(id_col))
    return ids.select(id_col, key.alias("__hash")).orderBy("__hash", id_col).limit(n).select(id_col)


def sample_roots(stats: DataFrame, brand: str, n: int, seed: int) -> DataFrame:
    return sample_ids(qualifying_threads(stats, brand), "root", n, seed)


def sample_threads(rows: DataFrame, stats: DataFrame, brand: str, n: int = 400, seed: int = 42) -> DataFrame:
    """All messages of ``n`` sampled qualifying threads of the brand."""
    return rows_of_threads(rows, sample_roots(stats, brand, n, seed))


def disjoint_sample_roots(
    stats: DataFrame,
    brand: str,
    n: int = 200,
    seed: int = 4242,
    pool_n: int = 1000,
    pool_seed: int = 2024,
) -> DataFrame:
    """Sample of qualifying threads that shares none with another sample's pool."""
    pool = sample_roots(stats, brand, pool_n, pool_seed)
    candidates = qualifying_threads(stats, brand).select("root").join(pool, "root", "left_anti")
    return sample_ids(candidates, "root", n, seed)


def stratified_share(
    df: DataFrame,
    strata: list[str],
    id_col: str,
    fraction: float = TRAINING_FRACTION,
    seed: int = 77,
) -> DataFrame:
    """From each stratum ``max(1, round-half-even(fraction * n))`` rows, never more than it has."""
    take = F.least(F.greatest(F.bround(F.col("__n") * fraction, 0).cast("long"), F.lit(1)), F.col("__n"))
    quota = df.groupBy(*strata).agg(F.count(F.lit(1)).alias("__n")).select(*strata, take.alias("__take"))
    cuts = stage(hash_cuts(df, strata, seed, id_col, quota), "cuts")
    return df.join(cuts, strata).filter(hash_key(seed, id_col) <= F.col("__take")).drop("__take")


def bucketed_pick(stats: DataFrame, n: int = 27, seed: int = 43) -> DataFrame:
    """``n // 3`` threads from each of the size buckets 2, 3, 4+, topped up from what is left.

    The top-up walks the leftovers bucket by bucket in root order.
    """
    tagged = stats.select("root", "size", size_bucket(F.col("size")).alias("bucket")).withColumn(
        "__hash", seeded_hash(seed, F.col("root"))
    )
    by_hash = Window.partitionBy("bucket").orderBy("__hash", "root")
    first = tagged.withColumn("__rank", F.row_number().over(by_hash)).filter(F.col("__rank") <= n // 3)
    first = first.select("root", "size", "bucket", F.lit(1).alias("round"))
    # at most n rows can be missing, so n leftovers in order are enough
    leftovers = (
        tagged.join(first.select("root"), "root", "left_anti")
        .orderBy("bucket", "root")
        .limit(n)
        .select("root", "size", "bucket", F.lit(2).alias("round"))
    )
    return first.unionByName(leftovers).orderBy("round", "bucket", "root").limit(n)


def split_sizes(n: Column) -> tuple[Column, Column, Column]:
    """Train, validation and test sizes of the 70/15/15 split of ``n`` rows."""
    held_out = F.ceil(n * F.lit(0.30))
    test = F.ceil(held_out * F.lit(0.50))
    return n - held_out, held_out - test, test


def _largest_remainder(counts: DataFrame, size: str, total: Column, out: str) -> DataFrame:
    """Share ``total`` rows over the classes in proportion to ``size``; whole numbers, exact sum."""
    everything = Window.partitionBy(F.lit(1))
    exact = F.col(size) * total / F.sum(size).over(everything)
    shares = counts.withColumn("__exact", exact).withColumn("__floor", F.floor("__exact"))
    missing = total - F.sum("__floor").over(everything)
    by_remainder = Window.partitionBy(F.lit(1)).orderBy(F.desc(F.round(F.col("__exact") - F.col("__floor"), 9)), "label")
    return (
        shares.withColumn("__missing", missing)
        .withColumn("__place", F.row_number().over(by_remainder))
        .withColumn(out, F.col("__floor") + F.when(F.col("__place") <= F.col("__missing"), 1).otherwise(0))
        .drop("__exact", "__floor", "__missing", "__place")
    )


def split_plan(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Rows per class and split; one row per class of a closed vocabulary."""
    counts = df.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    train, validation, _ = split_sizes(F.col("__total"))
    plan = counts.withColumn("__total", total).withColumn("__train", train).withColumn("__val", validation)
    plan = _largest_remainder(plan, "n", F.col("__train"), "n_train")
    plan = plan.withColumn("__rest", F.col("n") - F.col("n_train"))
    plan = _largest_remainder(plan, "__rest", F.col("__val"), "n_validation")
    return plan.select(
        "label", "n", "n_train", "n_validation", (F.col("__rest") - F.col("n_validation")).alias("n_test")
    )


def stratified_split(df: DataFrame, label_col: str, id_col: str, seed: int = 42) -> DataFrame:
    """Adds ``split`` (train / validation / test), stratified 70/15/15 by label."""
    ends = split_plan(df, label_col).select(
        F.col("label").alias(label_col), F.col("n_train").alias("__train"), (F.col("n_train") + F.col("n_validation")).alias("__val")
    )
    # a class may have no training or validation rows, or no rows at these ranks at all
    cuts = stage(hash_cuts(df, [label_col], seed, id_col, ends), "cuts")
    key = hash_key(seed, id_col)
    split = F.when(key <= F.col("__train"), "train").when(key <= F.col("__val"), "validation").otherwise("test")
    joined = df.filter(F.col(label_col).isNotNull()).join(cuts, label_col, "left")
    return joined.withColumn("split", split).drop("__train", "__val")


def coverage_sample(df: DataFrame, dimensions: list[str], id_col: str, size: int = 30, seed: int = 8080) -> DataFrame:
    """``size`` rows that show every value of every dimension, in shuffled order.

    The first row (by seeded hash) of each value is taken; rows that stand for several values come
    first if there are more than ``size``. What room is left goes to the joint strata of the other
    rows by largest remainder, and within a stratum to the first rows by hash. Everything but the
    number of covering rows (``size`` at most) stays in Spark.
    """
    tagged = df.withColumn("__draw", seeded_hash(seed, F.col(id_col)))
    values = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dimensions])
    seen = tagged.select("__draw", F.explode(values).alias("v"))
    firsts = seen.groupBy("v.dimension", "v.value").agg(F.min("__draw").alias("__draw"))
    firsts = firsts.groupBy("__draw").agg(F.count(F.lit(1)).alias("__values")).orderBy(F.desc("__values"), "__draw").limit(size)
    cover = stage(firsts.select("__draw"), "coverage")
    room = size - cover.count()

    label = F.concat_ws(" | ", *[F.coalesce(F.col(d).cast("string"), F.lit("")) for d in dimensions])
    rest = tagged.join(cover, "__draw", "left_anti").withColumn("label", label)
    strata = rest.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    quota = _largest_remainder(strata, "n", F.lit(room), "__take").select("label", "__take")
    # no stratum gives more than ``size`` rows, so each task keeps that many candidates of it
    place = F.row_number().over(Window.partitionBy("label").orderBy("__draw", id_col))
    first = rest.withColumn("__rank", place).filter(F.col("__rank") <= size)
    filled = first.join(quota, "label").filter("__rank <= __take")
    picked = tagged.join(cover, "__draw", "left_semi").unionByName(filled.select(tagged.columns))
    return picked.orderBy("__draw").drop("__draw")


def simple_sample(df: DataFrame, id_col: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` whole rows in hash order; only their ids are sorted. Ids must be unique."""
    ids = stage(sample_ids(df, id_col, n, seed), "sample-ids")
    return df.join(ids, id_col, "left_semi").orderBy(seeded_hash(seed, F.col(id_col)), id_col)

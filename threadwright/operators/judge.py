"""Aggregation of reply-quality scores and agreement between two raters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.special import correlation_p_value
from ..functions.vocab import JUDGE_DIMENSIONS
from .distribution import exact_rank
from .quantiles import exact_quantile

SCORES = [*JUDGE_DIMENSIONS, "overall"]


def join_scores(predictions: DataFrame, scores: DataFrame) -> DataFrame:
    return predictions.join(scores, "tweet_id")


def average_scores(scored: DataFrame, columns: Sequence[str] = tuple(SCORES)) -> DataFrame:
    return scored.agg(F.count(F.lit(1)).alias("n_judged"), *[F.avg(c).alias(c) for c in columns])


def average_scores_by(scored: DataFrame, by: str, columns: Sequence[str] = tuple(SCORES)) -> DataFrame:
    return scored.groupBy(by).agg(*[F.bround(F.avg(c), 2).alias(c) for c in columns])


def weakest_dimension(scored: DataFrame, dimensions: Sequence[str] = tuple(JUDGE_DIMENSIONS)) -> DataFrame:
    """Dimension with the lowest average; on ties the one listed first."""
    row = average_scores(scored, dimensions)
    parts = ", ".join(f"{i}, '{d}', `{d}`" for i, d in enumerate(dimensions))
    long = row.selectExpr(f"stack({len(dimensions)}, {parts}) AS (position, dimension, average)")
    return long.agg(
        F.min_by("dimension", F.struct("average", "position")).alias("dimension"), F.min("average").alias("average")
    )


def low_quartile(scored: DataFrame, column: str = "overall") -> DataFrame:
    """Rows at or below the exact 25th percentile; ties stay, so it may exceed a quarter."""
    cut = exact_quantile(scored, column, 0.25, name="cut").scalar()
    return scored.filter(F.col(column) <= cut)


def lowest_scored(scored: DataFrame, column: str = "overall", n: int | None = None, id_col: str = "tweet_id") -> DataFrame:
    """Rows from the lowest score up, ties by id and unscored rows last; the first ``n`` if given."""
    ordered = scored.orderBy(F.col(column).asc_nulls_last(), id_col)
    return ordered if n is None else ordered.limit(n)


def low_quartile_distribution(scored: DataFrame, by: str = "predicted_response_behavior") -> DataFrame:
    return low_quartile(scored).groupBy(by).agg(F.count(F.lit(1)).alias("n"))


def representative_rows(
    scored: DataFrame, score: str = "overall", id_col: str = "tweet_id", cap: int = 10, id_buckets: int = 256
) -> DataFrame:
    """Three lowest, four through the middle and three highest rows by (score, id), at most ``cap``.

    Positions come from :func:`exact_rank` over (score, id quantile) buckets inside score quantiles, so no
    task sorts or sums the whole table and a score shared by many rows is still split. Only ids and scores are
    ranked; the at most ``cap`` ids found are then looked up. Ids must be unique.
    """
    def cuts(column: str) -> Column:
        at = F.array(*[F.lit(i / id_buckets) for i in range(1, id_buckets)])
        return scored.agg(F.percentile_approx(column, at, 10000).alias("b")).scalar()

    def part(column: str, bounds: str) -> Column:
        return F.coalesce(F.size(F.filter(bounds, lambda b: b < F.col(column))), F.lit(-1))

    tagged = scored.select(id_col, score, cuts(id_col).alias("__b"), cuts(score).alias("__s"))
    bucket = F.struct(F.col(score), part(id_col, "__b").alias("p"))
    ranked = exact_rank(tagged, [], [F.col(score), F.col(id_col)], bucket, "position", part(score, "__s"))
    total = scored.agg(F.count(F.lit(1)).alias("n")).scalar()
    ranked = ranked.withColumn("position", F.col("position") - 1).withColumn("__n", total)
    n = F.col("__n")
    low, high = n * F.lit(0.35), n * F.lit(0.65)
    spread = [low, low + (high - low) / 3, low + 2 * ((high - low) / 3), high]
    spread = [F.least(p.cast("long"), n - 1) for p in spread]
    middle = F.lit(False)
    for target in spread:
        middle = middle | (F.col("position") == target)
    group = F.when(F.col("position") < 3, 1).when(middle, 2).when(F.col("position") >= n - 3, 3)
    chosen = ranked.withColumn("__group", group).filter("__group IS NOT NULL")
    chosen = chosen.orderBy("__group", "position").limit(cap).select(id_col, "position", "__group")
    found = scored.join(F.broadcast(chosen), id_col).orderBy("__group", "position")
    return found.select(*scored.columns, "position")


def agreement(scored: DataFrame, pairs: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Exact rate, mean absolute difference and Pearson r per (dimension, human, machine) triple.

    r is null below two rows or without variance; ``t`` is its test statistic with n - 2
    degrees of freedom and ``p_value`` the two-sided probability of it. Rows where either score is missing
    must be filtered before.
    """
    aggregates = [F.count(F.lit(1)).alias("n")]
    for i, (_, human, machine) in enumerate(pairs):
        h, m = F.col(human).cast("double"), F.col(machine).cast("double")
        # corr() itself fails on a constant series in ANSI mode
        varied = (F.min(h) < F.max(h)) & (F.min(m) < F.max(m))
        r = F.try_divide(F.covar_pop(h, m), F.stddev_pop(h) * F.stddev_pop(m))
        aggregates += [
            F.avg((h == m).cast("double")).alias(f"e{i}"),
            F.avg(F.abs(h - m)).alias(f"d{i}"),
            F.when(varied, r).alias(f"r{i}"),
        ]
    row = scored.agg(*aggregates)
    parts = ", ".join(f"'{name}', e{i}, d{i}, r{i}" for i, (name, _, _) in enumerate(pairs))
    long = row.selectExpr("n", f"stack({len(pairs)}, {parts}) AS (dimension, exact_rate, mean_abs_diff, pearson_r)")
    r = F.col("pearson_r")
    t = F.when((F.abs(r) < 1) & (F.col("n") > 2), r * F.sqrt((F.col("n") - 2) / (1 - r * r)))
    p_value = correlation_p_value(r, F.col("n")).alias("p_value")
    return long.select("dimension", "n", "exact_rate", "mean_abs_diff", "pearson_r", t.alias("t"), p_value)


def largest_disagreements(
    scored: DataFrame, pairs: Sequence[tuple[str, str, str]], id_col: str = "tweet_id", n: int = 5
) -> DataFrame:
    total = F.lit(0)
    for _, human, machine in pairs:
        total = total + F.abs(F.col(human).cast("long") - F.col(machine).cast("long"))
    return scored.withColumn("total_diff", total).orderBy(F.desc("total_diff"), id_col).limit(n)

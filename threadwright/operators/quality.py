"""Data-quality gates. Each returns one row of violation counts; zero everywhere means passed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_filled
from .profile import duplicate_ids


class QualityError(ValueError):
    """A gate counted violations."""


def require(violations: DataFrame, gate: str) -> None:
    """Raise unless every count in the one-row frame is zero."""
    row = violations.first().asDict()
    bad = {name: n for name, n in row.items() if n}
    if bad:
        raise QualityError(f"{gate}: {bad}")


def non_numeric_ids(raw: DataFrame, column: str = "tweet_id") -> DataFrame:
    return raw.agg(F.count_if(F.col(column).try_cast("bigint").isNull()).alias("n_bad_ids"))


def repeated_ids(df: DataFrame, column: str = "tweet_id") -> DataFrame:
    return duplicate_ids(df, column)


def outside_vocabulary(df: DataFrame, vocabularies: dict[str, Sequence[str]]) -> DataFrame:
    """Rows per column whose value is null or not in its closed vocabulary."""
    return df.agg(
        *[
            F.count_if(~F.coalesce(F.col(column).isin(*allowed), F.lit(False))).alias(f"bad_{column}")
            for column, allowed in vocabularies.items()
        ]
    )


def unlabelled(df: DataFrame, column: str = "intent") -> DataFrame:
    return df.agg(F.count_if(F.col(column).isNull()).alias("n_unlabelled"))


def not_one_to_one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys that are missing on one side or repeated on either; both sides are counted per key first."""
    a = left.groupBy(key).agg(F.count(F.lit(1)).alias("a"))
    b = right.groupBy(key).agg(F.count(F.lit(1)).alias("b"))
    both = a.join(b, key, "full")
    return both.agg(
        F.count_if(F.col("b").isNull()).alias("only_left"),
        F.count_if(F.col("a").isNull()).alias("only_right"),
        F.count_if((F.col("a") > 1) | (F.col("b") > 1)).alias("repeated"),
    )


def misplaced_proposals(proposals: DataFrame, golden: DataFrame) -> DataFrame:
    """Proposals without exactly one golden row, and those whose golden row is not blank."""
    counts = golden.groupBy("tweet_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(is_filled(F.col("intent"))).alias("labelled")
    )
    joined = proposals.select("tweet_id").join(counts, "tweet_id", "left")
    return joined.agg(
        F.count_if(F.coalesce("n", F.lit(0)) != 1).alias("not_exactly_one"),
        F.count_if(F.coalesce("labelled", F.lit(0)) > 0).alias("already_labelled"),
    )


def overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys that occur in both sets."""
    return left.select(key).intersect(right.select(key)).agg(F.count(F.lit(1)).alias("n_overlap"))


def non_blank(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per column that must still be blank but are not."""
    return df.agg(*[F.count_if(is_filled(F.col(c))).alias(f"filled_{c}") for c in columns])


def still_blank(df: DataFrame, *columns: str) -> DataFrame:
    return df.agg(*[F.count_if(~is_filled(F.col(c))).alias(f"blank_{c}") for c in columns])


def scores_out_of_range(df: DataFrame, *columns: str, low: int = 1, high: int = 5) -> DataFrame:
    return df.agg(
        *[F.count_if(~F.coalesce(F.col(c).between(low, high), F.lit(False))).alias(f"bad_{c}") for c in columns]
    )


def unexpected_row_count(df: DataFrame, expected: int) -> DataFrame:
    return df.agg(F.abs(F.count(F.lit(1)) - expected).alias("n_off"))

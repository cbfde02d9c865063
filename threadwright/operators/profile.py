"""Dataset profile operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from ..sources.messages import has_many_children


def unpivot_counts(row: DataFrame, key: str = "metric", value: str = "n") -> DataFrame:
    """Turn a one-row frame of bigint counts into (key, value) rows."""
    pairs = ", ".join(f"'{c}', `{c}`" for c in row.columns)
    return row.selectExpr(f"stack({len(row.columns)}, {pairs}) AS ({key}, {value})")


def shape(df: DataFrame) -> DataFrame:
    """Row count next to each column name and its position."""
    names = F.array(*[F.lit(c) for c in df.columns])
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.posexplode(names).alias("position", "column"), "n_rows")


def head(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*order).limit(n)


def null_counts(df: DataFrame) -> DataFrame:
    return unpivot_counts(df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]), "column", "n_null")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Counts per value; null is a value."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def time_range(messages: DataFrame) -> DataFrame:
    """Earliest, latest and rows whose time is present but does not parse."""
    return messages.agg(
        F.min("ts").alias("earliest"),
        F.max("ts").alias("latest"),
        F.count_if(F.col("ts").isNull() & F.col("created_at").isNotNull()).alias("n_unparsed"),
    )


def empty_texts(df: DataFrame, column: str = "text") -> DataFrame:
    return df.agg(F.count_if(F.col(column).isNull() | (strip(F.col(column)) == "")).alias("n_empty"))


def pointer_coverage(raw: DataFrame, *columns: str) -> DataFrame:
    """Populated and missing rows and the populated share, one row per pointer column."""
    stats = raw.agg(F.count(F.lit(1)).alias("n"), *[F.count(c).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return stats.selectExpr("n", f"stack({len(columns)}, {pairs}) AS (pointer, populated)").select(
        "pointer",
        "populated",
        (F.col("n") - F.col("populated")).alias("missing"),
        F.try_divide("populated", "n").alias("share"),
    )


def many_children(raw: DataFrame) -> DataFrame:
    return raw.agg(F.count_if(has_many_children(F.col("response_tweet_id"))).alias("n_multi"))


def author_counts(messages: DataFrame) -> DataFrame:
    """Distinct authors per role and ids that occur more than once, in two combined passes."""
    authors = messages.groupBy("author_id").agg(
        F.max("is_customer").alias("is_customer"), F.max("is_support").alias("is_support")
    )
    known = F.col("author_id").isNotNull()
    roles = authors.agg(
        F.count_if(known & F.col("is_customer")).alias("n_customer_authors"),
        F.count_if(known & F.col("is_support")).alias("n_support_authors"),
    )
    return roles.withColumn("n_duplicates", duplicate_ids(messages).scalar())


def duplicate_ids(messages: DataFrame, column: str = "tweet_id") -> DataFrame:
    """Rows beyond the first of each id."""
    per_id = messages.groupBy(column).agg((F.count(F.lit(1)) - 1).alias("extra"))
    return per_id.agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("n_duplicates"))


def support_accounts(messages: DataFrame) -> DataFrame:
    return messages.filter("is_support").select("author_id").distinct().orderBy("author_id")


def authors_in_both_roles(messages: DataFrame) -> DataFrame:
    customers = messages.filter("is_customer").select("author_id")
    return customers.intersect(messages.filter("is_support").select("author_id"))


def parent_resolution_rate(messages: DataFrame, sample: DataFrame | None = None) -> DataFrame:
    """Declared parents and how many of them exist; over all rows unless a sample is given."""
    declared = (messages if sample is None else sample).filter(F.col("parent_id").isNotNull()).select("parent_id")
    # many replies share a parent: look each distinct parent up once
    wanted = declared.groupBy("parent_id").agg(F.count(F.lit(1)).alias("n"))
    found = wanted.join(messages.select(F.col("tweet_id").alias("parent_id"), F.lit(True).alias("ok")), "parent_id", "left")
    return found.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("declared"),
        F.coalesce(F.sum(F.when(F.col("ok"), F.col("n"))), F.lit(0)).alias("resolved"),
    ).select("declared", "resolved", F.try_divide("resolved", "declared").alias("rate"))


def share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part * 100.0, whole), F.lit(0.0))

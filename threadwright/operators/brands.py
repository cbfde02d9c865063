"""Support-account reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import flatten_lines, strip, truncated
from ..sources.messages import role_label
from .quantiles import exact_quantile


def _percent(condition: Column) -> Column:
    return F.avg(condition.cast("double")) * 100


def brand_metrics(rows: DataFrame, stats: DataFrame) -> DataFrame:
    """One row per support account; accounts that lead no thread get zeros.

    Thread figures come from the per-thread table, row figures from one pass over the messages;
    both are aggregated per account before they meet.
    """
    accounts = (
        rows.groupBy("author_id")
        .agg(
            F.count_if("is_support").alias("support_tweets"),
            _percent(F.col("dangling")).alias("dangling_pct"),
        )
        .filter("support_tweets > 0 AND author_id IS NOT NULL")
        .withColumnRenamed("author_id", "brand")
    )
    size = F.col("size")
    threads = (
        stats.filter("brand IS NOT NULL")
        .groupBy("brand")
        .agg(
            F.count(F.lit(1)).alias("n_threads"),
            F.sum("n_support").alias("support_tweets_in_threads"),
            F.sum("n_customer").alias("customer_tweets_in_threads"),
            F.sum("size").alias("total_tweets_in_threads"),
            F.count_if(F.col("n_customer") > 0).alias("resolution_pairs"),
            F.avg("size").alias("mean_len"),
            _percent(size >= 2).alias("pct_2plus"),
            _percent(size >= 3).alias("pct_3plus"),
            _percent(size >= 4).alias("pct_4plus"),
            F.max("size").alias("max_len"),
            _percent(size == 1).alias("isolated_pct"),
            _percent(F.col("n_distinct_brands") > 1).alias("multi_brand_thread_pct"),
        )
    )
    medians = exact_quantile(stats.filter("brand IS NOT NULL"), "size", 0.5, ["brand"], "median_len")
    return (
        accounts.join(threads, "brand", "left")
        .join(medians, "brand", "left")
        .na.fill(0)
        .select(
            "brand",
            "n_threads",
            "support_tweets",
            "support_tweets_in_threads",
            "customer_tweets_in_threads",
            "total_tweets_in_threads",
            "resolution_pairs",
            "median_len",
            "mean_len",
            "pct_2plus",
            "pct_3plus",
            "pct_4plus",
            "max_len",
            "isolated_pct",
            "multi_brand_thread_pct",
            "dangling_pct",
        )
    )


def thread_totals(rows: DataFrame) -> DataFrame:
    """Number of threads (rows that are their own root) and of dangling rows."""
    return rows.agg(
        F.count_if(F.col("root") == F.col("tweet_id")).alias("n_threads"), F.count_if("dangling").alias("n_dangling")
    )


def rank_brands(metrics: DataFrame, by: str = "resolution_pairs") -> DataFrame:
    return metrics.orderBy(F.desc(by), "brand")


def top_brands(metrics: DataFrame, n: int = 7, by: str = "resolution_pairs") -> DataFrame:
    chosen = metrics.select("brand", "n_threads", "resolution_pairs", "pct_3plus", "dangling_pct")
    return chosen.orderBy(F.desc(by), "brand").limit(n)


def brand_threads(rows: DataFrame) -> DataFrame:
    """Distinct (brand, root) pairs: every thread in which an account wrote a support message."""
    return rows.filter("is_support").select(F.col("author_id").alias("brand"), "root").distinct()


def handle_signal(rows: DataFrame, brands: list[str] | None = None) -> DataFrame:
    """Share of customer messages in a brand's threads that open with its @handle.

    Customer rows are first reduced to counts per (thread, leading token). A token is matched with
    the accounts it opens with once, by its prefixes of the lengths that handles have, so tokens never meet
    accounts they do not name.
    """
    pairs = brand_threads(rows)
    if brands is not None:
        pairs = pairs.filter(F.col("brand").isin(brands))
    opening = F.lower(strip(F.coalesce("text", F.lit(""))))
    token = F.regexp_extract(opening, r"^(@\S*)", 1)
    customers = rows.filter("is_customer").groupBy("root", token.alias("token")).agg(F.count(F.lit(1)).alias("n"))
    totals = pairs.join(customers.groupBy("root").agg(F.sum("n").alias("n")), "root").groupBy("brand").agg(F.sum("n").alias("n_customer"))

    handles = pairs.select("brand").distinct().withColumn("prefix", F.concat(F.lit("@"), F.lower("brand")))
    # only prefixes as long as some handle can name an account
    lengths = handles.agg(F.collect_set(F.length("prefix")).alias("lengths")).scalar()
    tokens = customers.filter("token <> ''").select("token").distinct().withColumn("lengths", lengths)
    fitting = F.filter("lengths", lambda size: size <= F.length("token"))
    prefixes = tokens.select("token", F.explode(fitting).alias("length")).withColumn("prefix", F.expr("substring(token, 1, length)"))
    named = prefixes.join(handles, "prefix").select("token", "brand")
    opened = customers.join(named, "token").join(pairs, ["root", "brand"]).groupBy("brand").agg(F.sum("n").alias("n_handle"))
    return (
        totals.join(opened, "brand", "left")
        .withColumn("n_handle", F.coalesce("n_handle", F.lit(0).cast("long")))
        .withColumn("handle_pct", F.try_divide(F.col("n_handle") * 100.0, "n_customer"))
    )


def example_threads(rows: DataFrame, stats: DataFrame, per_brand: int = 2, low: int = 3, high: int = 5) -> DataFrame:
    """Up to ``per_brand`` threads per account; sizes outside the range only if none is inside."""
    sized = brand_threads(rows).join(stats.select("root", "size"), "root")
    inside = F.col("size").between(low, high)
    ranked = sized.withColumn("inside", inside).withColumn(
        "rank", F.row_number().over(Window.partitionBy("brand").orderBy(F.desc("inside"), "root"))
    )
    few = ranked.filter(F.col("rank") <= per_brand)
    best = F.max("inside").over(Window.partitionBy("brand"))
    return few.withColumn("best", best).filter("inside = best").select("brand", "root", "size", "rank")


def transcript(rows: DataFrame, roots: DataFrame, width: int = 200) -> DataFrame:
    """Messages of chosen threads as printable lines in thread and time order.

    Lines stay rows: the global sort splits even a thread with billions of messages.
    """
    line = F.concat(
        F.lit("["),
        role_label(F.col("is_support")),
        F.lit("] "),
        F.coalesce("author_id", F.lit("")),
        F.lit(": "),
        truncated(flatten_lines(F.coalesce("text", F.lit(""))), width),
    )
    chosen = rows.join(roots.select("root").distinct(), "root", "left_semi")
    return chosen.orderBy("root", F.col("ts").asc_nulls_last(), "tweet_id").select(
        "root", "tweet_id", "ts", line.alias("line")
    )

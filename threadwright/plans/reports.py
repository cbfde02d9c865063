"""Dataset profile, account report and two-sample replication report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import classify_reply, issue_tags
from ..functions.text import clean_text, strip
from ..functions.vocab import CANNED_FRAGMENT, KEYWORD_STOP_WORDS, REPLY_CLASSES
from ..operators import brands, metrics, profile, sampling
from ..operators.quantiles import exact_quantile
from ..operators.threads import Threads, thread_stats
from ..sources.messages import has_many_children, parse_created_at, typed_messages
from ..sources.staging import stage


def dataset_profile(raw: DataFrame) -> DataFrame:
    """(section, item, n) rows.

    All row-level figures come from one pass over the raw table; roles, authors and parents need
    one pre-combined aggregate each.
    """
    pointers = ("response_tweet_id", "in_response_to_tweet_id")
    figures = {
        ("rows", "rows"): F.count(F.lit(1)),
        ("rows", "unparsed_times"): F.count_if(
            parse_created_at(F.col("created_at")).isNull() & F.col("created_at").isNotNull()
        ),
        ("rows", "empty_texts"): F.count_if(F.col("text").isNull() | (strip(F.col("text")) == "")),
        ("pointers", "n_multi"): F.count_if(has_many_children(F.col("response_tweet_id"))),
        **{("missing", c): F.count_if(F.col(c).isNull()) for c in raw.columns},
        **{("populated", c): F.count(c) for c in pointers},
    }
    row = raw.agg(*[figure.alias(f"f{i}") for i, figure in enumerate(figures.values())])
    parts = ", ".join(f"'{section}', '{item}', f{i}" for i, (section, item) in enumerate(figures))
    table = row.selectExpr(f"stack({len(figures)}, {parts}) AS (section, item, n)")

    def section(name: str, df: DataFrame, item: str, n: str) -> DataFrame:
        return df.select(F.lit(name).alias("section"), F.col(item).alias("item"), F.col(n).alias("n"))

    messages = typed_messages(raw)
    authors = profile.unpivot_counts(profile.author_counts(messages))
    both = profile.authors_in_both_roles(messages).agg(F.count(F.lit(1)).alias("n"))
    parents = profile.unpivot_counts(profile.parent_resolution_rate(messages).select("declared", "resolved"))
    return (
        table.unionByName(section("role", profile.value_counts(raw, "inbound"), "value", "n"))
        .unionByName(section("authors", authors, "metric", "n"))
        .unionByName(section("authors", both.withColumn("metric", F.lit("authors_in_both_roles")), "metric", "n"))
        .unionByName(section("parents", parents, "metric", "n"))
    )


@dataclass(frozen=True)
class BrandReport:
    metrics: DataFrame
    top: DataFrame
    examples: DataFrame
    transcripts: DataFrame
    handle_signal: DataFrame


def brand_report(threads: Threads, top: int = 7, per_brand: int = 1) -> BrandReport:
    """Account metrics in rank order, the leading accounts, example threads and handle check."""
    stats = thread_stats(threads.rows)
    table = brands.brand_metrics(threads.rows, stats)
    leading = brands.top_brands(table, top)
    examples = brands.example_threads(threads.rows, stats, per_brand).join(
        F.broadcast(leading.select("brand")), "brand", "left_semi"
    )
    signal = brands.handle_signal(threads.rows).join(F.broadcast(leading.select("brand")), "brand", "left_semi")
    return BrandReport(
        brands.rank_brands(table), leading, examples, brands.transcript(threads.rows, examples), signal
    )


def keyword_frequency(
    messages: DataFrame, top_n: int = 40, stop_words: Sequence[str] = KEYWORD_STOP_WORDS
) -> DataFrame:
    """Most frequent keywords of customer messages, ties by word; counted before the shuffle."""
    words = messages.filter("is_customer").select(
        F.explode(F.split(clean_text(F.coalesce("text", F.lit(""))), r"\s+")).alias("word")
    )
    kept = words.filter((F.length("word") > 2) & ~F.col("word").isin(*stop_words))
    return kept.groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word").limit(top_n)


def thread_sample_stats(rows: DataFrame) -> DataFrame:
    """Thread count, length statistics and messages by role of a sample."""
    size = F.col("size")

    def pct(condition: Column) -> Column:
        return F.avg(condition.cast("double")) * 100

    per_thread = rows.groupBy("root").agg(
        F.count(F.lit(1)).alias("size"),
        F.count_if("is_customer").alias("n_customer"),
        F.count_if("is_support").alias("n_support"),
    )
    return per_thread.agg(
        F.count(F.lit(1)).alias("n_threads_sampled"),
        F.avg("size").alias("mean_thread_len"),
        F.first(exact_quantile(per_thread, "size", 0.5).scalar()).alias("median_thread_len"),
        pct(size == 2).alias("pct_exactly_2_turns"),
        pct(size >= 3).alias("pct_3plus_turns"),
        pct(size >= 4).alias("pct_4plus_turns"),
        F.coalesce(F.sum("n_customer"), F.lit(0)).alias("n_customer_messages"),
        F.coalesce(F.sum("n_support"), F.lit(0)).alias("n_support_messages"),
    )


def issue_tag_counts(messages: DataFrame) -> DataFrame:
    return metrics.tag_counts(messages.filter("is_customer"), issue_tags(F.coalesce("text", F.lit(""))))


def reply_class_counts(messages: DataFrame) -> DataFrame:
    replies = messages.filter("is_support").select(classify_reply(F.coalesce("text", F.lit(""))).alias("reply_class"))
    return metrics.category_shares(replies, "reply_class", REPLY_CLASSES)


def canned_reply_rate(messages: DataFrame, fragment: str = CANNED_FRAGMENT) -> DataFrame:
    hit = F.coalesce(F.contains(F.lower("text"), F.lit(fragment)), F.lit(False))
    row = messages.filter("is_support").agg(F.count(F.lit(1)).alias("n_replies"), F.count_if(hit).alias("n_canned"))
    return row.withColumn("pct", metrics.zero_safe(F.col("n_canned") * 100.0, F.col("n_replies")))


def sample_overlap(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.select("root").intersect(second.select("root")).agg(F.count(F.lit(1)).alias("n_overlap"))


def observed_classes(first: DataFrame, second: DataFrame) -> DataFrame:
    """Reply classes that occur in at least one of two samples."""

    def classes(df: DataFrame) -> DataFrame:
        return df.filter("is_support").select(classify_reply(F.coalesce("text", F.lit(""))).alias("reply_class"))

    return classes(first).union(classes(second)).distinct()


def sample_figures(rows: DataFrame) -> DataFrame:
    """(section, item, value) of one sample: statistics, tags, reply classes, canned replies."""
    stats = thread_sample_stats(rows)
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in stats.columns)
    numbers = stats.selectExpr("'stats' AS section", f"stack({len(stats.columns)}, {pairs}) AS (item, value)")
    tags = issue_tag_counts(rows).selectExpr("'tag' AS section", "tag AS item", "CAST(n AS DOUBLE) AS value")
    classes = reply_class_counts(rows).selectExpr("'reply' AS section", "label AS item", "CAST(n AS DOUBLE) AS value")
    canned = canned_reply_rate(rows).selectExpr("'canned' AS section", "'n_canned' AS item", "CAST(n_canned AS DOUBLE) AS value")
    return numbers.unionByName(tags).unionByName(classes).unionByName(canned)


def compare_samples(first: DataFrame, second: DataFrame) -> DataFrame:
    """The figures of two samples side by side."""
    tagged = sample_figures(first).withColumn("sample", F.lit("sample1")).unionByName(
        sample_figures(second).withColumn("sample", F.lit("sample2"))
    )
    return tagged.groupBy("section", "item").pivot("sample", ["sample1", "sample2"]).agg(F.sum("value"))


def paired_samples(
    threads: Threads, brand: str, n: int = 400, seeds: tuple[int, int] = (42, 123)
) -> tuple[DataFrame, DataFrame]:
    """The messages of two independent samples, read from the threads table in one pass and stored."""
    stats = thread_stats(threads.rows)
    first, second = (
        sampling.sample_roots(stats, brand, n, seed).withColumn("sample", F.lit(i)) for i, seed in enumerate(seeds)
    )
    rows = stage(threads.rows.join(first.unionByName(second), "root"), "samples")
    return rows.filter("sample = 0").drop("sample"), rows.filter("sample = 1").drop("sample")


def replication_report(threads: Threads, brand: str, n: int = 400, seeds: tuple[int, int] = (42, 123)) -> DataFrame:
    """Two independent samples of the brand's threads compared, with their overlap."""
    first, second = paired_samples(threads, brand, n, seeds)
    common = sample_overlap(first, second).selectExpr(
        "'overlap' AS section",
        "'threads' AS item",
        "CAST(n_overlap AS DOUBLE) AS sample1",
        "CAST(n_overlap AS DOUBLE) AS sample2",
    )
    return compare_samples(first, second).unionByName(common)

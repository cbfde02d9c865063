"""Dataset profile queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadwright.operators import profile
from threadwright.plans import reports
from threadwright.sources.messages import RAW_COLUMNS

from .oracle import compose, listed, strip
from .registry import query
from .tables import Book


@query(
    "D1",
    lambda: compose(
        f"SELECT CAST(i - 1 AS BIGINT) AS position, ([{listed(RAW_COLUMNS)}])[i] AS \"column\", n AS n_rows "
        "FROM (SELECT count(*) AS n, unnest(range(1, 8)) AS i FROM raw)"
    ),
)
def table_shape(b: Book) -> DataFrame:
    return profile.shape(b.raw).withColumn("position", F.col("position").cast("long"))


@query("D1", lambda: compose("SELECT tweet_id, author_id, text FROM m ORDER BY tweet_id LIMIT 5"))
def table_head(b: Book) -> DataFrame:
    return profile.head(b.messages, 5, "tweet_id").select("tweet_id", "author_id", "text")


@query(
    "D2",
    lambda: compose(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS n_null FROM raw" for c in RAW_COLUMNS
        )
    ),
)
def null_counts(b: Book) -> DataFrame:
    return profile.null_counts(b.raw)


@query("D2", "SELECT 'o_orderkey' AS \"column\", count(*) FILTER (o_orderkey IS NULL) AS n_null FROM orders "
       "UNION ALL SELECT 'o_custkey', count(*) FILTER (o_custkey IS NULL) FROM orders "
       "UNION ALL SELECT 'o_orderstatus', count(*) FILTER (o_orderstatus IS NULL) FROM orders")
def order_null_counts(b: Book) -> DataFrame:
    return profile.null_counts(b.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus"))


@query("D3", lambda: compose("SELECT inbound AS value, count(*) AS n FROM raw GROUP BY inbound"))
def role_counts(b: Book) -> DataFrame:
    return profile.value_counts(b.raw, "inbound")


@query("D3", "SELECT event_type AS value, count(*) AS n FROM events GROUP BY event_type")
def event_type_counts(b: Book) -> DataFrame:
    return profile.value_counts(b.table("events"), "event_type")


@query(
    "D4",
    lambda: compose(
        "SELECT CAST(epoch_us(min(ts)) AS BIGINT) AS earliest, CAST(epoch_us(max(ts)) AS BIGINT) AS latest, "
        "count(*) FILTER (ts IS NULL AND created_at IS NOT NULL) AS n_unparsed FROM m"
    ),
)
def time_range(b: Book) -> DataFrame:
    return profile.time_range(b.messages).select(
        F.unix_micros("earliest").alias("earliest"), F.unix_micros("latest").alias("latest"), "n_unparsed"
    )


@query("D5", lambda: compose(f"SELECT count(*) FILTER (text IS NULL OR {strip('text')} = '') AS n_empty FROM m"))
def empty_texts(b: Book) -> DataFrame:
    return profile.empty_texts(b.messages)


@query(
    "D6",
    lambda: compose(
        " UNION ALL ".join(
            f"SELECT '{c}' AS pointer, count({c}) AS populated, count(*) - count({c}) AS missing, "
            f"round(count({c}) / count(*)::DOUBLE, 6) AS share FROM raw"
            for c in ("response_tweet_id", "in_response_to_tweet_id")
        )
    ),
)
def pointer_coverage(b: Book) -> DataFrame:
    table = profile.pointer_coverage(b.raw, "response_tweet_id", "in_response_to_tweet_id")
    return table.withColumn("share", F.round("share", 6))


@query("D6, B11", lambda: compose("SELECT count(*) FILTER (contains(response_tweet_id, ',')) AS n_multi FROM raw"))
def multi_child_count(b: Book) -> DataFrame:
    return profile.many_children(b.raw)


@query(
    "D7",
    lambda: compose(
        "SELECT count(DISTINCT author_id) FILTER (is_customer) AS n_customer_authors, "
        "count(DISTINCT author_id) FILTER (is_support) AS n_support_authors, "
        "count(*) - count(DISTINCT tweet_id) AS n_duplicates FROM m"
    ),
)
def author_counts(b: Book) -> DataFrame:
    return profile.author_counts(b.messages)


@query("D7", lambda: compose("SELECT DISTINCT author_id FROM m WHERE is_support"))
def support_accounts(b: Book) -> DataFrame:
    return profile.support_accounts(b.messages)


@query(
    "G1",
    lambda: compose("SELECT author_id FROM m WHERE is_customer INTERSECT SELECT author_id FROM m WHERE is_support"),
)
def authors_in_both_roles(b: Book) -> DataFrame:
    return profile.authors_in_both_roles(b.messages)


@query(
    "C2",
    lambda: compose(
        "SELECT count(*) FILTER (m.parent_id IS NOT NULL) AS declared, "
        "count(*) FILTER (m.parent_id IS NOT NULL AND NOT par.dangling) AS resolved, "
        "round(count(*) FILTER (m.parent_id IS NOT NULL AND NOT par.dangling) / "
        "count(*) FILTER (m.parent_id IS NOT NULL)::DOUBLE, 6) AS rate FROM m JOIN par USING (tweet_id)"
    ),
)
def parent_resolution_rate(b: Book) -> DataFrame:
    return profile.parent_resolution_rate(b.messages).withColumn("rate", F.round("rate", 6))


def _profile_parts() -> str:
    parts = [
        "SELECT 'rows' AS section, 'rows' AS item, count(*) AS n FROM m",
        "SELECT 'rows', 'unparsed_times', count(*) FILTER (ts IS NULL AND created_at IS NOT NULL) FROM m",
        f"SELECT 'rows', 'empty_texts', count(*) FILTER (text IS NULL OR {strip('text')} = '') FROM m",
        "SELECT 'role', inbound, count(*) FROM m GROUP BY inbound",
        "SELECT 'authors', 'n_customer_authors', count(DISTINCT author_id) FROM m WHERE is_customer",
        "SELECT 'authors', 'n_support_authors', count(DISTINCT author_id) FROM m WHERE is_support",
        "SELECT 'authors', 'n_duplicates', count(*) - count(DISTINCT tweet_id) FROM m",
        "SELECT 'authors', 'authors_in_both_roles', count(DISTINCT author_id) FROM m WHERE is_support "
        "AND author_id IN (SELECT author_id FROM m WHERE is_customer)",
        "SELECT 'parents', 'declared', count(parent_id) FROM m",
        "SELECT 'parents', 'resolved', count(*) FROM m WHERE parent_id IN (SELECT tweet_id FROM m)",
        "SELECT 'pointers', 'n_multi', count(*) FROM raw WHERE contains(response_tweet_id, ',')",
    ]
    parts += [f"SELECT 'missing', '{c}', count(*) - count({c}) FROM raw" for c in RAW_COLUMNS]
    parts += [
        f"SELECT 'populated', '{c}', count({c}) FROM raw" for c in ("response_tweet_id", "in_response_to_tweet_id")
    ]
    return " UNION ALL ".join(parts)


@query("K5", lambda: compose(_profile_parts()))
def dataset_profile(b: Book) -> DataFrame:
    return reports.dataset_profile(b.raw)

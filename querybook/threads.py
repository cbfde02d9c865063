"""Threading, account and corpus queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadwright.operators import brands, context, corpus, sampling, threads
from threadwright.plans import reports

from .oracle import compose, cut, flat
from .registry import query
from .tables import BRAND, Book

PERCENTS = [
    "median_len",
    "mean_len",
    "pct_2plus",
    "pct_3plus",
    "pct_4plus",
    "isolated_pct",
    "multi_brand_thread_pct",
    "dangling_pct",
]


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def sql_rounded(columns: list[str], plain: list[str]) -> str:
    return ", ".join(plain + [f"round({c}, 6) AS {c}" for c in columns])


BRAND_COUNTS = [
    "brand",
    "n_threads",
    "support_tweets",
    "support_tweets_in_threads",
    "customer_tweets_in_threads",
    "total_tweets_in_threads",
    "resolution_pairs",
    "max_len",
]


@query("C1", lambda: compose("SELECT tweet_id, parent, dangling FROM par"))
def resolved_parents(b: Book) -> DataFrame:
    return threads.resolve_parents(b.messages)


@query("C2", lambda: compose("SELECT m.tweet_id, m.parent_id FROM m JOIN par USING (tweet_id) WHERE par.dangling"))
def dangling_parents(b: Book) -> DataFrame:
    return threads.dangling_parents(b.messages).select("tweet_id", "parent_id")


@query("C3", lambda: compose("SELECT up.tweet_id, up.root, par.dangling FROM up JOIN par USING (tweet_id)"))
def thread_roots(b: Book) -> DataFrame:
    return threads.thread_roots(b.messages)


CHAIN = 10_000


@query(
    "C3",
    lambda: (
        "SELECT event_id AS tweet_id, max(CASE WHEN opens THEN event_id END) OVER (ORDER BY event_id) AS root, "
        f"opens AND event_id % {CHAIN} <> 0 AS dangling FROM (SELECT event_id, event_id % {CHAIN} = 0 OR "
        "event_id - 1 NOT IN (SELECT event_id FROM events) AS opens FROM events)"
    ),
)
def chained_event_roots(b: Book) -> DataFrame:
    """Deep threads: every event answers the one before it, in chains of 10,000."""
    id_ = F.col("event_id")
    parent = F.when(id_ % CHAIN != 0, id_ - 1)
    return threads.thread_roots(b.table("events").select(id_.alias("tweet_id"), parent.alias("parent_id")))


@query("C3", lambda: "SELECT event_id AS tweet_id, (SELECT min(event_id) FROM events) AS root, FALSE AS dangling FROM events")
def star_event_roots(b: Book) -> DataFrame:
    """One row that all others answer."""
    events = b.table("events").select("event_id")
    first = events.agg(F.min("event_id").alias("first"))
    linked = events.join(F.broadcast(first)).select(
        F.col("event_id").alias("tweet_id"), F.when(F.col("event_id") != F.col("first"), F.col("first")).alias("parent_id")
    )
    return threads.thread_roots(linked)


@query(
    "C3",
    """
    WITH RECURSIVE up AS (
      SELECT conv_id, turn, turn AS root FROM conversations WHERE turn = 0 OR turn % 4 = 0
      UNION ALL
      SELECT c.conv_id, c.turn, up.root FROM conversations c JOIN up ON c.conv_id = up.conv_id AND c.turn = up.turn + 1
      WHERE c.turn % 4 <> 0)
    SELECT conv_id * 1000000 + turn AS tweet_id, conv_id * 1000000 + root AS root FROM up
    """,
)
def conversation_roots(b: Book) -> DataFrame:
    """Dialogue turns linked to the previous turn, restarted every fourth turn."""
    turn = F.col("conv_id") * 1000000 + F.col("turn")
    links = b.table("conversations").select(
        turn.alias("tweet_id"), F.when(F.col("turn") % 4 != 0, turn - 1).alias("parent_id")
    )
    return threads.thread_roots(links).select("tweet_id", "root")


@query("C4", lambda: compose(f"SELECT t.tweet_id, t.root FROM t JOIN st USING (root) WHERE st.brand = '{BRAND}' AND st.n_customer > 0 AND st.n_support > 0"))
def rows_of_brand_threads(b: Book) -> DataFrame:
    chosen = threads.qualifying_threads(b.stats, BRAND)
    return threads.rows_of_threads(b.rows, chosen).select("tweet_id", "root")


@query("C5, G4", lambda: compose(f"SELECT tweet_id, root FROM t WHERE root NOT IN (SELECT root FROM st WHERE brand = '{BRAND}')"))
def rows_outside_brand_threads(b: Book) -> DataFrame:
    return threads.without_threads(b.rows, b.stats.filter(F.col("brand") == BRAND)).select("tweet_id", "root")


@query("C6", lambda: compose("SELECT tweet_id, intent FROM corpus"))
def labelled_corpus(b: Book) -> DataFrame:
    plain = corpus.build_corpus(b.rows, BRAND, None, b.threads.hot_roots).drop("intent")
    return corpus.attach_labels(plain, b.silver).select("tweet_id", "intent")


@query(
    "C6",
    "SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)",
)
def labelled_documents(b: Book) -> DataFrame:
    return b.table("documents").select("doc_id", "lang").join(b.table("labels"), "doc_id", "left")


@query("C8", lambda: compose("SELECT root, reply_id, support_text FROM reply"))
def first_reply_after(b: Book) -> DataFrame:
    return corpus.first_reply_after(b.rows, b.threads.hot_roots).select("root", "reply_id", "support_text")


@query("D8", lambda: compose("SELECT root, size, n_support, n_customer, brand, n_distinct_brands FROM st"))
def thread_stats(b: Book) -> DataFrame:
    return threads.thread_stats(b.rows)


@query("D9", lambda: compose(f"SELECT {sql_rounded(PERCENTS, BRAND_COUNTS)} FROM bm"))
def brand_metrics(b: Book) -> DataFrame:
    return rounded(brands.brand_metrics(b.rows, b.stats), *PERCENTS)


@query(
    "D10",
    lambda: compose("SELECT count(DISTINCT root) AS n_threads, count(*) FILTER (dangling) AS n_dangling FROM t"),
)
def thread_totals(b: Book) -> DataFrame:
    return brands.thread_totals(b.rows)


SIGNAL = (
    "SELECT p.brand, count(*) AS n_customer, count(*) FILTER (starts_with(lower(trim(t.text)), '@' || lower(p.brand))) AS n_handle, "
    "round(100.0 * count(*) FILTER (starts_with(lower(trim(t.text)), '@' || lower(p.brand))) / count(*), 6) AS handle_pct "
    "FROM (SELECT DISTINCT author_id AS brand, root FROM t WHERE is_support) p JOIN t ON t.root = p.root WHERE t.is_customer GROUP BY p.brand"
)


@query("D12", lambda: compose(SIGNAL))
def handle_signal(b: Book) -> DataFrame:
    return rounded(brands.handle_signal(b.rows), "handle_pct")


@query(
    "F1",
    lambda: compose("SELECT brand, resolution_pairs, row_number() OVER (ORDER BY resolution_pairs DESC, brand) AS place FROM bm"),
)
def brand_ranking(b: Book) -> DataFrame:
    from pyspark.sql import Window

    # the place is only numbered for checking: one row per account
    ordered = brands.rank_brands(brands.brand_metrics(b.rows, b.stats)).select("brand", "resolution_pairs")
    place = F.row_number().over(Window.orderBy(F.desc("resolution_pairs"), "brand")).cast("long")
    return ordered.withColumn("place", place)


TOP = (
    "SELECT brand, n_threads, resolution_pairs, round(pct_3plus, 6) AS pct_3plus, round(dangling_pct, 6) AS dangling_pct "
    "FROM bm ORDER BY resolution_pairs DESC, brand LIMIT 7"
)


@query("F2", lambda: compose(TOP))
def top_brands(b: Book) -> DataFrame:
    top = brands.top_brands(brands.brand_metrics(b.rows, b.stats), 7)
    return rounded(top, "pct_3plus", "dangling_pct")


EXAMPLES = (
    "SELECT brand, root, size FROM (SELECT brand, root, size, inside, max(inside) OVER (PARTITION BY brand) AS best, "
    "row_number() OVER (PARTITION BY brand ORDER BY inside DESC, root) AS k FROM (SELECT p.brand, p.root, st.size, "
    "CAST(st.size BETWEEN 3 AND 5 AS INT) AS inside FROM (SELECT DISTINCT author_id AS brand, root FROM t WHERE is_support) p "
    "JOIN st USING (root))) WHERE k <= 2 AND inside = best"
)


@query("H9, B9", lambda: compose(EXAMPLES))
def example_threads(b: Book) -> DataFrame:
    return brands.example_threads(b.rows, b.stats, 2).select("brand", "root", "size")


TRANSCRIPTS = (
    "SELECT t.root, t.tweet_id, '[' || CASE WHEN t.is_support THEN 'SUPPORT' ELSE 'customer' END || '] ' || t.author_id || ': ' || "
    f"({cut(flat('t.text'), 200)}) AS line FROM t"
)


@query("E5", lambda: compose(TRANSCRIPTS + f" WHERE t.root IN (SELECT root FROM ({EXAMPLES}))"))
def thread_transcripts(b: Book) -> DataFrame:
    chosen = brands.example_threads(b.rows, b.stats, 2)
    return brands.transcript(b.rows, chosen).select("root", "tweet_id", "line")


@query("E1", lambda: compose("SELECT root, tweet_id, created_at, text FROM fc"))
def first_customer_messages(b: Book) -> DataFrame:
    return context.first_customer_messages(b.rows).select("root", "tweet_id", "created_at", "text")


@query(
    "E1",
    "SELECT conv_id, turn, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k "
    "FROM conversations WHERE role = 'user') WHERE k = 1",
)
def first_user_turns(b: Book) -> DataFrame:
    turns = b.table("conversations").select(
        F.col("conv_id").alias("root"),
        F.col("turn").alias("tweet_id"),
        F.lit(None).cast("timestamp").alias("ts"),
        F.lit(None).cast("string").alias("created_at"),
        "text",
        (F.col("role") == "user").alias("is_customer"),
    )
    return context.first_customer_messages(turns).select(
        F.col("root").alias("conv_id"), F.col("tweet_id").alias("turn"), "text"
    )


@query("E2", lambda: compose("SELECT root, conversation_context FROM ctx"))
def thread_context(b: Book) -> DataFrame:
    return context.thread_context(b.rows)


@query(
    "E2",
    f"""
    SELECT root, string_agg(line, chr(10) ORDER BY rn) FILTER (rn <= 2) || CASE WHEN max(rn) > 2 THEN ' [thread truncated]' ELSE '' END
      AS conversation_context
    FROM (SELECT conv_id AS root, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn,
            CASE WHEN role = 'assistant' THEN 'APPLESUPPORT' ELSE 'CUSTOMER' END || ': ' || ({cut(flat('text'), 80)}) AS line
          FROM conversations) GROUP BY root
    """,
)
def conversation_context(b: Book) -> DataFrame:
    """Two turns of 80 characters, so that both truncation rules apply."""
    turns = b.table("conversations").select(
        F.col("conv_id").alias("root"),
        F.col("turn").alias("tweet_id"),
        F.lit(None).cast("timestamp").alias("ts"),
        "text",
        (F.col("role") == "assistant").alias("is_support"),
    )
    return context.thread_context(turns, 2, 80)


@query(
    "E3",
    lambda: compose(
        "SELECT root, tweet_id, thread_root_tweet_id, thread_size, num_customer_messages, num_support_messages, created_at, "
        "customer_text, conversation_context, intent, labeling_notes FROM sheet"
    ),
)
def labeling_rows(b: Book) -> DataFrame:
    return context.labeling_rows(b.rows)


@query(
    "E4, I6",
    lambda: compose(
        "SELECT tweet_id, root, thread_root_tweet_id, customer_text, support_text, response_type, intent FROM corpus"
    ),
)
def request_reply_corpus(b: Book) -> DataFrame:
    return corpus.build_corpus(b.rows, BRAND, b.silver, b.threads.hot_roots)


@query(
    "D34",
    lambda: compose("SELECT response_type, count(*) AS n, count(intent) AS n_labelled FROM corpus GROUP BY response_type"),
)
def corpus_profile(b: Book) -> DataFrame:
    return corpus.corpus_profile(b.corpus)


@query("D34", lambda: compose("SELECT size, count(*) AS n FROM st GROUP BY size"))
def thread_size_histogram(b: Book) -> DataFrame:
    return b.stats.groupBy("size").agg(F.count(F.lit(1)).alias("n"))


@query(
    "D11",
    lambda: compose(
        "SELECT count(*) AS n_threads_sampled, round(avg(size), 6) AS mean_thread_len, quantile_cont(size, 0.5) AS median_thread_len, "
        "round(avg(CAST(size = 2 AS INT)) * 100, 6) AS pct_exactly_2_turns, round(avg(CAST(size >= 3 AS INT)) * 100, 6) AS pct_3plus_turns, "
        "round(avg(CAST(size >= 4 AS INT)) * 100, 6) AS pct_4plus_turns, CAST(sum(n_customer) AS BIGINT) AS n_customer_messages, "
        f"CAST(sum(n_support) AS BIGINT) AS n_support_messages FROM st WHERE brand = '{BRAND}'"
    ),
)
def thread_sample_stats(b: Book) -> DataFrame:
    rows = threads.rows_of_threads(b.rows, b.stats.filter(F.col("brand") == BRAND))
    table = reports.thread_sample_stats(rows)
    return rounded(table, "mean_thread_len", "pct_exactly_2_turns", "pct_3plus_turns", "pct_4plus_turns")


@query(
    "H5",
    lambda: compose(
        "SELECT root, size, bucket FROM (SELECT *, 1 AS turn FROM h5first UNION ALL SELECT root, size, bucket, 2 FROM h5all "
        "WHERE root NOT IN (SELECT root FROM h5first)) ORDER BY turn, bucket, root LIMIT 27",
        {
            "h5all": (
                "SELECT root, size, CASE size WHEN 2 THEN '2' WHEN 3 THEN '3' ELSE '4+' END AS bucket, "
                "md5('43:' || root) AS h FROM st"
            ),
            "h5first": (
                "SELECT root, size, bucket FROM (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY h, root) AS k "
                "FROM h5all) WHERE k <= 9"
            ),
        },
    ),
)
def bucketed_pick(b: Book) -> DataFrame:
    return sampling.bucketed_pick(b.stats).select("root", "size", "bucket")


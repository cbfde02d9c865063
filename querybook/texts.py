"""Text rule queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadwright.functions import rules, text
from threadwright.functions import vocab as V
from threadwright.operators import context, metrics
from threadwright.plans import reports

from .oracle import WORD, compose, glitch, listed, mapped, matched_count, matches, q, reply_class, strip, topic, weak
from .registry import query
from .tables import Book

def clean_sql(x: str) -> str:
    links = f"regexp_replace(coalesce({x}, ''), 'http\\S+', '', 'g')"
    mentions = f"regexp_replace({links}, '@{WORD}+', '', 'g')"
    return f"regexp_replace(lower({mentions}), '[^a-z0-9''\\s]', ' ', 'g')"


WORDS = f"SELECT unnest(regexp_split_to_array({clean_sql('text')}, '\\s+')) AS word FROM t WHERE is_customer"


@query("I1", lambda: compose(f"SELECT tweet_id, {clean_sql('text')} AS cleaned FROM m"))
def cleaned_texts(b: Book) -> DataFrame:
    return b.messages.select("tweet_id", text.clean_text(F.coalesce("text", F.lit(""))).alias("cleaned"))


@query("I1", f"SELECT doc_id, md5({clean_sql('text')}) AS cleaned_md5 FROM documents")
def cleaned_documents(b: Book) -> DataFrame:
    cleaned = text.clean_text(F.coalesce("text", F.lit("")))
    return b.table("documents").select("doc_id", F.md5(cleaned).alias("cleaned_md5"))


@query(
    "I2",
    lambda: compose(
        f"SELECT tweet_id, coalesce(string_agg(word, ' ' ORDER BY i), '') AS keywords FROM (SELECT tweet_id, "
        f"unnest(regexp_split_to_array({clean_sql('text')}, '\\s+')) AS word, generate_subscripts(regexp_split_to_array({clean_sql('text')}, '\\s+'), 1) AS i FROM m) "
        f"WHERE length(word) > 2 AND word NOT IN ({listed(V.KEYWORD_STOP_WORDS)}) GROUP BY tweet_id"
    ),
)
def message_keywords(b: Book) -> DataFrame:
    words = text.keywords(F.coalesce("text", F.lit("")))
    joined = b.messages.select("tweet_id", F.array_join(words, " ").alias("keywords"))
    return joined.filter(F.col("keywords") != "")


@query(
    "D13, F3",
    lambda: compose(
        f"SELECT word, count(*) AS n FROM ({WORDS}) WHERE length(word) > 2 AND word NOT IN ({listed(V.KEYWORD_STOP_WORDS)}) "
        "GROUP BY word ORDER BY n DESC, word LIMIT 40"
    ),
)
def keyword_frequency(b: Book) -> DataFrame:
    return reports.keyword_frequency(b.rows)


@query(
    "D13",
    "SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(" + clean_sql("text") + ", '\\s+')) AS word FROM documents) "
    f"WHERE length(word) > 2 AND word NOT IN ({listed(V.KEYWORD_STOP_WORDS)}) GROUP BY word ORDER BY n DESC, word LIMIT 40",
)
def document_keywords(b: Book) -> DataFrame:
    docs = b.table("documents").select("text", F.lit(True).alias("is_customer"))
    return reports.keyword_frequency(docs)


@query("I3", lambda: compose(f"SELECT tweet_id, {glitch('text')} AS glitch FROM m"))
def glitch_flags(b: Book) -> DataFrame:
    return b.messages.select("tweet_id", text.is_glitch(F.col("text")).alias("glitch"))


TAGS = {**{name: matches("lower(text)", p) for name, p in V.ISSUE_TAGS.items()}, "i_autocorrect_bug": glitch("text")}


@query("I4", lambda: compose("SELECT tweet_id, " + ", ".join(f"{c} AS {name}" for name, c in TAGS.items()) + " FROM m WHERE is_customer"))
def issue_tags(b: Book) -> DataFrame:
    tags = rules.issue_tags(F.col("text"))
    return b.messages.filter("is_customer").select("tweet_id", *[c.alias(name) for name, c in tags.items()])


@query(
    "D14",
    lambda: compose(
        " UNION ALL ".join(
            f"SELECT '{name}' AS tag, count(*) FILTER ({c}) AS n, round(100.0 * count(*) FILTER ({c}) / count(*), 6) AS pct FROM t WHERE is_customer"
            for name, c in TAGS.items()
        )
    ),
)
def issue_tag_counts(b: Book) -> DataFrame:
    return reports.issue_tag_counts(b.rows).withColumn("pct", F.round("pct", 6))


@query("I5", lambda: compose(f"SELECT tweet_id, {reply_class('text')} AS reply_class FROM m WHERE is_support"))
def reply_classes(b: Book) -> DataFrame:
    return b.messages.filter("is_support").select("tweet_id", rules.classify_reply(F.col("text")).alias("reply_class"))


@query(
    "D15, I5",
    lambda: compose(
        " UNION ALL ".join(
            f"SELECT '{name}' AS label, count(*) FILTER ({reply_class('text')} = '{name}') AS n, "
            f"round(100.0 * count(*) FILTER ({reply_class('text')} = '{name}') / count(*), 6) AS pct FROM t WHERE is_support"
            for name in V.REPLY_CLASSES
        )
    ),
)
def reply_class_counts(b: Book) -> DataFrame:
    return reports.reply_class_counts(b.rows).withColumn("pct", F.round("pct", 6))


@query(
    "D17",
    lambda: compose(
        f"SELECT count(*) AS n_replies, count(*) FILTER (contains(lower(text), {q(V.CANNED_FRAGMENT)})) AS n_canned, "
        f"round(100.0 * count(*) FILTER (contains(lower(text), {q(V.CANNED_FRAGMENT)})) / count(*), 6) AS pct FROM t WHERE is_support"
    ),
)
def canned_reply_rate(b: Book) -> DataFrame:
    return reports.canned_reply_rate(b.rows).withColumn("pct", F.round("pct", 6))


@query(
    "I6, C10",
    lambda: compose(
        "SELECT tweet_id, response_type, "
        + mapped("response_type", V.BEHAVIOR_OF_RESPONSE_TYPE, "'unclear'")
        + f" AS behavior FROM (SELECT tweet_id, {mapped(reply_class('text'), V.RESPONSE_TYPE_OF_CLASS)} AS response_type FROM m WHERE is_support)"
    ),
)
def response_types(b: Book) -> DataFrame:
    kind = rules.response_type(rules.classify_reply(F.col("text")))
    typed = b.messages.filter("is_support").select("tweet_id", kind.alias("response_type"))
    return typed.withColumn("behavior", rules.response_behavior(F.col("response_type")))


@query(
    "I7, I8",
    lambda: compose(
        "SELECT tweet_id, CASE WHEN thread_size <= 2 THEN 'short' WHEN thread_size <= 4 THEN 'medium' ELSE 'long' END AS length_bucket, "
        f"{topic('customer_text')} AS topic_bucket FROM sheet"
    ),
)
def sampling_buckets(b: Book) -> DataFrame:
    return context.labeling_rows(b.rows).select(
        "tweet_id",
        rules.length_bucket(F.col("thread_size")).alias("length_bucket"),
        rules.topic_bucket(F.col("customer_text")).alias("topic_bucket"),
    )


@query(
    "I9",
    lambda: compose(
        f"SELECT tweet_id, {weak('text', 0)} AS intent, {weak('text', 1)} AS note, {weak('text', 2)} AS confidence FROM m WHERE is_customer"
    ),
)
def weak_labels(b: Book) -> DataFrame:
    label = rules.weak_label(F.col("text"))
    return b.messages.filter("is_customer").select("tweet_id", label.alias("l")).select("tweet_id", "l.*")


@query(
    "I9",
    lambda: compose(
        f"SELECT tweet_id, {weak('conversation_context', 0)} AS intent, {weak('conversation_context', 2)} AS confidence FROM sheet"
    ),
)
def weak_context_labels(b: Book) -> DataFrame:
    """Rules over whole conversations instead of single messages."""
    sheet = context.labeling_rows(b.rows).select("tweet_id", "conversation_context")
    label = rules.weak_label(F.col("conversation_context"))
    return sheet.select("tweet_id", label.alias("l")).select("tweet_id", "l.intent", "l.confidence")


@query(
    "I10",
    lambda: compose(
        "SELECT tweet_id, concat_ws('|', "
        + ", ".join(f"CASE WHEN {matches('lower(conversation_context)', p)} THEN {q(n)} END" for n, p, _, _ in V.PRIORITY_RULES)
        + f") AS matched, {matched_count('conversation_context')} > 1 AS ambiguous FROM sheet"
    ),
)
def matched_categories(b: Book) -> DataFrame:
    sheet = context.labeling_rows(b.rows).select("tweet_id", "conversation_context")
    found = sheet.select("tweet_id", rules.matched_intents(F.col("conversation_context")).alias("found"))
    return found.select("tweet_id", F.array_join("found", "|").alias("matched"), (F.size("found") > 1).alias("ambiguous"))


@query(
    "I11",
    lambda: compose(
        f"SELECT tweet_id, {strip('coalesce(substr(line, 10), conversation_context)')} AS message FROM (SELECT tweet_id, conversation_context, "
        "([x for x in string_split(conversation_context, chr(10)) if starts_with(x, 'CUSTOMER:')])[1] AS line FROM sheet)"
    ),
)
def first_customer_lines(b: Book) -> DataFrame:
    sheet = context.labeling_rows(b.rows)
    return sheet.select("tweet_id", text.first_customer_message(F.col("conversation_context")).alias("message"))


@query("I12", lambda: compose(f"SELECT tweet_id, regexp_replace({strip('text')}, '^@\\S+\\s*', '') AS bare FROM m"))
def bare_replies(b: Book) -> DataFrame:
    return b.messages.select("tweet_id", text.strip_leading_mention(F.col("text")).alias("bare"))


@query(
    "I19",
    lambda: compose("SELECT tweet_id, substr(string_split(conversation_context, chr(10))[1], 1, 110) AS line FROM sheet"),
)
def context_first_lines(b: Book) -> DataFrame:
    sheet = context.labeling_rows(b.rows)
    return sheet.select("tweet_id", text.first_line(F.col("conversation_context"), 110).alias("line"))


SHARES = " UNION ALL ".join(
    f"SELECT {q(name)} AS label, count(*) FILTER (intent = {q(name)}) AS n, "
    f"round(100.0 * count(*) FILTER (intent = {q(name)}) / count(*), 6) AS pct FROM silver"
    for name in V.INTENT_LABELS
)


@query("D15", lambda: compose(SHARES))
def intent_shares(b: Book) -> DataFrame:
    return metrics.category_shares(b.silver, "intent", V.INTENT_LABELS).withColumn("pct", F.round("pct", 6))


@query("D33", lambda: compose(f"SELECT label, n, pct FROM ({SHARES}) WHERE pct < 11.5"))
def rare_intents(b: Book) -> DataFrame:
    return metrics.rare_classes(b.silver, "intent", V.INTENT_LABELS, 11.5).withColumn("pct", F.round("pct", 6))


@query("D33", lambda: compose("SELECT confidence AS value, count(*) AS n FROM silver GROUP BY confidence"))
def confidence_breakdown(b: Book) -> DataFrame:
    from threadwright.operators.profile import value_counts

    return value_counts(b.silver, "confidence")


@query(
    "D33",
    lambda: compose(f"SELECT count(*) AS total, count(*) FILTER ({matched_count('text')} > 1) AS n_ambiguous FROM op"),
)
def ambiguous_rows(b: Book) -> DataFrame:
    return b.openings.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(rules.is_ambiguous(F.col("text"))).alias("n_ambiguous")
    )


@query(
    "E6",
    lambda: compose(
        "SELECT intent, tweet_id, text FROM (SELECT silver.intent, op.tweet_id, op.text, row_number() OVER (PARTITION BY silver.intent ORDER BY op.tweet_id) AS k "
        "FROM op JOIN silver USING (tweet_id)) WHERE k = 1"
    ),
)
def example_per_intent(b: Book) -> DataFrame:
    labelled = b.openings.join(b.silver.select("tweet_id", "intent"), "tweet_id")
    return metrics.first_per_class(labelled, "intent", "tweet_id", "text")


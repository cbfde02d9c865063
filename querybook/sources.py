"""Scans, sinks, projections and predicates on messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadwright.functions import vocab as V
from threadwright.functions.text import flatten_lines, is_filled, strip, truncated
from threadwright.operators import classifier, labels
from threadwright.plans import evaluation
from threadwright.sources import labels as label_source
from threadwright.sources import messages as source
from threadwright.sources import sinks
from threadwright.sources.staging import stage

from .oracle import compose, cut, flat, listed
from .oracle import strip as sql_strip
from .registry import query
from .tables import BRAND, Book

RAW = ", ".join(source.RAW_COLUMNS)


def one_file(df: DataFrame) -> DataFrame:
    """Exports come as one file; only this writing side of the reader queries is a single task."""
    return df.coalesce(1)


@query("A1", lambda: compose(f"SELECT {RAW} FROM raw"))
def read_messages_csv(b: Book) -> DataFrame:
    path = b.path("messages_csv")
    sinks.write_table(one_file(b.raw), path, "csv")
    return source.read_messages(b.spark, path)


@query("A2", lambda: compose("SELECT CAST(tweet_id AS VARCHAR) AS tweet_id, intent, labeling_notes FROM golden"))
def read_label_sheet(b: Book) -> DataFrame:
    path = b.path("label_sheet")
    sinks.write_table(one_file(b.golden_sheet.select("tweet_id", "intent", "labeling_notes")), path, "csv")
    return label_source.read_labels(b.spark, path, ["tweet_id", "intent", "labeling_notes"])


@query(
    "A3, A5",
    lambda: compose(
        "SELECT tweet_id, thread_root_tweet_id, customer_text, support_text, response_type, intent FROM corpus"
    ),
)
def read_corpus_csv(b: Book) -> DataFrame:
    path = b.path("corpus_csv")
    sinks.write_table(one_file(b.corpus.select(*source.CORPUS_SCHEMA.names)), path, "csv")
    return source.read_corpus(b.spark, path)


@query("A4", lambda: compose("SELECT tweet_id, intent, confidence, note AS reason FROM silver"))
def read_json_records(b: Book) -> DataFrame:
    """One array in one file, as an export comes."""
    path = b.path("proposals_json")
    record = F.to_json(F.struct("tweet_id", "intent", "confidence", F.col("note").alias("reason")))
    records = stage(b.silver.select(record.alias("value")), "proposals")
    one_file(records).mapInArrow(sinks.array_lines, "value string").write.text(path)
    return label_source.read_json_records(b.spark, path, label_source.PROPOSAL_SCHEMA)


@query("A5", lambda: compose("SELECT root, size, n_support, n_customer, brand, n_distinct_brands FROM st"))
def table_sink_round_trip(b: Book) -> DataFrame:
    path = b.path("thread_stats_table")
    sinks.write_table(b.stats, path)
    return b.spark.read.parquet(path)


@query("A6", lambda: compose(f"SELECT {flat('text')} AS value FROM t WHERE is_customer"))
def customer_lines_text(b: Book) -> DataFrame:
    path = b.path("customer_lines")
    sinks.write_customer_lines(b.rows, path)
    return b.spark.read.text(path)


def stored_report(b: Book) -> DataFrame:
    """The nested evaluation report of the stand-in predictions, as read back from its JSON file."""
    predictions = b.predictions.withColumns(
        {
            "golden_expected_handling": F.col("golden_handling"),
            "golden_expected_response_behavior": F.col("golden_behavior"),
            "majority_intent_baseline": F.lit(V.INTENTS[6]),
        }
    )
    report = evaluation.evaluation_report(predictions)
    path = b.path("evaluation_report")
    sinks.write_report(report, path)
    return b.spark.read.schema(report.schema).json(path)


@query(
    "A7",
    lambda: compose(
        "SELECT label, count(*) FILTER (predicted_intent = golden_intent AND predicted_intent = label) AS hits, "
        f"count(*) FILTER (golden_intent = label) AS support FROM pred JOIN (SELECT unnest([{listed(V.INTENT_LABELS)}]) AS label) ON TRUE GROUP BY label"
    ),
)
def report_sink_round_trip(b: Book) -> DataFrame:
    """Nested evaluation report written as JSON and read back."""
    item = F.col("item")
    return stored_report(b).select(F.explode("per_class").alias("item")).select(
        item["label"].alias("label"),
        F.round(item["recall"] * item["support"]).cast("long").alias("hits"),
        item["support"].alias("support"),
    )


@query("A8", lambda: compose("SELECT tweet_id, root, response_type FROM corpus"))
def build_or_load_corpus(b: Book) -> DataFrame:
    path = b.path("stored_corpus")
    sinks.build_or_load(b.spark, path, lambda: b.corpus)
    return sinks.build_or_load(b.spark, path, lambda: b.corpus.limit(0)).select("tweet_id", "root", "response_type")


@query("A9, J1, J3")
def model_round_trip(b: Book) -> DataFrame:
    training = b.openings.withColumnRenamed("text", "message").join(classifier.drop_unclear(b.silver), "tweet_id")
    model = classifier.train_classifier(training, "message", "intent", max_iter=50)
    path = b.path("model")
    classifier.save_model(model, path)
    return classifier.predict(training.select("tweet_id", "message", "intent"), classifier.load_model(path))


@query("B1", lambda: compose("SELECT tweet_id, TRY_CAST(tweet_id AS BIGINT) AS id FROM raw"))
def numeric_ids(b: Book) -> DataFrame:
    return b.raw.select("tweet_id", source.numeric_id(F.col("tweet_id")).alias("id"))


@query(
    "B2",
    lambda: compose(
        "SELECT tweet_id, in_response_to_tweet_id, TRY_CAST(in_response_to_tweet_id AS BIGINT) AS parent_id FROM raw"
    ),
)
def nullable_parents(b: Book) -> DataFrame:
    parent = source.numeric_id(F.col("in_response_to_tweet_id"))
    return b.raw.select("tweet_id", "in_response_to_tweet_id", parent.alias("parent_id"))


@query("B3", lambda: compose("SELECT tweet_id, author_id FROM m WHERE is_customer"))
def customer_messages(b: Book) -> DataFrame:
    return b.messages.filter("is_customer").select("tweet_id", "author_id")


@query("B3", lambda: compose("SELECT tweet_id, author_id FROM m WHERE is_support"))
def support_messages(b: Book) -> DataFrame:
    return b.messages.filter("is_support").select("tweet_id", "author_id")


@query(
    "B4",
    lambda: compose(
        "SELECT tweet_id, CASE WHEN is_support THEN 'SUPPORT' ELSE 'customer' END AS print_role, "
        "CASE WHEN is_support THEN 'BRAND' ELSE 'CUSTOMER' END AS context_role FROM m"
    ),
)
def role_labels(b: Book) -> DataFrame:
    support = F.col("is_support")
    return b.messages.select(
        "tweet_id",
        source.role_label(support).alias("print_role"),
        source.role_label(support, "BRAND", "CUSTOMER").alias("context_role"),
    )


@query("B5", lambda: compose("SELECT tweet_id, replace(text, chr(10), ' ') AS flat FROM m"))
def flattened_texts(b: Book) -> DataFrame:
    return b.messages.select("tweet_id", flatten_lines(F.col("text")).alias("flat"))


@query(
    "B6",
    lambda: compose(
        f"SELECT tweet_id, {cut('text', 200)} AS w200, {cut('text', 220)} AS w220, {cut('text', 300)} AS w300 FROM m"
    ),
)
def truncated_texts(b: Book) -> DataFrame:
    return b.messages.select("tweet_id", *[truncated(F.col("text"), n).alias(f"w{n}") for n in (200, 220, 300)])


@query(
    "B7",
    lambda: compose("SELECT tweet_id, created_at, CAST(epoch_us(ts) AS BIGINT) AS micros FROM m"),
)
def parsed_times(b: Book) -> DataFrame:
    return b.messages.select("tweet_id", "created_at", F.unix_micros("ts").alias("micros"))


@query(
    "B8",
    lambda: compose(
        f"SELECT root, size, n_customer, n_support FROM st WHERE brand = '{BRAND}' AND n_customer > 0 AND n_support > 0"
    ),
)
def qualifying_threads(b: Book) -> DataFrame:
    from threadwright.operators.threads import qualifying_threads as qualify

    return qualify(b.stats, BRAND).select("root", "size", "n_customer", "n_support")


@query("B9", lambda: compose("SELECT root, size FROM st WHERE size BETWEEN 3 AND 5"))
def threads_of_middle_size(b: Book) -> DataFrame:
    return b.stats.filter(F.col("size").between(3, 5)).select("root", "size")


@query(
    "B10",
    lambda: compose(
        f"SELECT tweet_id, starts_with(lower({sql_strip('text')}), '@brand0') AS opens_with_handle FROM m WHERE is_customer"
    ),
)
def handle_prefixes(b: Book) -> DataFrame:
    opens = F.startswith(F.lower(strip(F.col("text"))), F.lit("@brand0"))
    return b.messages.filter("is_customer").select("tweet_id", opens.alias("opens_with_handle"))


@query(
    "B11",
    lambda: compose(
        "SELECT tweet_id, contains(response_tweet_id, ',') AS many, len(string_split(response_tweet_id, ',')) AS n_children "
        "FROM raw WHERE response_tweet_id IS NOT NULL"
    ),
)
def child_pointers(b: Book) -> DataFrame:
    pointer = F.col("response_tweet_id")
    return b.raw.filter(pointer.isNotNull()).select(
        "tweet_id",
        source.has_many_children(pointer).alias("many"),
        F.size(source.child_ids(pointer)).cast("long").alias("n_children"),
    )


@query(
    "B12",
    lambda: compose(
        "SELECT tweet_id, conversation_context, '' AS intent, '' AS expected_response_behavior, '' AS expected_handling, "
        "'' AS labeling_notes FROM sheet"
    ),
)
def blank_golden_sheet(b: Book) -> DataFrame:
    from threadwright.operators.context import labeling_rows

    sheet = labeling_rows(b.rows).select("tweet_id", "conversation_context")
    return label_source.add_blank_columns(
        sheet, "intent", "expected_response_behavior", "expected_handling", "labeling_notes"
    )


@query("B13", lambda: compose(f"SELECT tweet_id, intent FROM golden WHERE intent IN ({listed(V.INTENTS)})"))
def rows_in_vocabulary(b: Book) -> DataFrame:
    return b.golden_sheet.filter(F.col("intent").isin(*V.INTENTS)).select("tweet_id", "intent")


@query("B13", lambda: compose(f"SELECT tweet_id, intent FROM golden WHERE intent NOT IN ({listed(V.INTENTS)})"))
def rows_outside_vocabulary(b: Book) -> DataFrame:
    return b.golden_sheet.filter(~F.col("intent").isin(*V.INTENTS)).select("tweet_id", "intent")


@query("B14", lambda: compose("SELECT tweet_id, intent FROM silver WHERE intent <> 'UNCLEAR'"))
def rows_without_unclear(b: Book) -> DataFrame:
    return classifier.drop_unclear(b.silver).select("tweet_id", "intent")


@query(
    "B14",
    lambda: compose(
        "SELECT count(*) FILTER (intent <> 'UNCLEAR') AS n_kept, count(*) FILTER (intent = 'UNCLEAR') AS n_excluded FROM silver"
    ),
)
def excluded_unclear_rows(b: Book) -> DataFrame:
    return classifier.count_unclear(b.silver)


@query(
    "B15",
    lambda: compose(
        "SELECT tweet_id FROM golden WHERE trim(intent) <> '' AND trim(expected_response_behavior) <> '' AND trim(expected_handling) <> ''"
    ),
)
def decided_rows(b: Book) -> DataFrame:
    rows = labels.filled_rows(b.golden_sheet, "intent", "expected_response_behavior", "expected_handling")
    return rows.select("tweet_id")


@query("B15", lambda: compose(f"SELECT tweet_id FROM m WHERE {sql_strip('coalesce(text, chr(32))')} = ''"))
def blank_messages(b: Book) -> DataFrame:
    return b.messages.filter(~is_filled(F.col("text"))).select("tweet_id")


@query("B16", lambda: compose("SELECT tweet_id FROM pred WHERE NOT (intent_correct AND handling_correct)"))
def disagreeing_rows(b: Book) -> DataFrame:
    from threadwright.operators.metrics import failures

    return failures(b.predictions, "tweet_id", "intent_correct", "handling_correct").select("tweet_id")



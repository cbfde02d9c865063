"""Whole-plan queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadwright.functions import vocab as V
from threadwright.plans import evaluation, reports, scoring
from threadwright.streaming import routing

from .metrics import class_sql, summary_sql
from .oracle import compose, listed, mapped, ranked, strip, tfidf, weak
from .registry import query
from .retrieval import CORPUS_DOCS, DRAFT, EVIDENCE, HANDLING, decision_sql
from .sources import stored_report
from .tables import Book
from .threads import BRAND_COUNTS, EXAMPLES, PERCENTS, SIGNAL, TOP, TRANSCRIPTS, rounded, sql_rounded


def incoming(b: Book) -> DataFrame:
    return b.openings.select(F.col("tweet_id").alias("message_id"), F.col("text").alias("message"))


@query(
    "K1",
    lambda: compose(
        f"SELECT top.query_id AS message_id, qs.intent AS predicted_intent, {DRAFT} AS draft_reply FROM top JOIN qs ON qs.id = top.query_id",
        EVIDENCE,
    ),
)
def scored_messages(b: Book) -> DataFrame:
    return scoring.score_messages(incoming(b), b.index, b.corpus).select("message_id", "predicted_intent", "draft_reply")


ROUTED = (
    f"SELECT message_id, {HANDLING} AS predicted_handling, code AS reason_code, round(similarity, 6) AS top_similarity, "
    + mapped("response_type", V.BEHAVIOR_OF_RESPONSE_TYPE, "'unclear'")
    + f" AS predicted_response_behavior FROM (SELECT query_id AS message_id, similarity, response_type, {decision_sql('NULL::DOUBLE')} AS code FROM "
    "(SELECT top.query_id, top.similarity, top.response_type, qs.text, qs.intent FROM top JOIN qs ON qs.id = top.query_id))"
)


def routed_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "message_id",
        "predicted_handling",
        "reason_code",
        F.round("top_similarity", 6).alias("top_similarity"),
        "predicted_response_behavior",
    )


@query("K2", lambda: compose(ROUTED, EVIDENCE))
def routed_messages(b: Book) -> DataFrame:
    return routed_columns(scoring.route_messages(scoring.score_messages(incoming(b), b.index, b.corpus)))


@query("S1", lambda: compose(ROUTED, EVIDENCE))
def routed_stream(b: Book) -> DataFrame:
    """The same messages as a file feed, drained by the streaming router."""
    feed, out, checkpoint = b.path("feed"), b.path("routed"), b.path("checkpoint")
    incoming(b).repartition(2).write.parquet(feed)
    stream = routing.read_feed(b.spark, feed, files_per_batch=1)
    routing.route_stream(stream, b.index, b.corpus, out, checkpoint).awaitTermination()
    return routed_columns(routing.routed_table(b.spark, out))


GOLD = {
    **CORPUS_DOCS,
    "gold": (
        "SELECT tweet_id AS id, text, " + weak("text", 0) + " AS intent, golden_intent, golden_handling, golden_behavior FROM ("
        f"SELECT s.tweet_id, {strip('coalesce(substr(line, 10), conversation_context)')} AS text, p.predicted_intent AS golden_intent, p.golden_handling, p.golden_behavior "
        "FROM (SELECT tweet_id, conversation_context, ([x for x in string_split(conversation_context, chr(10)) if starts_with(x, 'CUSTOMER:')])[1] AS line FROM sheet) s "
        "JOIN pred p USING (tweet_id))"
    ),
    **tfidf("r", "docs", queries="gold"),
    **ranked("r", "docs", "gold", 1, own=True),
    "routed": (
        f"SELECT tweet_id, golden_intent, predicted_intent, golden_handling, {HANDLING} AS predicted_handling, code AS reason_code, golden_behavior, behavior, similarity FROM ("
        f"SELECT g.id AS tweet_id, g.golden_intent, g.intent AS predicted_intent, g.golden_handling, g.golden_behavior, h.similarity, "
        + mapped("c.response_type", V.BEHAVIOR_OF_RESPONSE_TYPE, "'unclear'")
        + f" AS behavior, {decision_sql('NULL::DOUBLE', 'g.text', 'g.intent').replace('similarity', 'h.similarity').replace('weak_h.similarity', 'weak_similarity').replace('response_type', 'c.response_type')} AS code "
        "FROM gold g JOIN r_hits h ON h.query_id = g.id JOIN corpus c ON c.tweet_id = h.doc_id)"
    ),
    "maj": "SELECT intent FROM silver WHERE intent <> 'UNCLEAR' GROUP BY intent ORDER BY count(*) DESC, intent LIMIT 1",
    "pm": "SELECT *, (SELECT intent FROM maj) AS majority, 'ESCALATE' AS always FROM routed",
    "labs": f"SELECT unnest([{listed(V.INTENT_LABELS)}]) AS label",
    "cls": class_sql("golden_intent", "predicted_intent", "labs", "pm"),
    "cls2": class_sql("golden_intent", "majority", "labs", "pm"),
}


def golden_predictions_of(b: Book) -> DataFrame:
    return evaluation.golden_predictions(b.golden_contexts, b.index, b.corpus, b.silver)


@query(
    "K3, I11, C10",
    lambda: compose(
        "SELECT tweet_id, predicted_intent, predicted_handling, reason_code, behavior AS predicted_response_behavior, "
        "golden_intent = predicted_intent AS intent_correct, golden_handling = predicted_handling AS handling_correct, "
        "behavior = golden_behavior AS behavior_correct, round(similarity, 6) AS top_similarity, (SELECT intent FROM maj) AS majority_intent_baseline FROM routed",
        GOLD,
    ),
)
def golden_predictions(b: Book) -> DataFrame:
    return golden_predictions_of(b).select(
        "tweet_id",
        "predicted_intent",
        "predicted_handling",
        "reason_code",
        "predicted_response_behavior",
        "intent_correct",
        "handling_correct",
        "behavior_correct",
        F.round("top_similarity", 6).alias("top_similarity"),
        "majority_intent_baseline",
    )


def _binary(prediction: str, system: str) -> str:
    tp = f"count(*) FILTER ({prediction} = 'AUTO-HANDLE' AND golden_handling = 'AUTO-HANDLE')::DOUBLE"
    said = f"count(*) FILTER ({prediction} = 'AUTO-HANDLE')"
    real = "count(*) FILTER (golden_handling = 'AUTO-HANDLE')"
    metrics = {
        "accuracy": f"avg(CAST({prediction} = golden_handling AS INT))",
        "precision": f"coalesce({tp} / nullif({said}, 0), 0)",
        "recall": f"coalesce({tp} / nullif({real}, 0), 0)",
        "f1": f"coalesce(2 * {tp} / nullif({said} + {real}, 0), 0)",
    }
    return " UNION ALL ".join(
        f"SELECT 'handling' AS part, '{system}' AS system, '{m}' AS metric, round(CAST({e} AS DOUBLE), 6) AS value FROM pm"
        for m, e in metrics.items()
    )


def _intent(prediction: str, system: str, cls: str) -> str:
    inner = summary_sql("golden_intent", prediction, "pm").replace("FROM cls", f"FROM {cls}")
    return " UNION ALL ".join(
        f"SELECT 'intent' AS part, '{system}' AS system, '{m}' AS metric, round({m}, 6) AS value FROM ({inner})"
        for m in ("accuracy", "macro_f1", "weighted_f1")
    )


SUMMARY = " UNION ALL ".join(
    [
        _intent("predicted_intent", "system", "cls"),
        _intent("majority", "majority", "cls2"),
        _binary("predicted_handling", "system"),
        _binary("always", "always_escalate"),
        "SELECT 'response_behavior', 'system', 'accuracy', round(avg(CAST(behavior = golden_behavior AS INT)), 6) FROM pm",
    ]
)


@query("K3, D24", lambda: compose(SUMMARY, GOLD))
def evaluation_summary(b: Book) -> DataFrame:
    from threadwright.sources.staging import stage

    predictions = stage(golden_predictions_of(b), "golden_predictions")
    return evaluation.evaluation_summary(predictions).withColumn("value", F.round("value", 6))


PM = {
    "labs": f"SELECT unnest([{listed(V.INTENT_LABELS)}]) AS label",
    "pm": f"SELECT *, '{V.INTENTS[6]}' AS majority, 'ESCALATE' AS always, predicted_response_behavior AS behavior FROM pred",
    "cls": class_sql("golden_intent", "predicted_intent", "labs", "pm"),
    "cls2": class_sql("golden_intent", "majority", "labs", "pm"),
}


@query("A7, K3", lambda: compose(SUMMARY, PM))
def report_sink_summary(b: Book) -> DataFrame:
    summary = stored_report(b).select(F.inline("summary"))
    return summary.select("part", "system", "metric", F.round("value", 6).alias("value"))


@query(
    "A7, D21",
    lambda: compose("SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM cls", PM),
)
def report_sink_classes(b: Book) -> DataFrame:
    classes = stored_report(b).select(F.inline("per_class"))
    return rounded(classes.select("label", "precision", "recall", "f1", "support"), "precision", "recall", "f1")


def cells_sql(kind: str, truth: str, prediction: str, labels: str) -> str:
    grid_sql = f"SELECT a.label AS truth, b.label AS prediction FROM {labels} a, {labels} b"
    return (
        f"SELECT '{kind}' AS kind, g.truth, g.prediction, count(p.tweet_id) AS n FROM ({grid_sql}) g "
        f"LEFT JOIN pred p ON p.{truth} = g.truth AND p.{prediction} = g.prediction GROUP BY ALL"
    )


@query(
    "A7, D20",
    lambda: compose(
        cells_sql("intent", "golden_intent", "predicted_intent", "labs")
        + " UNION ALL "
        + cells_sql("handling", "golden_handling", "predicted_handling", "hands"),
        {**PM, "hands": f"SELECT unnest([{listed(V.HANDLINGS)}]) AS label"},
    ),
)
def report_sink_cells(b: Book) -> DataFrame:
    """Both confusion matrices of the stored report."""
    report = stored_report(b)
    parts = [
        report.select(F.inline(f"{kind}_confusion")).select(F.lit(kind).alias("kind"), "truth", "prediction", "n")
        for kind in ("intent", "handling")
    ]
    return parts[0].unionByName(parts[1])


@query(
    "A7, E6",
    lambda: compose(
        "SELECT tweet_id, golden_intent, predicted_intent, golden_handling, predicted_handling FROM pred "
        "WHERE NOT (intent_correct AND handling_correct) ORDER BY tweet_id LIMIT 10"
    ),
)
def report_sink_failures(b: Book) -> DataFrame:
    failures = stored_report(b).select(F.inline("failure_examples"))
    return failures.select("tweet_id", "golden_intent", "predicted_intent", "golden_handling", "predicted_handling")


LEADING = "brand IN (SELECT brand FROM bm ORDER BY resolution_pairs DESC, brand LIMIT 7)"
FIRST_EXAMPLES = f"SELECT brand, root, size FROM ({EXAMPLES.replace('k <= 2', 'k <= 1')}) WHERE {LEADING}"


@query("K6, F2", lambda: compose(TOP))
def brand_report_top(b: Book) -> DataFrame:
    return rounded(reports.brand_report(b.threads).top, "pct_3plus", "dangling_pct")


@query("K6, H9", lambda: compose(FIRST_EXAMPLES))
def brand_report_examples(b: Book) -> DataFrame:
    return reports.brand_report(b.threads).examples.select("brand", "root", "size")


@query("K6, D12", lambda: compose(f"SELECT * FROM ({SIGNAL}) WHERE {LEADING}"))
def brand_report_handles(b: Book) -> DataFrame:
    return rounded(reports.brand_report(b.threads).handle_signal, "handle_pct")


@query("K6, E5", lambda: compose(TRANSCRIPTS + f" WHERE t.root IN (SELECT root FROM ({FIRST_EXAMPLES}))"))
def brand_report_lines(b: Book) -> DataFrame:
    return reports.brand_report(b.threads).transcripts.select("root", "tweet_id", "line")


@query("K6", lambda: compose(f"SELECT {sql_rounded(PERCENTS, BRAND_COUNTS)} FROM bm"))
def brand_report(b: Book) -> DataFrame:
    return rounded(reports.brand_report(b.threads).metrics, *PERCENTS)


@query(
    "K6, E5, H9",
    lambda: compose(
        "SELECT root, tweet_id FROM t WHERE root IN (SELECT root FROM (SELECT brand, root, inside, max(inside) OVER (PARTITION BY brand) AS best, "
        "row_number() OVER (PARTITION BY brand ORDER BY inside DESC, root) AS k FROM (SELECT p.brand, p.root, CAST(st.size BETWEEN 3 AND 5 AS INT) AS inside "
        "FROM (SELECT DISTINCT author_id AS brand, root FROM t WHERE is_support) p JOIN st USING (root))) WHERE k <= 1 AND inside = best "
        "AND brand IN (SELECT brand FROM (SELECT brand FROM bm ORDER BY resolution_pairs DESC, brand LIMIT 7)))"
    ),
)
def brand_report_transcripts(b: Book) -> DataFrame:
    return reports.brand_report(b.threads).transcripts.select("root", "tweet_id")

"""Evaluation of routed messages against a golden sheet, and the reply-quality report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import first_customer_message
from ..functions.vocab import HANDLINGS, INTENT_LABELS, JUDGE_DIMENSIONS
from ..operators import judge, metrics
from ..operators.classifier import drop_unclear, majority_label
from ..operators.retrieval import Index
from ..sources.staging import stage
from .scoring import Classify, route_messages, rule_classifier, score_messages


def golden_predictions(
    golden: DataFrame,
    index: Index,
    corpus: DataFrame,
    training: DataFrame,
    classify: Classify = rule_classifier,
    exclude_self: bool = True,
) -> DataFrame:
    """Golden rows run through the whole plan, with correctness flags and both baselines.

    A golden thread is usually in the corpus too; ``exclude_self`` keeps it from finding itself.
    """
    messages = golden.select(
        F.col("tweet_id").alias("message_id"),
        first_customer_message(F.col("conversation_context")).alias("message"),
        F.col("intent").alias("golden_intent"),
        F.col("expected_handling").alias("golden_expected_handling"),
        F.col("expected_response_behavior").alias("golden_expected_response_behavior"),
        F.col("tweet_id").alias("own_doc"),
    )
    scored = score_messages(
        messages, index, corpus, classify, own_doc_col="own_doc" if exclude_self else None
    )
    majority = majority_label(drop_unclear(training)).select("label").scalar()
    routed = route_messages(scored).withColumn("majority_intent_baseline", majority)
    return routed.select(
        F.col("message_id").alias("tweet_id"),
        F.col("message").alias("customer_message"),
        "golden_intent",
        "predicted_intent",
        (F.col("predicted_intent") == F.col("golden_intent")).alias("intent_correct"),
        "golden_expected_handling",
        "predicted_handling",
        (F.col("predicted_handling") == F.col("golden_expected_handling")).alias("handling_correct"),
        "handling_reason",
        "reason_code",
        "golden_expected_response_behavior",
        "predicted_response_behavior",
        (F.col("predicted_response_behavior") == F.col("golden_expected_response_behavior")).alias("behavior_correct"),
        "draft_reply",
        "top_similarity",
        "majority_intent_baseline",
        (F.col("majority_intent_baseline") == F.col("golden_intent")).alias("majority_intent_baseline_correct"),
        (F.col("golden_expected_handling") == "ESCALATE").alias("always_escalate_baseline_correct"),
    )


def evaluation_summary(predictions: DataFrame) -> DataFrame:
    """(part, system, metric, value) rows for system and constant baselines.

    Pass a stored table: every metric is an aggregate of its own.
    """
    with_escalate = metrics.constant_baseline(predictions, "ESCALATE", "always_escalate")
    parts = []
    for system, column in (("system", "predicted_intent"), ("majority", "majority_intent_baseline")):
        row = metrics.summary_metrics(predictions, "golden_intent", column, INTENT_LABELS)
        parts.append(_long(row, "intent", system))
    for system, column in (("system", "predicted_handling"), ("always_escalate", "always_escalate")):
        row = metrics.binary_metrics(with_escalate, "golden_expected_handling", column, "AUTO-HANDLE")
        parts.append(_long(row, "handling", system))
    behavior = metrics.accuracy(predictions, "golden_expected_response_behavior", "predicted_response_behavior")
    parts.append(_long(behavior, "response_behavior", "system"))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def _long(row: DataFrame, part: str, system: str) -> DataFrame:
    pairs = ", ".join(f"'{c}', `{c}`" for c in row.columns)
    long = row.selectExpr(f"stack({len(row.columns)}, {pairs}) AS (metric, value)")
    return long.select(F.lit(part).alias("part"), F.lit(system).alias("system"), "metric", "value")


def evaluation_report(predictions: DataFrame, n_failures: int = 10) -> DataFrame:
    """One nested row for the JSON sink; every array is bounded by a vocabulary or ``n_failures``.

    The predictions feed several aggregates, so they are stored once first.
    """
    predictions = stage(predictions, "predictions")

    def rows(df: DataFrame, name: str, *order: str) -> DataFrame:
        item = F.struct(*[F.col(c) for c in (*order, *[c for c in df.columns if c not in order])])
        return df.agg(F.array_sort(F.collect_list(item)).alias(name))

    summary = rows(evaluation_summary(predictions), "summary", "part", "system", "metric")
    classes = rows(
        metrics.per_class_metrics(predictions, "golden_intent", "predicted_intent", INTENT_LABELS), "c", "label"
    )
    intent_cells = rows(
        metrics.confusion_matrix(predictions, "golden_intent", "predicted_intent", INTENT_LABELS),
        "c",
        "truth_index",
        "prediction_index",
    )
    handling_cells = rows(
        metrics.confusion_matrix(predictions, "golden_expected_handling", "predicted_handling", HANDLINGS),
        "c",
        "truth_index",
        "prediction_index",
    )
    wrong = metrics.failures(predictions, "tweet_id", "intent_correct", "handling_correct")
    examples = rows(metrics.first_rows(wrong, n_failures, "tweet_id"), "c", "tweet_id")
    return summary.select(
        "summary",
        classes.scalar().alias("per_class"),
        intent_cells.scalar().alias("intent_confusion"),
        handling_cells.scalar().alias("handling_confusion"),
        examples.scalar().alias("failure_examples"),
    )


def judge_report(predictions: DataFrame, scores: DataFrame) -> DataFrame:
    """(section, item, metric, value): averages, averages by group, low-quartile counts."""
    scored = judge.join_scores(predictions, scores)
    columns = [*JUDGE_DIMENSIONS, "overall"]
    stack = ", ".join(f"'{c}', `{c}`" for c in columns)
    unpivot = f"stack({len(columns)}, {stack}) AS (metric, value)"
    report = judge.average_scores(scored).selectExpr("'average' AS section", "'all' AS item", unpivot)
    for by in ("predicted_response_behavior", "predicted_handling"):
        part = judge.average_scores_by(scored, by).selectExpr(f"'{by}' AS section", f"{by} AS item", unpivot)
        report = report.unionByName(part)
    low = judge.low_quartile_distribution(scored).selectExpr(
        "'low_quartile' AS section",
        "predicted_response_behavior AS item",
        "'rows' AS metric",
        "CAST(n AS DOUBLE) AS value",
    )
    worst = judge.weakest_dimension(scored).selectExpr(
        "'weakest' AS section", "dimension AS item", "'average' AS metric", "average AS value"
    )
    return report.unionByName(low).unionByName(worst)

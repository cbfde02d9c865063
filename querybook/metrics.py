"""Classification metric queries on the stand-in predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadwright.functions import vocab as V
from threadwright.operators import classifier, metrics

from .oracle import compose, listed
from .registry import query
from .tables import Book

GRID = (
    f"SELECT a.i - 1 AS truth_index, a.l AS truth, b.i - 1 AS prediction_index, b.l AS prediction FROM "
    "(SELECT unnest({labels}) AS l, unnest(range(1, {n} + 1)) AS i) a CROSS JOIN (SELECT unnest({labels}) AS l, unnest(range(1, {n} + 1)) AS i) b"
)


def grid(labels: list[str]) -> str:
    return GRID.format(labels=f"[{listed(labels)}]", n=len(labels))


def class_sql(truth: str, prediction: str, labels: str, source: str = "pred") -> str:
    """Per-class scores over the relation ``labels(label)``."""
    return (
        "SELECT label, precision, recall, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1, support FROM ("
        "SELECT label, CASE WHEN said > 0 THEN tp / said::DOUBLE ELSE 0.0 END AS precision, CASE WHEN support > 0 THEN tp / support::DOUBLE ELSE 0.0 END AS recall, support FROM ("
        f"SELECT l.label, count(*) FILTER (p.{truth} = l.label AND p.{prediction} = l.label) AS tp, count(*) FILTER (p.{prediction} = l.label) AS said, "
        f"count(*) FILTER (p.{truth} = l.label) AS support FROM {source} p JOIN {labels} l ON TRUE GROUP BY l.label))"
    )


FIXED = {"labs": f"SELECT unnest([{listed(V.INTENT_LABELS)}]) AS label"}
OBSERVED = {"labs": "SELECT golden_intent AS label FROM pred UNION SELECT predicted_intent FROM pred"}


def summary_sql(truth: str, prediction: str, source: str = "pred") -> str:
    return (
        f"SELECT (SELECT avg(CAST({truth} = {prediction} AS INT)) FROM {source}) AS accuracy, avg(f1) AS macro_f1, "
        "sum(f1 * support) / sum(support) AS weighted_f1 FROM cls"
    )


def rounded_summary(inner: str) -> str:
    return (
        "SELECT round(accuracy, 6) AS accuracy, round(macro_f1, 6) AS macro_f1, round(weighted_f1, 6) AS weighted_f1 "
        f"FROM ({inner})"
    )


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query(
    "D20",
    lambda: compose(
        "SELECT g.truth_index, g.truth, g.prediction_index, g.prediction, count(p.tweet_id) AS n FROM grid g "
        "LEFT JOIN pred p ON p.golden_intent = g.truth AND p.predicted_intent = g.prediction GROUP BY ALL",
        {"grid": grid(V.INTENT_LABELS)},
    ),
)
def intent_confusion_matrix(b: Book) -> DataFrame:
    return metrics.confusion_matrix(b.predictions, "golden_intent", "predicted_intent", V.INTENT_LABELS)


@query(
    "D20",
    lambda: compose(
        "SELECT g.truth_index, g.truth, g.prediction_index, g.prediction, count(p.tweet_id) AS n FROM grid g "
        "LEFT JOIN pred p ON p.golden_handling = g.truth AND p.predicted_handling = g.prediction GROUP BY ALL",
        {"grid": grid(V.HANDLINGS)},
    ),
)
def handling_confusion_matrix(b: Book) -> DataFrame:
    return metrics.confusion_matrix(b.predictions, "golden_handling", "predicted_handling", V.HANDLINGS)


@query(
    "D21",
    lambda: compose(
        "SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM cls",
        {**FIXED, "cls": class_sql("golden_intent", "predicted_intent", "labs")},
    ),
)
def per_class_metrics(b: Book) -> DataFrame:
    table = metrics.per_class_metrics(b.predictions, "golden_intent", "predicted_intent", V.INTENT_LABELS)
    return rounded(table, "precision", "recall", "f1")


@query(
    "D22",
    lambda: compose(
        rounded_summary(summary_sql("golden_intent", "predicted_intent")),
        {**FIXED, "cls": class_sql("golden_intent", "predicted_intent", "labs")},
    ),
)
def intent_metrics(b: Book) -> DataFrame:
    table = metrics.summary_metrics(b.predictions, "golden_intent", "predicted_intent", V.INTENT_LABELS)
    return rounded(table, "accuracy", "macro_f1", "weighted_f1")


@query(
    "D22",
    lambda: compose(
        rounded_summary(summary_sql("golden_intent", "predicted_intent")),
        {**OBSERVED, "cls": class_sql("golden_intent", "predicted_intent", "labs")},
    ),
)
def intent_metrics_observed_labels(b: Book) -> DataFrame:
    table = metrics.summary_metrics(b.predictions, "golden_intent", "predicted_intent")
    return rounded(table, "accuracy", "macro_f1", "weighted_f1")


def binary_sql(prediction: str) -> str:
    return (
        "SELECT round(accuracy, 6) AS accuracy, round(p, 6) AS precision, round(r, 6) AS recall, "
        "round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END, 6) AS f1 FROM (SELECT accuracy, "
        "CASE WHEN said > 0 THEN tp / said::DOUBLE ELSE 0.0 END AS p, CASE WHEN real > 0 THEN tp / real::DOUBLE ELSE 0.0 END AS r FROM ("
        f"SELECT avg(CAST({prediction} = golden_handling AS INT)) AS accuracy, count(*) FILTER ({prediction} = 'AUTO-HANDLE' AND golden_handling = 'AUTO-HANDLE') AS tp, "
        f"count(*) FILTER ({prediction} = 'AUTO-HANDLE') AS said, count(*) FILTER (golden_handling = 'AUTO-HANDLE') AS real FROM pred))"
    )


@query("D23", lambda: compose(binary_sql("predicted_handling")))
def handling_metrics(b: Book) -> DataFrame:
    table = metrics.binary_metrics(b.predictions, "golden_handling", "predicted_handling", "AUTO-HANDLE")
    return rounded(table, "accuracy", "precision", "recall", "f1")


@query(
    "D23",
    "SELECT round(avg(CAST(quality = toxic AS INT)), 6) AS accuracy, "
    "round(count(*) FILTER (quality = 1 AND toxic = 1) / greatest(count(*) FILTER (toxic = 1), 1)::DOUBLE, 6) AS precision, "
    "round(count(*) FILTER (quality = 1 AND toxic = 1) / greatest(count(*) FILTER (quality = 1), 1)::DOUBLE, 6) AS recall FROM labels",
)
def label_pair_metrics(b: Book) -> DataFrame:
    pairs = b.table("labels").select(
        F.col("quality").cast("string").alias("quality"), F.col("toxic").cast("string").alias("toxic")
    )
    return rounded(
        metrics.binary_metrics(pairs, "quality", "toxic", "1").drop("f1"), "accuracy", "precision", "recall"
    )


@query("D24", lambda: compose(binary_sql("'ESCALATE'")))
def always_escalate_baseline(b: Book) -> DataFrame:
    rows = metrics.constant_baseline(b.predictions, "ESCALATE")
    table = metrics.binary_metrics(rows, "golden_handling", "baseline", "AUTO-HANDLE")
    return rounded(table, "accuracy", "precision", "recall", "f1")


MAJORITY = {
    "maj": "SELECT intent FROM silver WHERE intent <> 'UNCLEAR' GROUP BY intent ORDER BY count(*) DESC, intent LIMIT 1",
    "based": "SELECT tweet_id, golden_intent, (SELECT intent FROM maj) AS baseline FROM pred",
}


@query(
    "D19, J4",
    lambda: compose(
        "SELECT intent AS label, count(*) AS n FROM silver WHERE intent <> 'UNCLEAR' GROUP BY intent ORDER BY n DESC, intent LIMIT 1"
    ),
)
def majority_intent(b: Book) -> DataFrame:
    return classifier.majority_label(classifier.drop_unclear(b.silver))


@query(
    "D24, J4",
    lambda: compose(
        rounded_summary(summary_sql("golden_intent", "baseline", "based")),
        {**FIXED, **MAJORITY, "cls": class_sql("golden_intent", "baseline", "labs", "based")},
    ),
)
def majority_baseline(b: Book) -> DataFrame:
    majority = classifier.majority_label(classifier.drop_unclear(b.silver)).select("label").scalar()
    rows = b.predictions.withColumn("baseline", majority)
    table = metrics.summary_metrics(rows, "golden_intent", "baseline", V.INTENT_LABELS)
    return rounded(table, "accuracy", "macro_f1", "weighted_f1")


@query("D25", lambda: compose("SELECT round(avg(CAST(behavior_correct AS INT)), 6) AS accuracy FROM pred"))
def behavior_accuracy(b: Book) -> DataFrame:
    return rounded(
        metrics.accuracy(b.predictions, "golden_behavior", "predicted_response_behavior"), "accuracy"
    )


@query(
    "E6",
    lambda: compose(
        "SELECT tweet_id, golden_intent, predicted_intent FROM pred WHERE NOT (intent_correct AND handling_correct) ORDER BY tweet_id LIMIT 10"
    ),
)
def first_failures(b: Book) -> DataFrame:
    wrong = metrics.failures(b.predictions, "tweet_id", "intent_correct", "handling_correct")
    return metrics.first_rows(wrong, 10, "tweet_id").select("tweet_id", "golden_intent", "predicted_intent")


@query(
    "J2",
    lambda: compose(
        "SELECT tweet_id, intent, round(total / (k * n::DOUBLE), 6) AS weight FROM (SELECT tweet_id, intent, count(*) OVER (PARTITION BY intent) AS n, "
        "count(*) OVER () AS total, (SELECT count(DISTINCT intent) FROM silver) AS k FROM silver)"
    ),
)
def balanced_weights(b: Book) -> DataFrame:
    return rounded(classifier.balanced_weights(b.silver.select("tweet_id", "intent"), "intent"), "weight")


CUTOFFS = [0.0, 0.25, 0.4, 0.55, 0.9]


@query(
    "J5",
    lambda: compose(
        " UNION ALL ".join(
            f"SELECT CAST({c} AS DOUBLE) AS cutoff, count(*) FILTER (confidence >= {c}::DOUBLE) AS n_kept, "
            f"round(count(*) FILTER (confidence >= {c}::DOUBLE) / count(*)::DOUBLE, 6) AS coverage, "
            f"round(count(*) FILTER (confidence >= {c}::DOUBLE AND intent_correct) / nullif(count(*) FILTER (confidence >= {c}::DOUBLE), 0)::DOUBLE, 6) AS accuracy FROM pred"
            for c in CUTOFFS
        )
    ),
)
def confidence_calibration(b: Book) -> DataFrame:
    return rounded(classifier.calibration(b.predictions, CUTOFFS, "intent_correct"), "coverage", "accuracy")


@query("J1, J3")
def language_classifier(b: Book) -> DataFrame:
    """Language of each document predicted by a model trained on all of them."""
    docs = b.table("documents").select("doc_id", F.col("text").alias("message"), F.col("lang").alias("intent"))
    model = classifier.train_classifier(docs, "message", "intent", min_df=5, max_iter=20)
    return classifier.predict(docs, model).select("doc_id", "intent", "predicted_intent", "confidence")



def held_out_facts(predicted: DataFrame) -> DataFrame:
    """Per true label: held-out rows, those with a known label and a probability, and whether nine in ten are right."""
    known = predicted.select(F.col("intent").alias("predicted_intent")).distinct().withColumn("known", F.lit(True))
    right = F.col("predicted_intent") == F.col("intent")
    return predicted.join(known, "predicted_intent", "left").groupBy("intent").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("known") & F.col("confidence").between(0, 1)).alias("n_scored"),
        (F.count_if(right) >= 0.9 * F.count(F.lit(1))).alias("well_predicted"),
    )


@query(
    "J1, J3",
    "SELECT lang AS intent, count(*) AS n_rows, count(*) AS n_scored, TRUE AS well_predicted FROM documents WHERE doc_id % 4 = 2 GROUP BY lang",
)
def held_out_languages(b: Book) -> DataFrame:
    """Languages of a quarter of the documents by a model that did not see them."""
    docs = b.table("documents").select("doc_id", F.col("text").alias("message"), F.col("lang").alias("intent"))
    model = classifier.train_classifier(docs.filter("doc_id % 4 <> 2"), "message", "intent", min_df=5, max_iter=100)
    return held_out_facts(classifier.predict(docs.filter("doc_id % 4 = 2"), model))


@query(
    "A9, J1, J3",
    lambda: compose(
        "SELECT intent, count(*) AS n_rows, count(*) AS n_scored, TRUE AS well_predicted FROM silver "
        "WHERE intent <> 'UNCLEAR' AND tweet_id // 16 % 4 = 2 GROUP BY intent"
    ),
)
def held_out_intents(b: Book) -> DataFrame:
    """Intents of a quarter of the opening messages by a stored model that did not see them."""
    labelled = b.openings.withColumnRenamed("text", "message").join(classifier.drop_unclear(b.silver), "tweet_id")
    rows = labelled.select("tweet_id", "message", "intent")
    path = b.path("held_out_model")
    classifier.save_model(classifier.train_classifier(rows.filter("tweet_id div 16 % 4 <> 2"), "message", "intent", max_iter=100), path)
    return held_out_facts(classifier.predict(rows.filter("tweet_id div 16 % 4 = 2"), classifier.load_model(path)))

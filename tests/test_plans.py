from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from querybook import QUERIES
from threadwright.functions import vocab as V
from threadwright.operators import classifier
from threadwright.plans import evaluation, scoring
from threadwright.streaming import routing

from .conftest import SF_DIR

DEMO = [
    "My iPhone battery is draining really fast since I updated to iOS 11",
    "My WiFi keeps disconnecting and reconnecting on my iPhone",
    "I was charged twice for my Apple Music subscription, how do I get a refund",
]


@pytest.fixture(scope="module")
def demo(spark):
    return spark.createDataFrame(list(enumerate(DEMO)), routing.MESSAGE_SCHEMA)


def test_no_reply_is_empty(demo, tables):
    rows = scoring.score_messages(demo, tables.index, tables.corpus).orderBy("message_id").collect()
    for row in rows:
        assert row.mode == "mock" and row.draft_reply.strip() and row.predicted_intent
        assert len(row.evidence) == 5
        assert {e.response_type for e in row.evidence} <= set(V.RESPONSE_TYPES)
    assert [r.predicted_intent for r in rows][:2] == ["Battery & Performance", "Connectivity"]


def test_billing_always_goes_to_a_person(demo, tables):
    routed = scoring.route_messages(scoring.score_messages(demo, tables.index, tables.corpus))
    row = routed.filter("message_id = 2").first()
    assert (row.predicted_handling, row.reason_code) in [("ESCALATE", "sensitive_intent"), ("ESCALATE", "sensitive_keyword")]
    assert row.plain_reason in V.PLAIN_REASONS.values()


def test_provider_replaces_the_template(demo, tables):
    scored = scoring.score_messages(
        demo, tables.index, tables.corpus, provider=lambda prompts: prompts.str.len().astype(str), provider_name="length"
    )
    for row in scored.collect():
        assert row.mode == "real:length" and row.draft_reply == str(len(row.prompt))


def test_trained_model_in_the_plan(demo, tables):
    training = tables.openings.withColumnRenamed("text", "message").join(classifier.drop_unclear(tables.silver), "tweet_id")
    model = classifier.train_classifier(training, "message", "intent", max_iter=30)
    rows = scoring.score_messages(demo, tables.index, tables.corpus, scoring.model_classifier(model)).collect()
    assert all(0 < r.confidence <= 1 and r.predicted_intent in V.INTENTS for r in rows)


def test_stream_equals_batch_and_restarts(spark, demo, tables, tmp_path):
    feed, out, checkpoint = (str(tmp_path / n) for n in ("feed", "out", "cp"))
    demo.filter("message_id < 2").coalesce(1).write.parquet(feed)

    def drain():
        stream = routing.read_feed(spark, feed, 1)
        routing.route_stream(stream, tables.index, tables.corpus, out, checkpoint).awaitTermination()

    drain()
    demo.filter("message_id = 2").coalesce(1).write.mode("append").parquet(feed)
    drain()
    drain()
    columns = ["message_id", "predicted_intent", "draft_reply", "predicted_handling", "reason_code"]
    batch = scoring.route_messages(scoring.score_messages(demo, tables.index, tables.corpus)).select(columns)
    assert sorted(routing.routed_table(spark, out).select(columns).collect()) == sorted(batch.collect())


def test_leaving_the_own_thread_out_lowers_similarity(tables):
    args = (tables.golden_contexts, tables.index, tables.corpus, tables.silver)
    clean = evaluation.golden_predictions(*args).agg(F.avg("top_similarity")).first()[0]
    leaky = evaluation.golden_predictions(*args, exclude_self=False).agg(F.avg("top_similarity")).first()[0]
    assert clean <= leaky


def test_evaluation_report_is_nested_and_bounded(tables):
    predictions = evaluation.golden_predictions(tables.golden_contexts, tables.index, tables.corpus, tables.silver)
    row = evaluation.evaluation_report(predictions, 3).first()
    assert len(row.per_class) == 9 and len(row.intent_confusion) == 81 and len(row.handling_confusion) == 4
    assert len(row.failure_examples) <= 3 and {s.part for s in row.summary} == {"intent", "handling", "response_behavior"}


ONE_TASK_OR_ALL_PAIRS = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas")


@pytest.mark.parametrize(
    "name",
    ["thread_roots", "thread_stats", "brand_metrics", "handle_signal", "thread_context", "labeling_rows", "first_reply_after",
     "request_reply_corpus", "weak_labels", "keyword_frequency", "stratified_training_sample", "stratified_split", "sample_comparison",
     "similar_documents", "routed_messages", "per_class_metrics", "representative_rows", "low_quartile_rows", "applied_labels"],
)
def test_plans_have_no_pairs_and_no_python(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not [bad for bad in ONE_TASK_OR_ALL_PAIRS if bad in plan]


def test_scans_are_pruned(spark):
    plan = QUERIES["thread_stats"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "text" not in schema and "created_at" not in schema

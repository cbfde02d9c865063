"""From incoming messages to drafted replies and handling decisions, as one DataFrame plan."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.reply import decide_handling, draft_prompt, draft_reply, plain_reason
from ..functions.rules import response_behavior, weak_label
from ..functions.vocab import INTENT_BOOST, MODE_TEMPLATE, TOP_K
from ..operators.classifier import predict
from ..operators.retrieval import Index, evidence, retrieve

Classify = Callable[[DataFrame], DataFrame]


def model_classifier(model: PipelineModel) -> Classify:
    """Adds predicted_intent and confidence with a pipeline trained on the column ``message``."""
    return lambda df: predict(df, model)


def rule_classifier(df: DataFrame) -> DataFrame:
    """Adds the rule-based intent; its confidence is unknown (null)."""
    return df.withColumn("predicted_intent", weak_label(F.col("message"))["intent"]).withColumn(
        "confidence", F.lit(None).cast("double")
    )


def provider_replies(df: DataFrame, provider: Callable[[pd.Series], pd.Series]) -> DataFrame:
    """Replace the template draft by ``provider(prompts)``, called once per Arrow batch."""
    fields = [f for f in df.schema.fields if f.name != "draft_reply"]
    plain = df.select(*[f.name for f in fields])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(draft_reply=provider(batch["prompt"]))

    schema = plain.withColumn("draft_reply", F.lit("")).schema
    return plain.mapInPandas(run, schema)


def score_messages(
    messages: DataFrame,
    index: Index,
    corpus: DataFrame,
    classify: Classify = rule_classifier,
    k: int = TOP_K,
    boost: float = INTENT_BOOST,
    own_doc_col: str | None = None,
    provider: Callable[[pd.Series], pd.Series] | None = None,
    provider_name: str = "provider",
) -> DataFrame:
    """(message_id, message, ...) with intent, confidence, evidence, prompt and draft reply.

    ``mode`` tells whether the draft is the template's or an external provider's.
    """
    labelled = classify(messages)
    hits = retrieve(
        labelled, index, k, "message_id", "message", "predicted_intent", own_doc_col=own_doc_col, boost=boost
    )
    cases = evidence(hits, corpus).withColumnRenamed("query_id", "message_id")
    joined = labelled.join(cases, "message_id", "left")
    known = F.coalesce("evidence", F.array().cast(cases.schema["evidence"].dataType))
    scored = joined.withColumn(
        "prompt", draft_prompt(F.col("message"), F.col("predicted_intent"), known)
    ).withColumn("draft_reply", draft_reply(F.col("evidence")))
    if provider is not None:
        scored = provider_replies(scored, provider)
    return scored.withColumn("mode", F.lit(MODE_TEMPLATE if provider is None else f"real:{provider_name}"))


def route_messages(scored: DataFrame) -> DataFrame:
    """Adds the decision, its reason, and the behaviour implied by the closest past case."""
    decision = decide_handling(
        F.col("message"), F.col("predicted_intent"), F.col("evidence"), F.col("draft_reply"), F.col("confidence")
    )
    top = F.get("evidence", 0)
    return (
        scored.withColumn("__d", decision)
        .withColumns(
            {
                "predicted_handling": F.col("__d.decision"),
                "reason_code": F.col("__d.reason_code"),
                "handling_reason": F.col("__d.reason"),
                "plain_reason": plain_reason(F.col("__d.reason_code"), F.col("__d.decision")),
                "top_similarity": top["similarity_score"],
                "top_response_type": top["response_type"],
                "predicted_response_behavior": response_behavior(top["response_type"]),
            }
        )
        .drop("__d")
    )

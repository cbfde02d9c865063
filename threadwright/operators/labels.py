"""Label sheets: merging proposals, progress and comparison of label versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_filled
from ..functions.vocab import BULK_NOTE_PREFIX, UNCLEAR
from .metrics import category_shares, zero_safe

TARGETS = {
    "intent": "proposed_intent",
    "expected_response_behavior": "proposed_response_behavior",
    "expected_handling": "proposed_handling",
    "labeling_notes": "labeling_reason",
}


def decided_ids(golden: DataFrame, review: DataFrame) -> DataFrame:
    """Ids labelled in the golden sheet or approved in the review sheet."""
    labelled = golden.filter(F.col("intent") != "").select("tweet_id")
    approved = review.filter(F.col("approved_intent") != "").select("tweet_id")
    return labelled.union(approved).distinct()


def open_proposals(golden: DataFrame, review: DataFrame) -> DataFrame:
    return review.join(decided_ids(golden, review), "tweet_id", "left_anti")


def apply_labels(golden: DataFrame, review: DataFrame) -> DataFrame:
    """Golden sheet with open proposals copied in; decided rows stay as they are."""
    proposals = open_proposals(golden, review).select("tweet_id", *TARGETS.values(), F.lit(True).alias("__new"))
    copies = proposals.withColumnsRenamed({source: f"__{target}" for target, source in TARGETS.items()})
    joined = golden.join(copies, "tweet_id", "left")
    merged = {t: F.when(F.col("__new"), F.col(f"__{t}")).otherwise(F.col(t)) for t in TARGETS}
    return joined.withColumns(merged).select(*golden.columns)


def mark_approved(golden: DataFrame, review: DataFrame) -> DataFrame:
    """Review sheet after bulk approval of the open proposals, with a provenance note."""
    decided = decided_ids(golden, review).withColumn("__decided", F.lit(True))
    joined = review.join(decided, "tweet_id", "left").withColumn("__open", F.col("__decided").isNull())
    note = F.concat(
        F.lit(f"{BULK_NOTE_PREFIX} WITHOUT individual human review. Reason given: "), F.col("labeling_reason")
    )
    merged = {
        f"approved_{part}": F.when(F.col("__open"), F.col(f"proposed_{part}")).otherwise(F.col(f"approved_{part}"))
        for part in ("intent", "response_behavior", "handling")
    }
    merged["labeling_notes"] = F.when(F.col("__open"), note).otherwise(F.col("labeling_notes"))
    return joined.withColumns(merged).select(*review.columns)


def apply_decisions(golden: DataFrame, decisions: DataFrame) -> DataFrame:
    """Overwrite the label columns of the rows that were individually decided."""
    named = decisions.select("tweet_id", *[F.col(t).alias(f"__{t}") for t in TARGETS], F.lit(True).alias("__hit"))
    joined = golden.join(named, "tweet_id", "left")
    merged = {t: F.when(F.col("__hit"), F.col(f"__{t}")).otherwise(F.col(t)) for t in TARGETS}
    return joined.withColumns(merged).select(*golden.columns)


def attach_proposals(source: DataFrame, proposals: DataFrame) -> DataFrame:
    """Training sheet with proposed labels; check :func:`quality.unlabelled` on the result."""
    named = proposals.select("tweet_id", "intent", "confidence", F.col("reason").alias("labeling_reason"))
    return source.select("tweet_id", "conversation_context").join(named, "tweet_id", "left")


def progress(df: DataFrame, *columns: str) -> DataFrame:
    """Total, done (all columns filled) and remaining rows."""
    done = F.lit(True)
    for column in columns:
        done = done & is_filled(F.col(column))
    return df.agg(F.count(F.lit(1)).alias("total"), F.count_if(done).alias("done")).withColumn(
        "remaining", F.col("total") - F.col("done")
    )


def filled_rows(df: DataFrame, *columns: str) -> DataFrame:
    for column in columns:
        df = df.filter(is_filled(F.col(column)))
    return df


def enum_counts(df: DataFrame, column: str, labels: Sequence[str]) -> DataFrame:
    """Counts for every allowed value, then every unexpected one, of the filled rows."""
    filled = df.filter(is_filled(F.col(column)))
    known = category_shares(filled, column, labels).select("label", "n", F.lit(True).alias("expected"))
    other = filled.filter(~F.col(column).isin(*labels)).groupBy(F.col(column).alias("label"))
    return known.unionByName(other.agg(F.count(F.lit(1)).alias("n")).withColumn("expected", F.lit(False)))


def provenance(golden: DataFrame, review: DataFrame) -> DataFrame:
    """Overridden proposals, bulk-approved rows and rows decided by a person."""
    reviewed = review.agg(
        F.count_if(is_filled(F.col("approved_intent"))).alias("n_approved"),
        F.count_if(
            is_filled(F.col("approved_intent")) & (F.col("approved_intent") != F.col("proposed_intent"))
        ).alias("n_overridden"),
        F.count_if(F.startswith("labeling_notes", F.lit(BULK_NOTE_PREFIX))).alias("n_bulk"),
    )
    total = golden.agg(F.count(F.lit(1)).alias("n")).scalar()
    return reviewed.select("n_approved", "n_overridden", "n_bulk", (total - F.col("n_bulk")).alias("n_human"))


def compare_versions(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row per shared id with both labels."""
    return old.select("tweet_id", F.col("intent").alias("old_intent")).join(
        new.select("tweet_id", F.col("intent").alias("new_intent"), "confidence"), "tweet_id"
    )


def version_summary(pairs: DataFrame) -> DataFrame:
    return pairs.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("old_intent") != F.col("new_intent")).alias("changed"),
        F.count_if(F.col("new_intent") == UNCLEAR).alias("still_unclear"),
        F.count_if(F.col("confidence").isin("medium", "low")).alias("medium_or_low"),
    ).withColumn("changed_pct", zero_safe(F.col("changed") * 100.0, F.col("total")))


def version_counts(pairs: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Rows per label before and after."""
    old = category_shares(pairs, "old_intent", labels).select("label", F.col("n").alias("n_old"))
    new = category_shares(pairs, "new_intent", labels).select("label", F.col("n").alias("n_new"))
    return old.join(new, "label")


def changed_rows(pairs: DataFrame, n: int) -> DataFrame:
    return pairs.filter(F.col("old_intent") != F.col("new_intent")).orderBy("tweet_id").limit(n)

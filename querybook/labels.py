"""Label sheet and quality gate queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadwright.functions import vocab as V
from threadwright.operators import context, labels, quality

from .oracle import compose, listed, q
from .registry import query
from .tables import Book

OPEN = (
    "review.tweet_id NOT IN (SELECT tweet_id FROM golden WHERE intent <> '' "
    "UNION SELECT tweet_id FROM review WHERE approved_intent <> '')"
)
LABEL_COLUMNS = ["intent", "expected_response_behavior", "expected_handling", "labeling_notes"]
SOURCES = ["proposed_intent", "proposed_response_behavior", "proposed_handling", "labeling_reason"]


@query("C5", lambda: compose(f"SELECT tweet_id, proposed_intent FROM review WHERE {OPEN}"))
def open_proposals(b: Book) -> DataFrame:
    return labels.open_proposals(b.golden_sheet, b.review_sheet).select("tweet_id", "proposed_intent")


@query(
    "C9",
    lambda: compose(
        "SELECT g.tweet_id, "
        + ", ".join(f"CASE WHEN o.tweet_id IS NOT NULL THEN o.{s} ELSE g.{t} END AS {t}" for t, s in zip(LABEL_COLUMNS, SOURCES))
        + " FROM golden g LEFT JOIN opened o ON o.tweet_id = g.tweet_id",
        {"opened": f"SELECT * FROM review WHERE {OPEN}"},
    ),
)
def applied_labels(b: Book) -> DataFrame:
    return labels.apply_labels(b.golden_sheet, b.review_sheet)


@query(
    "C9",
    lambda: compose(
        "SELECT r.tweet_id, CASE WHEN o.tweet_id IS NOT NULL THEN r.proposed_intent ELSE r.approved_intent END AS approved_intent, "
        "CASE WHEN o.tweet_id IS NOT NULL THEN r.proposed_response_behavior ELSE r.approved_response_behavior END AS approved_response_behavior, "
        "CASE WHEN o.tweet_id IS NOT NULL THEN r.proposed_handling ELSE r.approved_handling END AS approved_handling, "
        "CASE WHEN o.tweet_id IS NOT NULL THEN 'Auto-approved in bulk WITHOUT individual human review. Reason given: ' || r.labeling_reason ELSE r.labeling_notes END AS labeling_notes "
        "FROM review r LEFT JOIN opened o ON o.tweet_id = r.tweet_id",
        {"opened": f"SELECT * FROM review WHERE {OPEN}"},
    ),
)
def approved_review(b: Book) -> DataFrame:
    columns = ["approved_intent", "approved_response_behavior", "approved_handling", "labeling_notes"]
    return labels.mark_approved(b.golden_sheet, b.review_sheet).select("tweet_id", *columns)


@query(
    "C9",
    lambda: compose(
        "SELECT g.tweet_id, CASE WHEN r.approved_intent <> '' THEN r.approved_intent ELSE g.intent END AS intent, "
        "CASE WHEN r.approved_intent <> '' THEN r.approved_response_behavior ELSE g.expected_response_behavior END AS expected_response_behavior, "
        "CASE WHEN r.approved_intent <> '' THEN r.approved_handling ELSE g.expected_handling END AS expected_handling, "
        "CASE WHEN r.approved_intent <> '' THEN r.labeling_notes ELSE g.labeling_notes END AS labeling_notes "
        "FROM golden g JOIN review r USING (tweet_id)"
    ),
)
def individually_decided(b: Book) -> DataFrame:
    decisions = b.review_sheet.filter(F.col("approved_intent") != "").select(
        "tweet_id",
        F.col("approved_intent").alias("intent"),
        F.col("approved_response_behavior").alias("expected_response_behavior"),
        F.col("approved_handling").alias("expected_handling"),
        "labeling_notes",
    )
    return labels.apply_decisions(b.golden_sheet, decisions)


@query(
    "C6",
    lambda: compose(
        "SELECT s.tweet_id, s.conversation_context, v.intent, v.confidence, v.note AS labeling_reason FROM sheet s LEFT JOIN silver v USING (tweet_id)"
    ),
)
def silver_training_sheet(b: Book) -> DataFrame:
    source = context.labeling_rows(b.rows)
    return labels.attach_proposals(source, b.silver.withColumnRenamed("note", "reason"))


@query(
    "D30",
    lambda: compose(
        "SELECT count(*) AS total, count(*) FILTER (intent <> '' AND expected_response_behavior <> '' AND expected_handling <> '') AS done, "
        "count(*) FILTER (NOT (intent <> '' AND expected_response_behavior <> '' AND expected_handling <> '')) AS remaining FROM golden"
    ),
)
def labeling_progress(b: Book) -> DataFrame:
    return labels.progress(b.golden_sheet, "intent", "expected_response_behavior", "expected_handling")


@query(
    "D30",
    lambda: compose(
        " UNION ALL ".join(
            f"SELECT {q(n)} AS label, count(*) FILTER (intent = {q(n)}) AS n, TRUE AS expected FROM golden" for n in V.INTENTS
        )
        + f" UNION ALL SELECT intent, count(*), FALSE FROM golden WHERE intent <> '' AND intent NOT IN ({listed(V.INTENTS)}) GROUP BY intent"
    ),
)
def labelled_intent_counts(b: Book) -> DataFrame:
    """Counts per allowed intent; the escape-hatch label shows up as unexpected here."""
    return labels.enum_counts(b.golden_sheet, "intent", V.INTENTS)


@query(
    "D30",
    lambda: compose(
        " UNION ALL ".join(
            f"SELECT {q(n)} AS label, count(*) FILTER (expected_response_behavior = {q(n)}) AS n, TRUE AS expected FROM golden"
            for n in V.BEHAVIORS
        )
    ),
)
def labelled_behavior_counts(b: Book) -> DataFrame:
    return labels.enum_counts(b.golden_sheet, "expected_response_behavior", V.BEHAVIORS)


@query(
    "D31",
    lambda: compose(
        "SELECT count(*) FILTER (approved_intent <> '') AS n_approved, count(*) FILTER (approved_intent <> '' AND approved_intent <> proposed_intent) AS n_overridden, "
        "count(*) FILTER (starts_with(labeling_notes, 'Auto-approved in bulk')) AS n_bulk, "
        "(SELECT count(*) FROM golden) - count(*) FILTER (starts_with(labeling_notes, 'Auto-approved in bulk')) AS n_human FROM ("
        "SELECT r.tweet_id, r.proposed_intent, CASE WHEN o.tweet_id IS NOT NULL THEN r.proposed_intent ELSE r.approved_intent END AS approved_intent, "
        "CASE WHEN o.tweet_id IS NOT NULL THEN 'Auto-approved in bulk' ELSE r.labeling_notes END AS labeling_notes "
        "FROM review r LEFT JOIN opened o ON o.tweet_id = r.tweet_id)",
        {"opened": f"SELECT * FROM review WHERE {OPEN}"},
    ),
)
def label_provenance(b: Book) -> DataFrame:
    return labels.provenance(b.golden_sheet, labels.mark_approved(b.golden_sheet, b.review_sheet))


VERSIONS = {
    "vers": (
        "SELECT p.tweet_id, p.predicted_intent AS old_intent, v.intent AS new_intent, v.confidence FROM pred p JOIN silver v USING (tweet_id)"
    )
}


def versions(b: Book) -> DataFrame:
    old = b.predictions.select("tweet_id", F.col("predicted_intent").alias("intent"))
    return labels.compare_versions(old, b.silver)


@query(
    "D32",
    lambda: compose(
        "SELECT count(*) AS total, count(*) FILTER (old_intent <> new_intent) AS changed, count(*) FILTER (new_intent = 'UNCLEAR') AS still_unclear, "
        "count(*) FILTER (confidence IN ('medium', 'low')) AS medium_or_low, round(100.0 * count(*) FILTER (old_intent <> new_intent) / count(*), 6) AS changed_pct FROM vers",
        VERSIONS,
    ),
)
def label_version_summary(b: Book) -> DataFrame:
    return labels.version_summary(versions(b)).withColumn("changed_pct", F.round("changed_pct", 6))


@query(
    "D32",
    lambda: compose(
        " UNION ALL ".join(
            f"SELECT {q(n)} AS label, count(*) FILTER (old_intent = {q(n)}) AS n_old, count(*) FILTER (new_intent = {q(n)}) AS n_new FROM vers"
            for n in V.INTENT_LABELS
        ),
        VERSIONS,
    ),
)
def label_version_counts(b: Book) -> DataFrame:
    return labels.version_counts(versions(b), V.INTENT_LABELS)


@query(
    "E6, D32",
    lambda: compose("SELECT tweet_id, old_intent, new_intent FROM vers WHERE old_intent <> new_intent ORDER BY tweet_id LIMIT 10", VERSIONS),
)
def first_changed_labels(b: Book) -> DataFrame:
    return labels.changed_rows(versions(b), 10).select("tweet_id", "old_intent", "new_intent")


@query("Q1", lambda: compose("SELECT count(*) FILTER (TRY_CAST(in_response_to_tweet_id AS BIGINT) IS NULL) AS n_bad_ids FROM raw"))
def numeric_id_gate(b: Book) -> DataFrame:
    """Counted on the parent pointers, which do hold non-numeric values."""
    return quality.non_numeric_ids(b.raw, "in_response_to_tweet_id")


@query("Q2", lambda: compose("SELECT count(*) - count(DISTINCT author_id) AS n_duplicates FROM raw"))
def unique_id_gate(b: Book) -> DataFrame:
    """Counted on the author column, which does repeat."""
    return quality.repeated_ids(b.raw, "author_id")


@query("Q2", lambda: compose("SELECT count(*) - count(DISTINCT tweet_id) AS n_duplicates FROM m"))
def unique_message_gate(b: Book) -> DataFrame:
    return quality.repeated_ids(b.messages)


@query(
    "Q3",
    lambda: compose(
        f"SELECT count(*) FILTER (intent NOT IN ({listed(V.INTENT_LABELS)})) AS bad_intent, "
        f"count(*) FILTER (expected_response_behavior NOT IN ({listed(V.BEHAVIORS)})) AS bad_expected_response_behavior, "
        f"count(*) FILTER (expected_handling NOT IN ({listed(V.HANDLINGS)})) AS bad_expected_handling FROM golden"
    ),
)
def vocabulary_gate(b: Book) -> DataFrame:
    return quality.outside_vocabulary(
        b.golden_sheet,
        {"intent": V.INTENT_LABELS, "expected_response_behavior": V.BEHAVIORS, "expected_handling": V.HANDLINGS},
    )


@query("Q4", lambda: compose("SELECT count(*) FILTER (s.intent IS NULL) AS n_unlabelled FROM m LEFT JOIN silver s USING (tweet_id)"))
def label_coverage_gate(b: Book) -> DataFrame:
    joined = b.messages.select("tweet_id").join(b.silver.select("tweet_id", "intent"), "tweet_id", "left")
    return quality.unlabelled(joined)


@query(
    "Q5",
    lambda: compose(
        "SELECT count(*) FILTER (b.n IS NULL) AS only_left, count(*) FILTER (a.n IS NULL) AS only_right, "
        "count(*) FILTER (a.n > 1 OR b.n > 1) AS repeated FROM (SELECT author_id, count(*) AS n FROM m WHERE is_customer GROUP BY author_id) a "
        "FULL JOIN (SELECT author_id, count(*) AS n FROM m WHERE is_support GROUP BY author_id) b ON a.author_id = b.author_id"
    ),
)
def one_to_one_gate(b: Book) -> DataFrame:
    return quality.not_one_to_one(b.messages.filter("is_customer"), b.messages.filter("is_support"), "author_id")


@query(
    "Q5",
    lambda: compose(
        "SELECT count(*) FILTER (coalesce(g.n, 0) <> 1) AS not_exactly_one, count(*) FILTER (coalesce(g.done, 0) > 0) AS already_labelled "
        "FROM m LEFT JOIN (SELECT tweet_id, count(*) AS n, count(*) FILTER (intent <> '') AS done FROM golden GROUP BY tweet_id) g USING (tweet_id)"
    ),
)
def proposal_target_gate(b: Book) -> DataFrame:
    return quality.misplaced_proposals(b.messages, b.golden_sheet)


@query(
    "Q7",
    lambda: compose(
        "SELECT count(*) FILTER (intent <> '') AS filled_intent, count(*) FILTER (labeling_notes <> '') AS filled_labeling_notes FROM golden"
    ),
)
def blank_sheet_gate(b: Book) -> DataFrame:
    return quality.non_blank(b.golden_sheet, "intent", "labeling_notes")


@query("Q8", lambda: compose("SELECT count(*) FILTER (intent = '') AS blank_intent, count(*) FILTER (expected_handling = '') AS blank_expected_handling FROM golden"))
def approval_gate(b: Book) -> DataFrame:
    return quality.still_blank(b.golden_sheet, "intent", "expected_handling")


@query(
    "Q8",
    lambda: compose(
        "SELECT count(*) FILTER (relevance NOT BETWEEN 1 AND 3) AS bad_relevance, count(*) FILTER (human_relevance NOT BETWEEN 1 AND 3) AS bad_human_relevance FROM scored"
    ),
)
def score_range_gate(b: Book) -> DataFrame:
    """A range of 1 to 3 here, so that both columns do violate it."""
    return quality.scores_out_of_range(b.scored, "relevance", "human_relevance", high=3)


@query("Q8", lambda: compose("SELECT abs(count(*) - 200) AS n_off FROM golden"))
def row_count_gate(b: Book) -> DataFrame:
    return quality.unexpected_row_count(b.golden_sheet, 200)

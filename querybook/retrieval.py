"""Retrieval and reply queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadwright.functions import reply, rules
from threadwright.functions import vocab as V
from threadwright.operators import retrieval

from .oracle import compose, mapped, matches, q, ranked, strip, tfidf, weak
from .registry import query
from .tables import Book, pick

CORPUS_DOCS = {
    "docs": "SELECT tweet_id AS id, customer_text AS text, intent FROM corpus",
    "qs": f"SELECT tweet_id AS id, text, {weak('text', 0)} AS intent FROM op",
    "plain_qs": "SELECT tweet_id AS id, text, CAST(NULL AS VARCHAR) AS intent FROM op",
}
DOCUMENTS = {
    "docs": "SELECT doc_id AS id, text, source AS intent FROM documents",
    "qs": "SELECT item_id AS id, text, 'src' || (item_id % 20) AS intent FROM benchmark",
    "plain_qs": "SELECT item_id AS id, text, CAST(NULL AS VARCHAR) AS intent FROM benchmark",
}
HITS = "SELECT query_id, rank, doc_id, intent, round(similarity, 6) AS similarity FROM r_hits"


def shown(hits: DataFrame) -> DataFrame:
    return hits.select("query_id", "rank", "doc_id", "intent", F.round("similarity", 6).alias("similarity"))


@query(
    "R1",
    lambda: compose("SELECT id AS tweet_id, term, round(w, 6) AS w FROM r_w", {**CORPUS_DOCS, **tfidf("r", "docs")}),
)
def corpus_tfidf(b: Book) -> DataFrame:
    table = retrieval.tfidf_postings(b.corpus, "tweet_id", "customer_text")
    return table.withColumn("w", F.round("w", 6))


@query(
    "R1",
    lambda: compose("SELECT id AS doc_id, count(*) AS n_terms, round(sum(w * w), 6) AS norm, max(term) AS last_term FROM r_w GROUP BY id", {**DOCUMENTS, **tfidf("r", "docs")}),
)
def document_tfidf(b: Book) -> DataFrame:
    table = retrieval.tfidf_postings(b.table("documents"), "doc_id", "text")
    return table.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_terms"),
        F.round(F.sum(F.col("w") * F.col("w")), 6).alias("norm"),
        F.max("term").alias("last_term"),
    )


@query("D34", lambda: compose("SELECT count(*) AS n_terms FROM r_vocab", {**CORPUS_DOCS, **tfidf("r", "docs")}))
def vocabulary_size(b: Book) -> DataFrame:
    return b.index.statistics.vocabulary.agg(F.count(F.lit(1)).alias("n_terms"))


@query(
    "R2, C11, F4",
    lambda: compose(HITS, {**CORPUS_DOCS, **tfidf("r", "docs", queries="plain_qs"), **ranked("r", "docs", "plain_qs", 5)}),
)
def similar_requests(b: Book) -> DataFrame:
    return shown(retrieval.retrieve(b.openings, b.index, 5, "tweet_id"))


@query(
    "R2, C11, F4",
    lambda: compose(HITS, {**DOCUMENTS, **tfidf("r", "docs", queries="plain_qs"), **ranked("r", "docs", "plain_qs", 5)}),
)
def similar_documents(b: Book) -> DataFrame:
    return shown(retrieval.retrieve(b.table("benchmark"), b.document_index, 5, "item_id"))


@query(
    "R3",
    lambda: compose(HITS, {**CORPUS_DOCS, **tfidf("r", "docs", queries="qs"), **ranked("r", "docs", "qs", 5)}),
)
def boosted_requests(b: Book) -> DataFrame:
    asked = b.openings.withColumn("intent", rules.weak_label(F.col("text"))["intent"])
    return shown(retrieval.retrieve(asked, b.index, 5, "tweet_id", intent_col="intent"))


@query(
    "R3",
    lambda: compose(HITS, {**DOCUMENTS, **tfidf("r", "docs", queries="qs"), **ranked("r", "docs", "qs", 5)}),
)
def boosted_documents(b: Book) -> DataFrame:
    asked = b.table("benchmark").withColumn("intent", F.concat(F.lit("src"), F.col("item_id") % 20))
    return shown(retrieval.retrieve(asked, b.document_index, 5, "item_id", intent_col="intent"))


@query(
    "R5",
    lambda: compose(HITS, {**CORPUS_DOCS, **tfidf("r", "docs", queries="qs"), **ranked("r", "docs", "qs", 5, own=True)}),
)
def requests_without_self(b: Book) -> DataFrame:
    asked = b.openings.withColumn("intent", rules.weak_label(F.col("text"))["intent"]).withColumn(
        "own", F.col("tweet_id")
    )
    return shown(retrieval.retrieve(asked, b.index, 5, "tweet_id", intent_col="intent", own_doc_col="own"))


BOOSTED = {**CORPUS_DOCS, **tfidf("r", "docs", queries="qs"), **ranked("r", "docs", "qs", 5)}
EVIDENCE = {
    **BOOSTED,
    "ev": (
        "SELECT h.query_id, h.rank, h.similarity, c.tweet_id, c.customer_text, c.support_text, c.response_type "
        "FROM r_hits h JOIN corpus c ON c.tweet_id = h.doc_id"
    ),
    "top": "SELECT * FROM ev WHERE rank = 1",
}


def boosted_evidence(b: Book) -> DataFrame:
    asked = b.openings.withColumn("intent", rules.weak_label(F.col("text"))["intent"])
    hits = retrieval.retrieve(asked, b.index, 5, "tweet_id", intent_col="intent")
    cases = retrieval.evidence(hits, b.corpus).withColumnRenamed("query_id", "tweet_id")
    return asked.join(cases, "tweet_id", "left")


@query(
    "R4",
    lambda: compose(
        "SELECT query_id AS tweet_id, string_agg(rank || ':' || tweet_id || ':' || response_type, '|' ORDER BY rank) AS cases FROM ev GROUP BY query_id",
        EVIDENCE,
    ),
)
def evidence_lists(b: Book) -> DataFrame:
    line = F.transform(
        "evidence", lambda e: F.concat_ws(":", e["rank"], e["source_tweet_id"], e["response_type"])
    )
    return boosted_evidence(b).select("tweet_id", F.array_join(line, "|").alias("cases"))


@query(
    "I14",
    lambda: compose(
        "SELECT query_id AS tweet_id, string_agg('[' || rank || '] similarity=' || printf('%.3f', round_even(similarity, 3)) || ' response_type=' || response_type || chr(10) "
        "|| '    historical customer message: ' || customer_text || chr(10) || '    historical AppleSupport reply: ' || support_text, chr(10) ORDER BY rank) AS summary "
        "FROM ev WHERE rank <= 3 GROUP BY query_id",
        EVIDENCE,
    ),
)
def evidence_summaries(b: Book) -> DataFrame:
    return boosted_evidence(b).select("tweet_id", reply.evidence_summary(F.col("evidence"), 3).alias("summary"))


@query("I14", lambda: compose(
    f"SELECT query_id AS tweet_id, md5({q(V.DRAFT_INSTRUCTIONS)} || chr(10) || chr(10) || 'NEW CUSTOMER MESSAGE: ' || any_value(qs.text) || chr(10) || 'PREDICTED INTENT: ' || any_value(qs.intent) "
    "|| chr(10) || chr(10) || 'RETRIEVED HISTORICAL EXAMPLES (most similar first):' || chr(10) || string_agg(chr(10) || '[' || rank || '] similarity=' || printf('%.3f', round_even(similarity, 3)) || '  response_type=' || response_type || chr(10) "
    "|| '    historical customer message: ' || customer_text || chr(10) || '    historical AppleSupport reply: ' || support_text, chr(10) ORDER BY rank) "
    "|| chr(10) || chr(10) || 'Draft a concise reply to the NEW CUSTOMER MESSAGE above.') AS prompt_md5 FROM ev JOIN qs ON qs.id = ev.query_id GROUP BY query_id",
    EVIDENCE,
))
def draft_prompts(b: Book) -> DataFrame:
    prompt = reply.draft_prompt(F.col("text"), F.col("intent"), F.col("evidence"))
    return boosted_evidence(b).select("tweet_id", F.md5(prompt).alias("prompt_md5"))


BARE = f"regexp_replace({strip('support_text')}, '^@\\S+\\s*', '')"
DRAFT = (
    f"CASE WHEN similarity < 0.15::DOUBLE OR response_type IN ('DM handoff', 'other/unclear') THEN {q(V.REPLY_PRIVATE)} "
    f"WHEN response_type = 'clarifying question' THEN {q(V.REPLY_CLARIFY[0])} || {BARE} || {q(V.REPLY_CLARIFY[1])} "
    f"ELSE {q(V.REPLY_SIMILAR[0])} || {BARE} || {q(V.REPLY_SIMILAR[1])} END"
)


@query("I13", lambda: compose(f"SELECT query_id AS tweet_id, {DRAFT} AS draft FROM top", EVIDENCE))
def draft_replies(b: Book) -> DataFrame:
    return boosted_evidence(b).select("tweet_id", reply.draft_reply(F.col("evidence")).alias("draft"))


def decision_sql(confidence: str, message: str = "text", intent: str = "intent") -> str:
    """Reason code by the ordered handling rules; the draft is never empty here."""
    return (
        f"CASE WHEN {intent} = 'Account, Purchases & Billing' THEN 'sensitive_intent' "
        f"WHEN {matches(f'lower({message})', V.SENSITIVE_KEYWORDS)} THEN 'sensitive_keyword' "
        f"WHEN {confidence} < 0.25::DOUBLE THEN 'low_confidence' "
        "WHEN similarity < 0.15::DOUBLE THEN 'weak_similarity' "
        "WHEN response_type = 'DM handoff' THEN 'private_handoff' "
        "WHEN response_type = 'other/unclear' THEN 'unclear_reply' "
        "WHEN response_type = 'clarifying question' THEN 'clarifying' "
        "WHEN similarity >= 0.30::DOUBLE THEN 'reusable' ELSE 'weak_reuse' END"
    )


HANDLING = "CASE WHEN code IN ('clarifying', 'reusable') THEN 'AUTO-HANDLE' ELSE 'ESCALATE' END"


@query(
    "I15, I16",
    lambda: compose(
        f"SELECT tweet_id, {HANDLING} AS decision, code AS reason_code, {mapped('code', V.PLAIN_REASONS)} AS plain FROM "
        f"(SELECT query_id AS tweet_id, {decision_sql('CAST(query_id % 40 AS DOUBLE) / 80.0 + 0.1')} AS code FROM "
        "(SELECT top.query_id, top.similarity, top.response_type, qs.text, qs.intent FROM top JOIN qs ON qs.id = top.query_id))",
        EVIDENCE,
    ),
)
def handling_decisions(b: Book) -> DataFrame:
    drafted = boosted_evidence(b).withColumn("draft", reply.draft_reply(F.col("evidence")))
    confidence = (F.col("tweet_id") % 40) / 80.0 + 0.1
    decision = reply.decide_handling(
        F.col("text"), F.col("intent"), F.col("evidence"), F.col("draft"), confidence
    )
    decided = drafted.select("tweet_id", decision.alias("d")).select("tweet_id", "d.decision", "d.reason_code")
    return decided.withColumn("plain", reply.plain_reason(F.col("reason_code"), F.col("decision")))


@query(
    "I15",
    lambda: compose(
        "SELECT tweet_id, code, similarity, response_type FROM (SELECT tweet_id, similarity, response_type, text, intent, confidence, "
        f"{decision_sql('confidence')} AS code FROM (SELECT tweet_id, text, predicted_intent AS intent, top_similarity AS similarity, "
        "([" + ", ".join(q(t) for t in V.RESPONSE_TYPES) + "])[tweet_id % 5 + 1] AS response_type, "
        "CASE WHEN tweet_id % 4 = 0 THEN NULL ELSE confidence END AS confidence FROM pred))"
    ),
)
def handling_rules(b: Book) -> DataFrame:
    """Every rule of the decision table over synthetic evidence of each opening message."""
    kind = pick(V.RESPONSE_TYPES, F.col("tweet_id") % 5)
    case = F.struct(
        F.col("top_similarity").alias("similarity_score"),
        kind.alias("response_type"),
        F.lit("asked before").alias("historical_customer_text"),
        F.lit("@someone answered before").alias("historical_support_text"),
    )
    confidence = F.when(F.col("tweet_id") % 4 != 0, F.col("confidence"))
    rows = b.predictions.withColumn("evidence", F.array(case))
    decision = reply.decide_handling(
        F.col("text"), F.col("predicted_intent"), F.col("evidence"), reply.draft_reply(F.col("evidence")), confidence
    )
    return rows.select(
        "tweet_id",
        decision["reason_code"].alias("code"),
        F.col("top_similarity").alias("similarity"),
        kind.alias("response_type"),
    )

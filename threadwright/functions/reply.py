"""Evidence texts, evidence-only reply drafts and handling decisions.

``evidence`` is an array of structs ordered by rank with the fields ``similarity_score``,
``response_type``, ``historical_customer_text`` and ``historical_support_text``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab as V
from .patterns import lookup
from .text import strip, strip_leading_mention


def _example(item: Column, index: Column, gap: str) -> Column:
    return F.concat(
        F.lit("["),
        (index + 1).cast("string"),
        F.lit("] similarity="),
        F.format_string("%.3f", F.bround(item["similarity_score"], 3)),
        F.lit(gap + "response_type="),
        item["response_type"],
        F.lit("\n    historical customer message: "),
        item["historical_customer_text"],
        F.lit("\n    historical AppleSupport reply: "),
        item["historical_support_text"],
    )


def evidence_summary(evidence: Column, k: int = 3) -> Column:
    """Numbered text of the first ``k`` evidence items."""
    lines = F.transform(F.slice(evidence, 1, k), lambda item, i: _example(item, i, " "))
    return F.when(F.coalesce(F.size(evidence), F.lit(0)) <= 0, F.lit(V.NO_EVIDENCE_SUMMARY)).otherwise(
        F.array_join(lines, "\n")
    )


def draft_prompt(
    message: Column, intent: Column, evidence: Column, instructions: str = V.DRAFT_INSTRUCTIONS
) -> Column:
    examples = F.transform(evidence, lambda item, i: F.concat(F.lit("\n"), _example(item, i, "  ")))
    head = F.array(
        F.lit(instructions),
        F.lit(""),
        F.concat(F.lit("NEW CUSTOMER MESSAGE: "), message),
        F.concat(F.lit("PREDICTED INTENT: "), intent),
        F.lit(""),
        F.lit("RETRIEVED HISTORICAL EXAMPLES (most similar first):"),
    )
    tail = F.array(F.lit("\nDraft a concise reply to the NEW CUSTOMER MESSAGE above."))
    return F.array_join(F.concat(head, examples, tail), "\n")


def judge_prompt(
    message: Column,
    intent: Column,
    summary: Column,
    draft: Column,
    k: int = 3,
    instructions: str = V.JUDGE_INSTRUCTIONS,
) -> Column:
    return F.concat(
        F.lit(instructions + "\nCUSTOMER MESSAGE: "),
        message,
        F.lit("\nPREDICTED INTENT: "),
        intent,
        F.lit(f"\n\nRETRIEVED HISTORICAL EVIDENCE (top {k}):\n"),
        summary,
        F.lit("\n\nDRAFT REPLY: "),
        draft,
        F.lit("\n"),
    )


def draft_reply(evidence: Column, weak: float = V.WEAK_SIMILARITY) -> Column:
    """Template reply built from the most similar case only."""
    top = F.get(evidence, 0)
    kind = top["response_type"]
    grounded = strip_leading_mention(top["historical_support_text"])
    return (
        F.when(F.coalesce(F.size(evidence), F.lit(0)) <= 0, F.lit(V.REPLY_NO_EVIDENCE))
        .when(
            (top["similarity_score"] < weak) | kind.isin("DM handoff", "other/unclear"),
            F.lit(V.REPLY_PRIVATE),
        )
        .when(
            kind == "clarifying question",
            F.concat(F.lit(V.REPLY_CLARIFY[0]), grounded, F.lit(V.REPLY_CLARIFY[1])),
        )
        .otherwise(F.concat(F.lit(V.REPLY_SIMILAR[0]), grounded, F.lit(V.REPLY_SIMILAR[1])))
    )


def decide_handling(
    message: Column,
    intent: Column,
    evidence: Column,
    draft: Column,
    confidence: Column | None = None,
    weak: float = V.WEAK_SIMILARITY,
    strong: float = V.STRONG_SIMILARITY,
    min_confidence: float = V.CONFIDENCE_THRESHOLD,
) -> Column:
    """Struct (decision, reason_code, reason); the first rule that applies wins.

    A null ``confidence`` means "unknown" and never escalates by itself.
    """
    confidence = F.lit(None).cast("double") if confidence is None else confidence
    top = F.get(evidence, 0)
    similarity, kind = top["similarity_score"], top["response_type"]
    shown = F.format_string("%.2f", F.bround(similarity, 2))

    def verdict(decision: str, code: str, *parts) -> Column:
        reason = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
        return F.struct(
            F.lit(decision).alias("decision"), F.lit(code).alias("reason_code"), reason.alias("reason")
        )

    closest = "Closest historical match (similarity "
    return (
        F.when(
            strip(F.coalesce(draft, F.lit(""))) == "",
            verdict("ESCALATE", "no_draft", "No draft reply was produced."),
        )
        .when(
            F.coalesce(F.size(evidence), F.lit(0)) <= 0,
            verdict(
                "ESCALATE",
                "no_evidence",
                "No historical evidence was retrieved -- nothing to ground an automatic reply in.",
            ),
        )
        .when(
            intent.isin(*V.SENSITIVE_INTENTS),
            verdict(
                "ESCALATE",
                "sensitive_intent",
                "Predicted intent '",
                intent,
                "' involves account/purchases/billing -- always escalated to a human regardless of evidence quality.",
            ),
        )
        .when(
            F.lower(message).rlike(V.SENSITIVE_KEYWORDS),
            verdict(
                "ESCALATE",
                "sensitive_keyword",
                "Customer message contains a sensitive account/payment term (e.g. password, refund, charged) -- "
                "escalated as a safety net independent of the predicted intent, since intent classification can be "
                "wrong.",
            ),
        )
        .when(
            confidence < min_confidence,
            verdict(
                "ESCALATE",
                "low_confidence",
                "Classifier confidence in '",
                F.coalesce(intent, F.lit("")),
                "' is only ",
                F.format_string("%.2f", F.bround(confidence, 2)),
                f" (below {min_confidence}) -- too low to trust the predicted intent for an automatic reply.",
            ),
        )
        .when(
            similarity < weak,
            verdict(
                "ESCALATE",
                "weak_similarity",
                "Closest historical match has similarity ",
                shown,
                f" (below {weak}) -- too weak to trust for an automatic reply.",
            ),
        )
        .when(
            kind == "DM handoff",
            verdict(
                "ESCALATE",
                "private_handoff",
                closest,
                shown,
                ") is a DM handoff, which is NOT proof the issue was actually resolved.",
            ),
        )
        .when(
            kind == "other/unclear",
            verdict(
                "ESCALATE",
                "unclear_reply",
                closest,
                shown,
                ") is unclear / an escalation referral, not a reusable public instruction.",
            ),
        )
        .when(
            kind == "clarifying question",
            verdict(
                "AUTO-HANDLE",
                "clarifying",
                closest,
                shown,
                ") is a safe, reusable clarifying question -- it asks for more detail rather than asserting any fact, "
                "so there is no risk of inventing information.",
            ),
        )
        .when(
            kind.isin("direct instruction/link", "confirmation/status") & (similarity >= strong),
            verdict(
                "AUTO-HANDLE",
                "reusable",
                closest,
                shown,
                ") is a genuine public ",
                kind,
                " with strong textual similarity -- safe to reuse.",
            ),
        )
        .when(
            kind.isin("direct instruction/link", "confirmation/status"),
            verdict(
                "ESCALATE",
                "weak_reuse",
                "Closest historical match is a ",
                kind,
                ", but similarity is only ",
                shown,
                f" (below {strong}) -- too weak to trust as a direct reuse.",
            ),
        )
        .otherwise(
            verdict(
                "ESCALATE",
                "unknown_type",
                "Unrecognized response_type '",
                F.coalesce(kind, F.lit("None")),
                "' for the closest match -- defaulting to escalation.",
            )
        )
    )


def plain_reason(reason_code: Column, decision: Column) -> Column:
    """Wording for end users with the same meaning as the audit reason."""
    return F.coalesce(lookup(reason_code, V.PLAIN_REASONS), lookup(decision, V.PLAIN_FALLBACK))

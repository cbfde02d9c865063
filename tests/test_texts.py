from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from threadwright.functions import reply, rules, text
from threadwright.functions import vocab as V
from threadwright.functions.patterns import matches
from threadwright.functions.scoring import heuristic_scores
from threadwright.sources.fixtures import CUSTOMER_PHRASES, SUPPORT_PHRASES

BUG = "Software / App Bug Report"
CUSTOMER_LABELS = [
    ("Battery & Performance", "high"),
    ("Connectivity", "high"),
    ("Apple Music / iCloud Sync & Data Loss", "high"),
    ("Account, Purchases & Billing", "high"),
    ("Hardware, Repair & Warranty", "high"),
    ("Messaging & Communication", "high"),
    (BUG, "medium"),
    ("General / Pre-Purchase Inquiry", "medium"),
    (BUG, "low"),
    ("UNCLEAR", "none"),
    (BUG, "high"),
    ("Connectivity", "high"),
    (BUG, "high"),
    ("Account, Purchases & Billing", "high"),
    ("Apple Music / iCloud Sync & Data Loss", "high"),
    (BUG, "low"),
]


@pytest.fixture(scope="module")
def apply(spark):
    def run(expression, texts):
        df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i")
        return [r.x for r in df.select(expression(F.col("t")).alias("x")).collect()]

    return run


def test_weak_labels_of_the_phrases(apply):
    labels = apply(rules.weak_label, CUSTOMER_PHRASES)
    assert [(x.intent, x.confidence) for x in labels] == CUSTOMER_LABELS


def test_reply_classes_of_the_phrases(apply):
    assert apply(rules.classify_reply, SUPPORT_PHRASES) == V.REPLY_CLASSES


def test_link_code_counts_as_private_handoff(apply):
    assert apply(rules.classify_reply, ["https://t.co/GDrqU22YpT"]) == ["dm_handoff"]


def test_response_types_and_behaviors(apply):
    types = apply(lambda t: rules.response_type(rules.classify_reply(t)), SUPPORT_PHRASES)
    assert types == [V.RESPONSE_TYPE_OF_CLASS[c] for c in V.REPLY_CLASSES]
    assert apply(rules.response_behavior, ["DM handoff", "nonsense", None]) == ["dm_handoff", "unclear", "unclear"]


def test_word_boundaries_know_accents_and_selectors(apply):
    assert apply(lambda t: matches(t, r"\bfix\b"), ["éfix", "a fix", "fix️", "fixé", "fix_", "(fix)"]) == [
        False,
        True,
        True,
        False,
        False,
        True,
    ]


def test_data_loss_needs_a_content_word_nearby(apply):
    texts = ["my photos are all gone", "photos -- deleted", "deleted: photos", "the wifi signal disappeared"]
    intents = [x.intent for x in apply(rules.weak_label, texts)]
    assert intents == ["UNCLEAR", V.INTENTS[2], V.INTENTS[2], "Connectivity"]


def test_pre_purchase_only_without_complaint(apply):
    texts = ["can i buy one", "can i buy one, mine is broken", "how much would applecare cost"]
    assert [x.intent for x in apply(rules.weak_label, texts)] == [V.INTENTS[7], BUG, V.INTENTS[7]]


def test_matched_categories_are_ordered(apply):
    found = apply(rules.matched_intents, ["bluetooth slow, need a refund", "hi"])
    assert found == [["Account, Purchases & Billing", "Connectivity", "Battery & Performance"], []]


@pytest.mark.parametrize(
    ("value", "flag"),
    [
        ("I️ see", True),
        ("a Question Mark shows", True),
        ("autocorrect eats the letter", True),
        ("autocorrect turns 'i' odd", True),
        ("autocorrect is odd", False),
        ("letter", False),
    ],
)
def test_glitch_flag(apply, value, flag):
    assert apply(text.is_glitch, [value]) == [flag]


def test_clean_text_order_of_steps(apply):
    value = "See HTTP://x.co http://y.co/@me @Élan_1 it's 5–6 OK"
    assert apply(text.clean_text, [value])[0].split() == ["see", "http", "x", "co", "it's", "5", "6", "ok"]


def test_keywords_drop_stop_words_and_short_words(apply):
    assert apply(text.keywords, ["The iPhone and my battery is so LOW @apple http://a.b"]) == [["iphone", "battery", "low"]]


def test_truncation_marks_only_longer_texts(apply):
    cut = apply(lambda t: text.truncated(t, 300), ["x" * 300, "x" * 301])
    assert cut == ["x" * 300, "x" * 300 + "…"]


def test_first_customer_line(apply):
    contexts = ["APPLESUPPORT: hi\nCUSTOMER:  help \nCUSTOMER: more", "  no roles here \n"]
    assert apply(text.first_customer_message, contexts) == ["help", "no roles here"]


def test_leading_mention_once(apply):
    assert apply(text.strip_leading_mention, ["  @a @b text", "no mention", "@only"]) == ["@b text", "no mention", ""]


def test_ngrams_after_stop_words(spark):
    df = spark.createDataFrame([("The Battery and the Wi-Fi of I️ x",)], "t string")
    tokens = df.select(text.word_tokens(F.col("t"), ["the", "and", "of"]).alias("k"))
    assert tokens.select(text.ngrams(F.col("k")).alias("n")).first().n == ["battery", "wi", "fi", "battery wi", "wi fi"]
    empty = spark.createDataFrame([("",), ("a",), ("one",)], "t string").select(text.word_tokens(F.col("t"), []).alias("k"))
    assert [r.n for r in empty.select(text.ngrams(F.col("k")).alias("n")).collect()] == [[], [], ["one"]]


def evidence_row(similarity, kind, support="@you do this"):
    return [(similarity, kind, "old ask", support)]


EVIDENCE = "array<struct<similarity_score:double,response_type:string,historical_customer_text:string,historical_support_text:string>>"


def decide(spark, rows):
    schema = f"i int, message string, intent string, evidence {EVIDENCE}, confidence double"
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema).orderBy("i")
    draft = reply.draft_reply(F.col("evidence"))
    decision = reply.decide_handling(F.col("message"), F.col("intent"), F.col("evidence"), draft, F.col("confidence"))
    out = df.select(draft.alias("draft"), decision.alias("d"))
    return [(r.draft, r.d.decision, r.d.reason_code, r.d.reason) for r in out.collect()]


def test_handling_rules_in_order(spark):
    ok = evidence_row(0.5, "direct instruction/link")
    rows = [
        ("hi", "Connectivity", [], 0.9),
        ("hi", "Connectivity", None, 0.9),
        ("hi", "Account, Purchases & Billing", ok, 0.9),
        ("my PassWord", "Connectivity", ok, 0.9),
        ("hi", "Connectivity", ok, 0.24),
        ("hi", "Connectivity", ok, 0.25),
        ("hi", "Connectivity", ok, None),
        ("hi", "Connectivity", evidence_row(0.149, "clarifying question"), 0.9),
        ("hi", "Connectivity", evidence_row(0.15, "clarifying question"), 0.9),
        ("hi", "Connectivity", evidence_row(0.9, "DM handoff"), 0.9),
        ("hi", "Connectivity", evidence_row(0.9, "other/unclear"), 0.9),
        ("hi", "Connectivity", evidence_row(0.299, "confirmation/status"), 0.9),
        ("hi", "Connectivity", evidence_row(0.30, "confirmation/status"), 0.9),
        ("hi", "Connectivity", evidence_row(0.9, "something new"), 0.9),
        ("hi", None, ok, 0.9),
    ]
    got = decide(spark, rows)
    assert [(d, c) for _, d, c, _ in got] == [
        ("ESCALATE", "no_evidence"),
        ("ESCALATE", "no_evidence"),
        ("ESCALATE", "sensitive_intent"),
        ("ESCALATE", "sensitive_keyword"),
        ("ESCALATE", "low_confidence"),
        ("AUTO-HANDLE", "reusable"),
        ("AUTO-HANDLE", "reusable"),
        ("ESCALATE", "weak_similarity"),
        ("AUTO-HANDLE", "clarifying"),
        ("ESCALATE", "private_handoff"),
        ("ESCALATE", "unclear_reply"),
        ("ESCALATE", "weak_reuse"),
        ("AUTO-HANDLE", "reusable"),
        ("ESCALATE", "unknown_type"),
        ("AUTO-HANDLE", "reusable"),
    ]
    assert "is only 0.24 (below 0.25)" in got[4][3]
    assert all(reason for *_, reason in got)


def test_empty_draft_escalates(spark):
    df = spark.createDataFrame([("hi", "x", evidence_row(0.9, "clarifying question"), " ")], f"m string, i string, e {EVIDENCE}, d string")
    decision = reply.decide_handling(F.col("m"), F.col("i"), F.col("e"), F.col("d"))
    assert df.select(decision["reason_code"]).first()[0] == "no_draft"


def test_draft_templates(spark):
    drafts = [
        d
        for d, *_ in decide(
            spark,
            [
                ("m", "i", [], None),
                ("m", "i", evidence_row(0.1, "clarifying question"), None),
                ("m", "i", evidence_row(0.9, "DM handoff"), None),
                ("m", "i", evidence_row(0.9, "clarifying question", "@c Which model?"), None),
                ("m", "i", evidence_row(0.15, "direct instruction/link", "@c Restart it."), None),
            ],
        )
    ]
    assert drafts[0] == V.REPLY_NO_EVIDENCE
    assert drafts[1] == drafts[2] == V.REPLY_PRIVATE
    assert drafts[3] == "Thanks for letting us know. Which model? (Similar cases needed this detail before we could help further.)"
    assert drafts[4] == "Thanks for reaching out! In similar cases we've suggested: Restart it. Let us know if that helps."


def test_plain_reasons_cover_every_code(spark):
    codes = [(c, "ESCALATE") for c in V.PLAIN_REASONS] + [("other", "AUTO-HANDLE"), ("other", "ESCALATE")]
    df = spark.createDataFrame(codes, "c string, d string")
    texts = [r[0] for r in df.select(reply.plain_reason(F.col("c"), F.col("d"))).collect()]
    assert texts == [*V.PLAIN_REASONS.values(), V.PLAIN_FALLBACK["AUTO-HANDLE"], V.PLAIN_FALLBACK["ESCALATE"]]


def test_evidence_summary_and_prompts(spark):
    items = evidence_row(0.5, "DM handoff") + evidence_row(0.25, "other/unclear")
    df = spark.createDataFrame([(items,), ([],)], f"e {EVIDENCE}")
    first, none = [r[0] for r in df.select(reply.evidence_summary(F.col("e"), 1)).collect()]
    assert first == (
        "[1] similarity=0.500 response_type=DM handoff\n    historical customer message: old ask\n"
        "    historical AppleSupport reply: @you do this"
    )
    assert none == V.NO_EVIDENCE_SUMMARY
    prompt = df.select(reply.draft_prompt(F.lit("help"), F.lit("Connectivity"), F.col("e"), "RULES")).first()[0]
    assert prompt.startswith("RULES\n\nNEW CUSTOMER MESSAGE: help\nPREDICTED INTENT: Connectivity\n\nRETRIEVED")
    assert "\n\n[2] similarity=0.250  response_type=other/unclear\n" in prompt
    judged = df.select(reply.judge_prompt(F.lit("m"), F.lit("i"), F.lit("s"), F.lit("d"), 3, "RULES")).first()[0]
    assert judged == "RULES\nCUSTOMER MESSAGE: m\nPREDICTED INTENT: i\n\nRETRIEVED HISTORICAL EVIDENCE (top 3):\ns\n\nDRAFT REPLY: d\n"


@pytest.mark.parametrize(
    ("similarity", "correct", "scores"),
    [
        (0.3, True, (4, 5, 4, 5, 4.5)),
        (0.299, True, (4, 3, 4, 5, 4.0)),
        (0.149, True, (4, 2, 3, 5, 3.5)),
        (0.15, False, (2, 3, 2, 5, 3.0)),
        (0.9, False, (2, 5, 4, 5, 4.0)),
        (None, False, (2, 2, 2, 5, 2.75)),
    ],
)
def test_heuristic_scores_round_half_to_even(spark, similarity, correct, scores):
    df = spark.createDataFrame([(similarity, correct)], "s double, c boolean")
    columns = heuristic_scores(F.col("s"), F.col("c"))
    assert tuple(df.select(*[c.alias(n) for n, c in columns.items()]).first()) == scores


def test_patterns_agree_with_their_plain_regular_expressions(spark):
    """Searched in parts, every pattern finds what the whole expression with spelled-out boundaries finds."""
    from threadwright.functions import patterns

    def whole(pattern):
        edge = rf"(?:(?<={patterns.WORD})(?!{patterns.WORD})|(?<!{patterns.WORD})(?={patterns.WORD}))"
        return pattern.replace(r"\b", edge).replace(r"\w", patterns.WORD).replace(r"\W", patterns.NON_WORD)

    words = ["lag", "slag", "lags", "élag", "_lag", "lag️", "slow-fix", "can't", "cant", "cant_", "apple  id", "appleid", "log in"]
    words += ["photo... gone", "vanished: my notes", "https://t.co", "glad to hear", "contact us at", "how much is it, the price", "a|b", "", None]
    rules_of = [*V.ISSUE_TAGS.values(), *V.REPLY_PATTERNS.values(), *(r[1] for r in V.PRIORITY_RULES), V.SPECIFIC_BUG, V.PRE_PURCHASE, V.COMPLAINT]
    rules_of += [r"\bissues?\b", r"x\b|\by", r"[a|b]c|\\\||(?:s|t)lag"]
    df = spark.createDataFrame([(w,) for w in words + CUSTOMER_PHRASES + SUPPORT_PHRASES], "t string")
    for row in df.select("t", *[F.array(matches(F.lower("t"), p), F.lower("t").rlike(whole(p))).alias(str(i)) for i, p in enumerate(rules_of)]).collect():
        for i, p in enumerate(rules_of):
            assert row[str(i)][0] == row[str(i)][1], (row.t, p)


def test_plain_alternatives_and_boundaries_cost_no_search_at_every_position(spark):
    from threadwright.functions import patterns

    assert patterns.java_pattern(r"\blag\b").startswith("lag(?<!")
    assert patterns.alternatives(r"a|(?:b|c)d|[|]|\|") == ["a", "(?:b|c)d", "[|]", r"\|"]
    plan = spark.range(1).select(matches(F.col("id").cast("string"), "wifi|hotspot"))._jdf.queryExecution().analyzed().toString()
    assert "RLIKE" not in plan.upper()


def test_clean_text_keeps_and_drops_the_same_characters_by_ranges(spark):
    """Every character up to U+3000 and some beyond, against the class that says which ones stay."""
    codes = [c for c in [*range(1, 0x3000), 0xFE0F, 0xFFFD, 0x1F600, 0x10FFFF] if chr(c) != "@"]
    df = spark.createDataFrame([(c, f"a{chr(c)}b") for c in codes], "c int, t string")
    same = text.clean_text(F.col("t")) == F.regexp_replace(F.lower("t"), r"[^a-z0-9'\s]", " ")
    assert df.filter(~same).count() == 0
    assert "^" not in text._NOT_KEPT

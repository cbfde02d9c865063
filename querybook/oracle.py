"""SQL building blocks of the checking queries (one dialect for all: DuckDB)."""

from __future__ import annotations

import re

from threadwright.functions import vocab as V
from threadwright.sources.fixtures import CUSTOMER_PHRASES, SUPPORT_PHRASES

from .tables import BRAND, INTENT_OF_TOPIC

WORD = r"[\p{L}\p{N}_]"
BLANKS = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listed(values) -> str:
    return ", ".join(q(v) for v in values)


def strip(x: str) -> str:
    return f"trim({x}, {BLANKS})"


def re2(pattern: str) -> str:
    """Spell word boundaries as consuming classes; fine for yes/no matching."""
    left, right = r"(?:^|[^\p{L}\p{N}_])", r"(?:$|[^\p{L}\p{N}_])"
    out = re.sub(r"\\b(?=\w)", lambda _: left, pattern)
    out = out.replace(r"\b", right)
    return out.replace(r"\w", WORD).replace(r"\W", r"[^\p{L}\p{N}_]")


def matches(text: str, pattern: str) -> str:
    return f"regexp_matches({text}, {q(re2(pattern))})"


def case(branches, otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in branches) + f" ELSE {otherwise} END"


def mapped(key: str, mapping: dict[str, str], default: str = "NULL") -> str:
    return f"CASE {key} " + " ".join(f"WHEN {q(a)} THEN {q(b)}" for a, b in mapping.items()) + f" ELSE {default} END"


def pick(values: list[str], index: str) -> str:
    return f"([{listed(values)}])[{index} + 1]"


def glitch(text: str) -> str:
    low = f"lower({text})"
    letter = f"(contains({low}, 'letter') OR contains({low}, '\"i\"') OR contains({low}, '''i'''))"
    return (
        f"(contains({text}, chr(65039)) OR contains({low}, 'question mark') "
        f"OR (contains({low}, 'autocorrect') AND {letter}))"
    )


def reply_class(text: str) -> str:
    branches = [(matches(f"lower({text})", p), q(name)) for name, p in V.REPLY_PATTERNS.items()]
    branches.append((f"contains({text}, '?')", "'clarifying_question'"))
    return case(branches, "'unclear_no_observable_resolution'")


def topic(text: str) -> str:
    return case([(matches(f"lower({text})", p), q(name)) for name, p in V.TOPIC_BUCKETS], q(V.TOPIC_OTHER))


def topic_intent(text: str) -> str:
    return mapped(topic(text), INTENT_OF_TOPIC)


def weak(text: str, part: int) -> str:
    """Rule label of a text: part 0 intent, 1 note, 2 confidence."""
    low = f"lower({text})"
    bug = "Software / App Bug Report"
    complaint = matches(low, V.COMPLAINT)
    rules = [(glitch(text), (bug, V.NOTE_GLITCH, "high"))]
    rules += [(matches(low, p), (name, note, conf)) for name, p, note, conf in V.PRIORITY_RULES]
    rules += [
        (matches(low, V.SPECIFIC_BUG), (bug, V.NOTE_SPECIFIC_BUG, "medium")),
        (
            f"({matches(low, V.PRE_PURCHASE)} AND NOT {complaint})",
            ("General / Pre-Purchase Inquiry", V.NOTE_PRE_PURCHASE, "medium"),
        ),
        (complaint, (bug, V.NOTE_COMPLAINT, "low")),
    ]
    other = ("UNCLEAR", V.NOTE_UNCLEAR, "none")
    return case([(c, q(v[part])) for c, v in rules], q(other[part]))


def matched_count(text: str) -> str:
    return " + ".join(f"CAST({matches(f'lower({text})', p)} AS INT)" for _, p, _, _ in V.PRIORITY_RULES)


FLAT = "replace(coalesce({0}, ''), chr(10), ' ')"
TIME = "ts ASC NULLS LAST, tweet_id"


def flat(x: str) -> str:
    return FLAT.format(x)


def cut(x: str, n: int) -> str:
    return f"CASE WHEN length({x}) > {n} THEN substr({x}, 1, {n}) || '…' ELSE {x} END"


def tfidf(prefix: str, docs: str, min_df: int = 2, queries: str | None = None) -> dict[str, str]:
    """CTEs for normalised postings of ``docs(id, text)`` and, optionally, ``queries(id, text)``."""

    def terms(source: str) -> str:
        tokens = f"[x for x in regexp_extract_all(lower(text), '{WORD}{{2,}}') if x NOT IN ({listed(V.ENGLISH_STOP_WORDS)})]"
        return (
            f"SELECT id, unnest(list_concat(tok, [tok[i] || ' ' || tok[i + 1] for i in range(1, len(tok))])) AS term "
            f"FROM (SELECT id, {tokens} AS tok FROM {source})"
        )

    def weights(tf: str, vocabulary: str) -> str:
        return (
            f"SELECT id, term, x / sqrt(sum(x * x) OVER (PARTITION BY id)) AS w "
            f"FROM (SELECT t.id, t.term, t.tf * v.idf AS x FROM {tf} t JOIN {vocabulary} v USING (term))"
        )

    out = {
        f"{prefix}_tf": f"SELECT id, term, count(*) AS tf FROM ({terms(docs)}) GROUP BY ALL",
        f"{prefix}_vocab": (
            f"SELECT term, count(*) AS df, ln((1.0 + (SELECT count(*) FROM {docs})) / (1.0 + count(*))) + 1.0 AS idf "
            f"FROM {prefix}_tf GROUP BY term HAVING count(*) >= {min_df}"
        ),
        f"{prefix}_w": weights(f"{prefix}_tf", f"{prefix}_vocab"),
    }
    if queries:
        out[f"{prefix}_qtf"] = f"SELECT id, term, count(*) AS tf FROM ({terms(queries)}) GROUP BY ALL"
        out[f"{prefix}_qw"] = weights(f"{prefix}_qtf", f"{prefix}_vocab")
    return out


def ranked(prefix: str, docs: str, queries: str, k: int, boost: float = V.INTENT_BOOST, own: bool = False) -> dict[str, str]:
    """Exhaustive ranking of every document for every query; docs and queries carry an intent."""
    skip = "WHERE d.id <> q.id" if own else ""
    return {
        f"{prefix}_sim": (
            f"SELECT a.id AS qid, b.id AS did, round(sum(a.w * b.w), 9) AS s FROM {prefix}_qw a "
            f"JOIN {prefix}_w b USING (term) GROUP BY ALL"
        ),
        f"{prefix}_hits": (
            "SELECT * FROM (SELECT q.id AS query_id, d.id AS doc_id, d.intent, coalesce(s.s, 0.0) AS similarity, "
            "row_number() OVER (PARTITION BY q.id ORDER BY round(coalesce(s.s, 0.0) + "
            f"CASE WHEN d.intent = q.intent THEN CAST({boost} AS DOUBLE) ELSE 0.0 END, 9) DESC, d.id) AS rank "
            f"FROM {queries} q CROSS JOIN {docs} d LEFT JOIN {prefix}_sim s ON s.qid = q.id AND s.did = d.id {skip}) "
            f"WHERE rank <= {k}"
        ),
    }


_CUSTOMERS = ", ".join(f"({i}, {q(t.replace(V.GLITCH_MARK, '<VS>'))})" for i, t in enumerate(CUSTOMER_PHRASES))
_SUPPORTS = ", ".join(f"({i}, {q(t)})" for i, t in enumerate(SUPPORT_PHRASES))

CTES: dict[str, str] = {
    "e": (
        "SELECT event_id, user_id, ts, 2 + user_id % 5 AS sz, "
        "row_number() OVER w - 1 AS rn, lag(event_id) OVER w AS pv, lead(event_id) OVER w AS nx "
        "FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"
    ),
    "ch": (
        "SELECT *, rn % sz AS turn, rn // sz AS chunk, CASE WHEN rn % sz > 0 THEN pv END AS prev, "
        "CASE WHEN rn % sz + 1 < sz THEN nx END AS next FROM e"
    ),
    "cp": f"SELECT i, replace(tx, '<VS>', chr(65039)) AS tx FROM (VALUES {_CUSTOMERS}) v(i, tx)",
    "sp": f"SELECT * FROM (VALUES {_SUPPORTS}) v(i, tx)",
    "raw": (
        "SELECT CAST(event_id AS VARCHAR) AS tweet_id, "
        "CASE WHEN turn % 2 = 0 OR event_id % 211 = 0 THEN 'cust' || user_id ELSE 'Brand' || ((user_id + chunk) % 6) END AS author_id, "
        "CASE WHEN turn % 2 = 0 THEN 'True' ELSE 'False' END AS inbound, "
        "CASE WHEN event_id % 103 = 0 THEN NULL WHEN event_id % 101 = 0 THEN 'not a date' "
        "ELSE strftime(ts, '%a %b %d %H:%M:%S +0000 %Y') END AS created_at, "
        "CASE WHEN event_id % 307 = 0 THEN '   ' ELSE (CASE WHEN turn % 2 = 0 THEN cp.tx ELSE sp.tx END) || "
        "(CASE WHEN event_id % 29 = 0 THEN chr(10) || 'more below' WHEN event_id % 61 = 0 THEN repeat(' and so on', 40) ELSE '' END) END AS text, "
        "CASE WHEN event_id % 53 = 0 THEN concat_ws(',', next, event_id + 2000000000) ELSE CAST(next AS VARCHAR) END AS response_tweet_id, "
        "CASE WHEN turn = 0 AND event_id % 97 = 0 THEN CAST(event_id + 1000000000 AS VARCHAR) "
        "WHEN turn = 0 AND event_id % 89 = 0 THEN 'n/a' ELSE CAST(prev AS VARCHAR) END AS in_response_to_tweet_id "
        "FROM ch JOIN cp ON cp.i = event_id % 16 JOIN sp ON sp.i = event_id % 8"
    ),
    "m": (
        "SELECT TRY_CAST(tweet_id AS BIGINT) AS tweet_id, author_id, inbound, inbound = 'True' AS is_customer, "
        "inbound = 'False' AS is_support, created_at, "
        "try_strptime(replace(substr(created_at, 5), ' +0000', ''), '%b %d %H:%M:%S %Y') AS ts, text, response_tweet_id, "
        "TRY_CAST(in_response_to_tweet_id AS BIGINT) AS parent_id FROM raw"
    ),
    "par": (
        "SELECT a.tweet_id, coalesce(b.tweet_id, a.tweet_id) AS parent, "
        "a.parent_id IS NOT NULL AND b.tweet_id IS NULL AS dangling FROM m a LEFT JOIN m b ON a.parent_id = b.tweet_id"
    ),
    "up": (
        "SELECT tweet_id, tweet_id AS root FROM par WHERE parent = tweet_id UNION ALL "
        "SELECT par.tweet_id, up.root FROM par JOIN up ON par.parent = up.tweet_id WHERE par.parent <> par.tweet_id"
    ),
    "t": "SELECT m.*, up.root, par.dangling FROM m JOIN up USING (tweet_id) JOIN par USING (tweet_id)",
    "st": (
        "SELECT root, count(*) AS size, count(*) FILTER (is_support) AS n_support, "
        "count(*) FILTER (is_customer) AS n_customer, "
        f"(array_agg(author_id ORDER BY {TIME}) FILTER (is_support))[1] AS brand, "
        "count(DISTINCT author_id) FILTER (is_support) AS n_distinct_brands FROM t GROUP BY root"
    ),
    "fc": (
        f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY root ORDER BY {TIME}) AS k FROM t WHERE is_customer) WHERE k = 1"
    ),
    "op": "SELECT tweet_id, coalesce(text, '') AS text FROM fc",
    "silver": f"SELECT tweet_id, {weak('text', 0)} AS intent, {weak('text', 1)} AS note, {weak('text', 2)} AS confidence FROM op",
    "reply": (
        "SELECT root, tweet_id AS reply_id, ts, text AS support_text FROM (SELECT s.*, row_number() OVER (PARTITION BY s.root "
        "ORDER BY coalesce(s.ts > fc.ts, FALSE) DESC, s.ts ASC NULLS LAST, s.tweet_id) AS k "
        "FROM t s JOIN fc ON fc.root = s.root WHERE s.is_support) WHERE k = 1"
    ),
    "corpus": (
        f"SELECT fc.tweet_id, fc.root, e1.first_id AS thread_root_tweet_id, {flat('fc.text')} AS customer_text, "
        f"{flat('reply.support_text')} AS support_text, "
        + mapped(reply_class("coalesce(reply.support_text, '')"), V.RESPONSE_TYPE_OF_CLASS)
        + " AS response_type, nullif(silver.intent, 'UNCLEAR') AS intent "
        "FROM st JOIN fc USING (root) JOIN reply USING (root) "
        f"JOIN (SELECT root, (array_agg(tweet_id ORDER BY {TIME}))[1] AS first_id FROM t GROUP BY root) e1 USING (root) "
        f"LEFT JOIN silver ON silver.tweet_id = fc.tweet_id WHERE st.brand = '{BRAND}'"
    ),
    "ctx": (
        "SELECT root, string_agg(line, chr(10) ORDER BY rn) FILTER (rn <= 10) || "
        "CASE WHEN max(rn) > 10 THEN ' [thread truncated]' ELSE '' END AS conversation_context FROM ("
        f"SELECT root, row_number() OVER (PARTITION BY root ORDER BY {TIME}) AS rn, "
        f"CASE WHEN is_support THEN 'APPLESUPPORT' ELSE 'CUSTOMER' END || ': ' || ({cut(flat('text'), 300)}) AS line FROM t) "
        "GROUP BY root"
    ),
    "sheet": (
        "SELECT fc.root, fc.tweet_id, f.first_id AS thread_root_tweet_id, st.size AS thread_size, "
        "st.n_customer AS num_customer_messages, st.n_support AS num_support_messages, fc.created_at, "
        f"{flat('fc.text')} AS customer_text, ctx.conversation_context, '' AS intent, '' AS labeling_notes "
        "FROM fc JOIN st USING (root) JOIN ctx USING (root) "
        f"JOIN (SELECT root, (array_agg(tweet_id ORDER BY {TIME}))[1] AS first_id FROM t GROUP BY root) f USING (root)"
    ),
    "pred": (
        "SELECT *, golden_intent = predicted_intent AS intent_correct, golden_handling = predicted_handling AS handling_correct, "
        "golden_behavior = predicted_response_behavior AS behavior_correct FROM ("
        f"SELECT tweet_id, text, {weak('text', 0)} AS golden_intent, "
        f"CASE WHEN tweet_id % 11 = 0 THEN 'Software / App Bug Report' ELSE {topic_intent('text')} END AS predicted_intent, "
        "CASE WHEN tweet_id % 3 = 0 THEN 'AUTO-HANDLE' ELSE 'ESCALATE' END AS golden_handling, "
        "CASE WHEN tweet_id % 5 < 2 THEN 'AUTO-HANDLE' ELSE 'ESCALATE' END AS predicted_handling, "
        f"{pick(V.BEHAVIORS, 'tweet_id % 6')} AS golden_behavior, "
        f"{pick(V.BEHAVIORS, 'tweet_id // 2 % 6')} AS predicted_response_behavior, "
        "CAST(tweet_id % 50 AS DOUBLE) / 50.0 AS top_similarity, "
        "CAST(tweet_id % 40 AS DOUBLE) / 80.0 + 0.1 AS confidence FROM op)"
    ),
    "scored": (
        "SELECT *, round_even((CAST(relevance AS DOUBLE) + groundedness + helpfulness + safety) / 4, 2) AS overall FROM ("
        "SELECT *, CAST(round_even((groundedness + relevance) / 2.0, 0) AS BIGINT) AS helpfulness, CAST(5 AS BIGINT) AS safety FROM ("
        "SELECT *, CASE WHEN behavior_correct THEN 4 ELSE 2 END AS relevance, "
        "CASE WHEN top_similarity >= 0.30::DOUBLE THEN 5 WHEN top_similarity >= 0.15::DOUBLE THEN 3 ELSE 2 END AS groundedness, "
        "1 + tweet_id * 7 % 5 AS human_relevance, 1 + tweet_id * 11 % 5 AS human_groundedness, "
        "1 + tweet_id * 13 % 5 AS human_helpfulness, 5 AS human_safety FROM pred))"
    ),
    "golden": (
        "SELECT tweet_id, CASE WHEN tweet_id % 7 = 0 THEN golden_intent ELSE '' END AS intent, "
        "CASE WHEN tweet_id % 7 = 0 THEN golden_behavior ELSE '' END AS expected_response_behavior, "
        "CASE WHEN tweet_id % 7 = 0 THEN golden_handling ELSE '' END AS expected_handling, "
        "CASE WHEN tweet_id % 7 = 0 THEN 'by hand' ELSE '' END AS labeling_notes FROM pred"
    ),
    "review": (
        "SELECT tweet_id, predicted_intent AS proposed_intent, predicted_response_behavior AS proposed_response_behavior, "
        "predicted_handling AS proposed_handling, 'similar to ' || predicted_intent AS labeling_reason, "
        "CASE WHEN tweet_id % 5 = 0 THEN golden_intent ELSE '' END AS approved_intent, "
        "CASE WHEN tweet_id % 5 = 0 THEN golden_behavior ELSE '' END AS approved_response_behavior, "
        "CASE WHEN tweet_id % 5 = 0 THEN golden_handling ELSE '' END AS approved_handling, "
        "CASE WHEN tweet_id % 5 = 0 THEN 'checked' ELSE '' END AS labeling_notes FROM pred"
    ),
    "bm": (
        "SELECT a.author_id AS brand, coalesce(b.n_threads, 0) AS n_threads, a.support_tweets, "
        "CAST(coalesce(b.support_tweets_in_threads, 0) AS BIGINT) AS support_tweets_in_threads, "
        "CAST(coalesce(b.customer_tweets_in_threads, 0) AS BIGINT) AS customer_tweets_in_threads, "
        "CAST(coalesce(b.total_tweets_in_threads, 0) AS BIGINT) AS total_tweets_in_threads, "
        "coalesce(b.resolution_pairs, 0) AS resolution_pairs, coalesce(b.median_len, 0.0) AS median_len, "
        "coalesce(b.mean_len, 0.0) AS mean_len, coalesce(b.pct_2plus, 0.0) AS pct_2plus, coalesce(b.pct_3plus, 0.0) AS pct_3plus, "
        "coalesce(b.pct_4plus, 0.0) AS pct_4plus, coalesce(b.max_len, 0) AS max_len, coalesce(b.isolated_pct, 0.0) AS isolated_pct, "
        "coalesce(b.multi_brand_thread_pct, 0.0) AS multi_brand_thread_pct, a.dangling_pct FROM "
        "(SELECT author_id, count(*) FILTER (is_support) AS support_tweets, avg(CAST(dangling AS INT)) * 100 AS dangling_pct FROM t GROUP BY author_id) a "
        "LEFT JOIN (SELECT brand, count(*) AS n_threads, sum(n_support) AS support_tweets_in_threads, sum(n_customer) AS customer_tweets_in_threads, "
        "sum(size) AS total_tweets_in_threads, count(*) FILTER (n_customer > 0) AS resolution_pairs, quantile_cont(size, 0.5) AS median_len, "
        "avg(size) AS mean_len, avg(CAST(size >= 2 AS INT)) * 100 AS pct_2plus, avg(CAST(size >= 3 AS INT)) * 100 AS pct_3plus, "
        "avg(CAST(size >= 4 AS INT)) * 100 AS pct_4plus, max(size) AS max_len, avg(CAST(size = 1 AS INT)) * 100 AS isolated_pct, "
        "avg(CAST(n_distinct_brands > 1 AS INT)) * 100 AS multi_brand_thread_pct FROM st GROUP BY brand) b ON a.author_id = b.brand "
        "WHERE a.support_tweets > 0"
    ),
}


def compose(final: str, extra: dict[str, str] | None = None) -> str:
    """``final`` preceded by exactly the CTEs it needs, in dependency order."""
    known = {**CTES, **(extra or {})}

    def uses(sql: str) -> list[str]:
        bare = re.sub(r"'(?:[^']|'')*'", "''", sql)
        relations = re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", bare)
        return [r for r in dict.fromkeys(relations) if r in known]

    order: list[str] = []

    def visit(name: str, trail: tuple = ()) -> None:
        if name in order or name in trail:
            return
        for other in uses(known[name]):
            visit(other, (*trail, name))
        order.append(name)

    for name in uses(final):
        visit(name)
    if not order:
        return final
    parts = [f"{n} AS ({known[n]})" if n == "up" else f"{n} AS MATERIALIZED ({known[n]})" for n in order]
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + final

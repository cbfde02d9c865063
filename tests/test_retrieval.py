"""Index and search against a brute-force ranking in plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from threadwright.operators import retrieval

STOPS = ["the", "and"]
WORDS = "battery wifi screen update slow phone refund music".split()


def brute_terms(text):
    tokens = [t for t in re.findall(r"\w{2,}", text.lower()) if t not in STOPS]
    return Counter(tokens + [f"{a} {b}" for a, b in zip(tokens, tokens[1:])])


def brute_vectors(docs, queries, min_df=2):
    counts = {i: brute_terms(t) for i, t in docs.items()}
    df = Counter(t for c in counts.values() for t in c)
    idf = {t: math.log((1 + len(docs)) / (1 + n)) + 1 for t, n in df.items() if n >= min_df}

    def unit(c):
        x = {t: n * idf[t] for t, n in c.items() if t in idf}
        norm = math.sqrt(sum(v * v for v in x.values()))
        return {t: v / norm for t, v in x.items()}

    return {i: unit(c) for i, c in counts.items()}, {q: unit(brute_terms(t)) for q, t in queries.items()}


def brute_rank(docs, intents, queries, asked, k, boost=0.05, own=None):
    vectors, wanted = brute_vectors(docs, queries)
    out = []
    for q, qv in wanted.items():
        scored = []
        for d, dv in vectors.items():
            if own and own[q] == d:
                continue
            s = round(sum(w * dv.get(t, 0.0) for t, w in qv.items()), 9)
            bonus = boost if intents[d] is not None and intents[d] == asked[q] else 0.0
            scored.append((-round(s + bonus, 9), d, s))
        out += [(q, r, d, round(s, 6)) for r, (_, d, s) in enumerate(sorted(scored)[:k], start=1)]
    return sorted(out)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(3)
    docs = {i: " ".join(rng.choices(WORDS, k=rng.randint(1, 5))) for i in range(60)}
    docs.update({i: "the battery and wifi" for i in range(60, 90)})  # a third are copies
    docs[90] = ""
    intents = {i: (None if i % 3 else f"t{i % 2}") for i in docs}
    rows = [(i, t, intents[i]) for i, t in docs.items()]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, intent string")
    return df, docs, intents


QUERIES = {
    1: "battery wifi",
    2: "battery wifi",
    3: "slow phone after the update",
    4: "nothing known here",
    5: "",
    6: "music refund music",
}
ASKED = {1: "t0", 2: None, 3: "t1", 4: "t0", 5: None, 6: None}


def ask(spark, own=None):
    rows = [(q, t, ASKED[q], (own or {}).get(q)) for q, t in QUERIES.items()]
    return spark.createDataFrame(rows, "query_id bigint, text string, intent string, own bigint")


def result(df):
    return sorted((r.query_id, r["rank"], r.doc_id, round(r.similarity, 6)) for r in df.collect())


@pytest.fixture(scope="module")
def index(corpus):
    return retrieval.build_index(corpus[0], "doc_id", "text", "intent", stop_words=STOPS)


@pytest.mark.parametrize("broadcast", ["10m", "-1"], ids=["small-sides-travel", "joined-by-term"])
def test_boosted_search_equals_brute_force(spark, corpus, broadcast):
    df, docs, intents = corpus
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        index = retrieval.build_index(df, "doc_id", "text", "intent", stop_words=STOPS)
        got = result(retrieval.retrieve(ask(spark), index, 5, intent_col="intent"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == brute_rank(docs, intents, QUERIES, ASKED, 5)


def test_own_document_is_left_out(spark, corpus, index):
    _, docs, intents = corpus
    own = {1: 60, 2: 61, 3: 5, 4: 0, 5: 0, 6: 7}
    got = result(retrieval.retrieve(ask(spark, own), index, 5, intent_col="intent", own_doc_col="own"))
    assert got == brute_rank(docs, intents, QUERIES, ASKED, 5, own=own)


def test_plan_does_not_grow_with_the_queries(spark, index):
    def nodes(n):
        asked = spark.range(n).selectExpr("id AS query_id", "concat('update battery word', id) AS text")
        return retrieval.retrieve(asked, index, 3, pad=False)._jdf.queryExecution().analyzed().toString().count("\n")

    assert nodes(3) == nodes(3000)


def test_no_boost_and_no_intent_are_the_same(spark, index):
    plain = result(retrieval.retrieve(ask(spark), index, 5))
    assert result(retrieval.retrieve(ask(spark), index, 5, intent_col="intent", boost=0.0)) == plain


def test_without_padding_only_matches_return(spark, index):
    hits = retrieval.retrieve(ask(spark), index, 5, pad=False).collect()
    assert all(h.similarity > 0 for h in hits) and {h.query_id for h in hits} == {1, 2, 3, 6}


def test_k_is_limited_by_the_index(spark, index):
    with pytest.raises(ValueError):
        retrieval.retrieve(ask(spark), index, 6)


def test_postings_equal_brute_force(corpus):
    df, docs, _ = corpus
    table = retrieval.tfidf_postings(df, "doc_id", "text", STOPS)
    got = {(r.doc_id, r.term): round(r.w, 9) for r in table.collect()}
    vectors, _ = brute_vectors(docs, {})
    assert got == {(d, t): round(w, 9) for d, v in vectors.items() for t, w in v.items()}


def test_search_limits_before_the_shuffle(spark, index):
    plan = retrieval.retrieve(ask(spark), index, 3, pad=False)._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "WindowGroupLimit" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_evidence_is_ordered(spark, corpus, index):
    payload = corpus[0].select(
        F.col("doc_id").alias("tweet_id"),
        F.col("doc_id").alias("thread_root_tweet_id"),
        F.col("text").alias("customer_text"),
        F.lit("reply").alias("support_text"),
        F.lit("DM handoff").alias("response_type"),
    )
    rows = retrieval.evidence(retrieval.retrieve(ask(spark), index, 4), payload).collect()
    assert len(rows) == 6
    for row in rows:
        assert [e["rank"] for e in row.evidence] == [1, 2, 3, 4]
        assert [e.similarity_score for e in row.evidence] == sorted((e.similarity_score for e in row.evidence), reverse=True)


def test_pruned_search_of_many_texts_equals_brute_force(spark):
    """Rare words decide, one word is in every text: pruning must drop work but no result."""
    rng = random.Random(11)
    rare = [f"rare{i}" for i in range(40)]
    docs = {i: " ".join(["update", *rng.choices(WORDS, k=3), *rng.choices(rare, k=2)]) for i in range(400)}
    df = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")
    index = retrieval.build_index(df, "doc_id", "text", stop_words=STOPS)
    queries = {q: " ".join(["update", *rng.choices(WORDS, k=2), *rng.choices(rare, k=2)]) for q in range(25)}
    queries[99] = "update"
    asked = spark.createDataFrame(list(queries.items()), "query_id bigint, text string")
    want = brute_rank(docs, dict.fromkeys(docs), queries, dict.fromkeys(queries), 5)
    assert result(retrieval.retrieve(asked, index, 5)) == want
    weights = retrieval.query_postings(asked.select(F.col("query_id").alias("q"), "text"), index)
    plan = retrieval.search_plan(weights, index, 0.0, 5)
    dropped = plan.filter("NOT essential").select("term").distinct().collect()
    assert "update" in {r.term for r in dropped}


def test_vocabulary_part_of_a_term_does_not_depend_on_its_place():
    """A term that two blocks dealt to different parts would count twice, each time with too small a frequency."""
    import pyarrow as pa

    from threadwright.operators.postings import _dictionary_order

    terms = ["ab", "abc", "wifi screen", "slow phone after", "update", "ä", "12345678", "refund music"]
    parts = []
    for shown in (terms, terms[::-1], terms[3:] + terms[:3]):
        order, part = _dictionary_order(pa.array(shown, pa.large_string()), 5)
        assert sorted(order.tolist()) == list(range(len(terms))) and (part[order][1:] >= part[order][:-1]).all()
        parts.append(dict(zip(shown, part.tolist())))
    assert parts[0] == parts[1] == parts[2]


def test_index_moves_no_postings(spark, corpus):
    """Only texts and the dictionaries of blocks are shuffled; weights are worked out where the counts lie."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = retrieval.tfidf_postings(corpus[0], "doc_id", "text", STOPS)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange hashpartitioning" not in plan


def test_rows_of_one_id_are_one_text(spark):
    """Repeated ids: their words count together, and a row that comes twice is a copy in the index."""
    rows = [(1, "battery wifi"), (1, "battery wifi"), (2, "battery slow"), (3, None), (4, "battery wifi")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r.doc_id, r.term): r.w for r in retrieval.tfidf_postings(df, "doc_id", "text", STOPS).collect()}
    assert set(got) == {(1, "battery"), (1, "wifi"), (1, "battery wifi"), (2, "battery"), (4, "battery"), (4, "wifi"), (4, "battery wifi")}
    index = retrieval.build_index(df, "doc_id", "text", stop_words=STOPS)
    found = {r.term: r.df for r in index.statistics.vocabulary.collect()}
    assert found == {"battery": 4, "wifi": 3, "battery wifi": 3}

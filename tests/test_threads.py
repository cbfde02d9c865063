from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from threadwright.operators import context, corpus, threads
from threadwright.sources.staging import new_path


def roots_of(df, **options):
    return {r.tweet_id: r.root for r in threads.thread_roots(df, **options).collect()}


def test_branching_dangling_and_foreign_parents(messages):
    df = messages(
        [
            (1, None, "a", "c", 1, "x"),
            (2, 1, "B", "s", 2, "x"),
            (3, 1, "B", "s", 3, "x"),
            (4, 2, "a", "c", 4, "x"),
            (5, 3, "a", "c", 5, "x"),
            (6, 999, "a", "c", 6, "x"),
            (7, "n/a", "a", "c", 7, "x"),
            (8, 6, "B", "s", 8, "x"),
        ]
    )
    rows = {r.tweet_id: (r.root, r.dangling) for r in threads.thread_roots(df).collect()}
    assert rows == {
        1: (1, False),
        2: (1, False),
        3: (1, False),
        4: (1, False),
        5: (1, False),
        6: (6, True),
        7: (7, False),
        8: (6, False),
    }


def links(spark, pairs):
    return spark.createDataFrame(pairs, "tweet_id bigint, parent_id bigint")


def test_deep_chain_takes_few_rounds(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(threads, "new_path", lambda s, name: rounds.append(name) or new_path(s, name))
    df = links(spark, [(i, i - 1 if i else None) for i in range(300)])
    assert set(roots_of(df).values()) == {0} and len(rounds) <= 10


def test_cycle_leaves_other_threads_alone(spark):
    cycle = [(1, 2), (2, 1), (5, 1), (6, 5), (9, 9)]
    chain = [(i, i - 1 if i > 100 else None) for i in range(100, 140)]
    found = {r.tweet_id: (r.root, r.dangling) for r in threads.thread_roots(links(spark, [*cycle, (3, None), (4, 3), *chain])).collect()}
    assert all(found[i] == (i, True) for i in (1, 2, 5, 6))
    assert found[9] == (9, False) and found[3] == found[4] == (3, False)
    assert all(found[i] == (100, False) for i in range(100, 140))


def test_pointers_are_looked_up_without_an_exchange(spark):
    active = links(spark, [(i, i - 1) for i in range(1, 50)]).withColumnRenamed("parent_id", "ptr")
    pointers = spark.range(50).selectExpr("id AS ptr", "greatest(id - 1, 0) AS next", "id = 0 AS settled")
    table = threads.store_pointers(pointers, active)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = threads.jump(active, table)._jdf.queryExecution().sparkPlan().toString()
        done = threads.jump(active, table)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and done.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in done
    assert table.count() == 49  # nobody points to the last one


def test_pointers_shrink_from_round_to_round(spark, monkeypatch):
    sizes, store = [], threads.store_pointers

    def counted(pointers, active):
        table = store(pointers, active)
        sizes.append(table.count())
        return table

    monkeypatch.setattr(threads, "store_pointers", counted)
    pairs = [(i, i - 1 if i else None) for i in range(200)] + [(1000 + i, 500) for i in range(300)] + [(500, None)]
    assert set(roots_of(links(spark, pairs)).values()) == {0, 500}
    # rows with a descendant 1, 2, 4, ... steps below: the star leaves after the first round
    assert sizes == [200, *(200 - 2**k for k in range(1, 8))]


@pytest.mark.parametrize("hot_rows", [1_000_000, 5])
def test_random_forest_equals_walk(spark, hot_rows):
    rng = random.Random(7)
    parent = {0: None}
    for i in range(1, 400):
        # a third of all rows answer message 0
        parent[i] = 0 if rng.random() < 0.33 else rng.choice([None, rng.randrange(i), 10_000 + i])
    def walk(i):
        p = parent[i]
        return i if p is None or p not in parent else walk(p)
    assert roots_of(links(spark, list(parent.items())), hot_rows=hot_rows) == {i: walk(i) for i in parent}


def test_stats_and_first_brand_by_time(messages):
    df = messages(
        [
            (1, None, "a", "c", 10, "x"),
            (3, 1, "Late", "s", 30, "x"),
            (2, 1, "Early", "s", 20, "x"),
            (4, 1, "NoTime", "s", None, "x"),
            (5, None, "Alone", "s", 5, "x"),
        ]
    )
    built = threads.build_threads(df)
    stats = {r.root: r for r in threads.thread_stats(built.rows).collect()}
    assert (stats[1].size, stats[1].n_support, stats[1].n_customer) == (4, 3, 1)
    assert (stats[1].brand, stats[1].n_distinct_brands) == ("Early", 3)
    assert (stats[5].n_customer, stats[5].brand) == (0, "Alone")


def test_hot_roots_are_found_and_used(messages):
    rows = [(1, None, "a", "c", 1, "ask")] + [(i, 1, "B", "s", i, f"answer {i}") for i in range(2, 40)]
    built = threads.build_threads(messages(rows), hot_rows=10)
    assert built.hot_roots == (1,)
    plain = corpus.first_reply_after(built.rows).collect()
    assert corpus.first_reply_after(built.rows, built.hot_roots).collect() == plain
    assert plain[0].support_text == "answer 2"


def test_reply_is_strictly_later_else_first(messages):
    df = messages(
        [
            (1, None, "B", "s", 5, "before"),
            (2, 1, "a", "c", 10, "ask"),
            (3, 2, "B", "s", 10, "same second"),
            (4, 3, "B", "s", 11, "after"),
            (11, None, "a", "c", 50, "ask"),
            (12, 11, "B", "s", 40, "earlier"),
            (13, 11, "B", "s", 45, "still earlier than the question"),
            (21, None, "a", "c", None, "no time"),
            (22, 21, "B", "s", 7, "first"),
        ]
    )
    rows = threads.build_threads(df).rows
    replies = {r.root: r.support_text for r in corpus.first_reply_after(rows).collect()}
    assert replies == {1: "after", 11: "earlier", 21: "first"}


def test_context_orders_and_truncates(messages):
    thread = [(1, None, "B", "s", 3, "hello")]
    thread += [(i, 1, "a", "c", 4, f"m{i}") for i in (3, 2)]
    thread += [(4, 1, "a", "c", None, "y" * 300), (5, 1, "a", "c", None, "z" * 300 + "\n")]
    thread += [(100, None, "a", "c", 1, "t0")] + [(100 + i, 100, "a", "c", 1 + i, f"t{i}") for i in range(1, 11)]
    rows = threads.build_threads(messages(thread)).rows
    text = {r.root: r.conversation_context for r in context.thread_context(rows).collect()}
    assert text[1].split("\n") == [
        "APPLESUPPORT: hello",
        "CUSTOMER: m2",
        "CUSTOMER: m3",
        "CUSTOMER: " + "y" * 300,
        "CUSTOMER: " + "z" * 300 + "…",
    ]
    assert text[100].endswith("CUSTOMER: t9 [thread truncated]")
    sheet = {r.root: r for r in context.labeling_rows(rows).collect()}
    assert sheet[1].tweet_id == 2 and sheet[1].thread_root_tweet_id == 1 and sheet[1].thread_size == 5


def test_corpus_keeps_only_the_brand(messages):
    df = messages(
        [
            (1, None, "a", "c", 1, "ask\nnow"),
            (2, 1, "B", "s", 2, "@a please DM us"),
            (3, None, "a", "c", 3, "other"),
            (4, 3, "C", "s", 4, "reply"),
            (5, None, "a", "c", 3, "unanswered"),
            (6, None, "B", "s", 3, "announcement"),
        ]
    )
    rows = threads.build_threads(df).rows
    built = corpus.build_corpus(rows, "B").collect()
    assert [(r.tweet_id, r.customer_text, r.response_type) for r in built] == [(1, "ask now", "DM handoff")]


def test_roots_partition_the_messages(tables):
    rows = tables.rows
    assert rows.count() == tables.messages.count()
    assert rows.filter(F.col("root").isNull()).count() == 0
    assert tables.stats.agg(F.sum("size")).first()[0] == rows.count()


def test_first_of_thread_never_sorts_or_buffers_texts(messages):
    """No text in an aggregation buffer: every aggregate is a hash aggregate over numbers."""
    rows = threads.build_threads(messages([(1, None, "a", "c", 5, "q"), (2, 1, "B", "s", 9, "r")])).rows
    for frame in (context.first_customer_messages(rows), corpus.first_reply_after(rows), corpus.build_corpus(rows, "B")):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "HashAggregate" in plan and "ObjectHashAggregate" not in plan


def test_packed_time_orders_as_times_and_ids(spark):
    rows = [
        (ts, i)
        for ts in (None, "0001-01-01 00:00:00", "1969-12-31 23:59:59.999999", "2017-10-31 22:00:00", "9999-12-31 23:59:59")
        for i in (-(2**63), -1, 0, 7, 2**63 - 1)
    ]
    df = spark.createDataFrame(rows, "s string, tweet_id bigint").select(F.col("s").cast("timestamp").alias("ts"), "tweet_id")
    columns = F.unix_micros("ts"), "tweet_id"
    by_key = [tuple(r) for r in df.orderBy(threads.packed_time()).select(*columns).collect()]
    assert by_key == [tuple(r) for r in df.orderBy(*threads.time_order()).select(*columns).collect()]
    assert df.select(threads.packed_time().alias("k")).filter("k IS NOT NULL").distinct().count() == len(rows)

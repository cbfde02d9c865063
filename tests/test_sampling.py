from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from threadwright.operators import sampling
from threadwright.operators.distribution import hash_cuts, seeded_hash
from threadwright.operators.metrics import category_shares


def test_split_sizes_of_the_published_split(spark):
    sizes = {"a": 191, "b": 80, "c": 57, "d": 40, "e": 30, "f": 20, "g": 12, "h": 5}
    rows = [(i, label) for i, label in enumerate(x for k, n in sizes.items() for x in [k] * n)]
    df = spark.createDataFrame(rows, "id bigint, label string")
    plan = {r.label: (r.n, r.n_train, r.n_validation, r.n_test) for r in sampling.split_plan(df).collect()}
    assert tuple(map(sum, zip(*plan.values()))) == (435, 304, 65, 66)
    assert all(n == t + v + s for n, t, v, s in plan.values())
    split = sampling.stratified_split(df, "label", "id")
    counts = Counter((r.label, r.split) for r in split.collect())
    for label, (_, train, validation, test) in plan.items():
        assert (counts[label, "train"], counts[label, "validation"], counts[label, "test"]) == (train, validation, test)


def test_stratum_shares_round_half_to_even(spark):
    rows = [(i, f"n{n}") for n in (1, 2, 10, 30) for i in range(1000 * n, 1000 * n + n)]
    df = spark.createDataFrame(rows, "id bigint, s string")
    taken = Counter(r.s for r in sampling.stratified_share(df, ["s"], "id").collect())
    assert taken == {"n1": 1, "n2": 1, "n10": 4, "n30": 14}


def test_samples_are_reproducible_and_disjoint(tables):
    args = (tables.rows, tables.stats, "Brand0", 10)
    first = {r.root for r in sampling.sample_threads(*args, 42).select("root").collect()}
    assert first == {r.root for r in sampling.sample_threads(*args, 42).select("root").collect()}
    assert len(first) == 10
    pool = {r.root for r in sampling.sample_roots(tables.stats, "Brand0", 20, 2024).collect()}
    chosen = {r.root for r in sampling.disjoint_sample_roots(tables.stats, "Brand0", 15, 4242, 20, 2024).collect()}
    assert len(chosen) == 15 and not pool & chosen


def test_sample_larger_than_the_population(tables):
    n = sampling.sample_roots(tables.stats, "Brand0", 10**6, 1).count()
    assert n == tables.stats.filter("brand = 'Brand0' AND n_customer > 0").count()


@pytest.mark.parametrize("size", [30, 12])
def test_coverage_sample_shows_every_value(spark, size):
    rows = [(i, f"i{min(i % 17, 7)}", f"b{i % 5}", "AUTO" if i % 9 == 0 else "ESC") for i in range(400)]
    df = spark.createDataFrame(rows, "tweet_id bigint, a string, b string, c string")
    sample = sampling.coverage_sample(df, ["a", "b", "c"], "tweet_id", size).collect()
    assert len(sample) == size and len({r.tweet_id for r in sample}) == size
    for column in "abc":
        assert {r[column] for r in sample} == {r[column] for r in df.select(column).distinct().collect()}


def test_coverage_sample_of_fewer_rows_than_asked(spark):
    df = spark.range(4).select(F.col("id").alias("tweet_id"), F.lit("x").alias("a"))
    assert sampling.coverage_sample(df, ["a"], "tweet_id", 30).count() == 4


def test_coverage_sample_fills_in_proportion(spark):
    rows = [(i, "x" if i < 80 else "y") for i in range(100)]
    sample = sampling.coverage_sample(spark.createDataFrame(rows, "tweet_id bigint, a string"), ["a"], "tweet_id", 10)
    # one row each for coverage, then 8 * 79/98 and 8 * 19/98
    assert Counter(r.a for r in sample.collect()) == {"x": 7, "y": 3}


def test_coverage_sample_smaller_than_its_values(spark):
    rows = [(i, f"v{i}", "same") for i in range(20)]
    sample = sampling.coverage_sample(spark.createDataFrame(rows, "tweet_id bigint, a string, b string"), ["a", "b"], "tweet_id", 5)
    assert len({r.tweet_id for r in sample.collect()}) == 5


def test_bucketed_pick_tops_up(spark):
    sizes = [2] * 2 + [3] * 20 + [1, 4, 7]
    df = spark.createDataFrame(list(enumerate(sizes)), "root bigint, size int")
    picked = sampling.bucketed_pick(df, 15).collect()
    by_bucket = Counter(r.bucket for r in picked)
    assert len(picked) == 15 and by_bucket == {"2": 2, "3": 10, "4+": 3}


def test_shares_show_zero_classes(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "x string")
    got = {r.label: (r.n, round(r.pct, 2)) for r in category_shares(df, "x", ["a", "b", "c"]).collect()}
    assert got == {"a": (2, 66.67), "b": (1, 33.33), "c": (0, 0.0)}


def test_split_and_share_equal_row_numbers(spark):
    df = spark.range(1000).select("id", F.concat(F.lit("l"), F.floor(F.sqrt(F.col("id") % 40))).alias("label"), F.lit("t").alias("text"))
    order = Window.partitionBy("label").orderBy(seeded_hash(42, F.col("id")), "id")
    plan = sampling.split_plan(df)
    want = df.withColumn("k", F.row_number().over(order)).join(plan, "label")
    part = F.when(F.expr("k <= n_train"), "train").when(F.expr("k <= n_train + n_validation"), "validation").otherwise("test")
    want = {(r.id, r.s) for r in want.select("id", part.alias("s")).collect()}
    assert {(r.id, r.split) for r in sampling.stratified_split(df, "label", "id").collect()} == want
    share = sampling.stratified_share(df, ["label"], "id", 0.3, 42)
    assert share.columns == ["label", "id", "text"]
    sizes = {r.label: r.n for r in plan.collect()}
    taken = Counter(r.label for r in share.collect())
    assert taken == {label: min(n, max(1, round(n * 0.3))) for label, n in sizes.items()}


def test_only_ids_are_ranked(spark, tmp_path):
    spark.range(100).selectExpr("id", "id % 3 AS label", "'t' || id AS text").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    wanted = spark.createDataFrame([(0, 5)], "label bigint, k bigint")
    plan = hash_cuts(df, ["label"], 1, "id", wanted)._jdf.queryExecution().optimizedPlan().toString()
    assert "label#" in plan and not any("text#" in line for line in plan.splitlines() if "Relation" not in line)


def test_whole_rows_of_a_simple_sample(spark):
    df = spark.range(50).select("id", (F.col("id") * 2).alias("v"))
    got = [(r.id, r.v) for r in sampling.simple_sample(df, "id", 7, 3).collect()]
    ids = [r.id for r in df.orderBy(seeded_hash(3, F.col("id")), "id").limit(7).collect()]
    assert got == [(i, 2 * i) for i in ids]

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from threadwright.operators import distribution
from threadwright.operators.distribution import exact_rank, hash_rank, hot_keys, lookup_join, values_frame


def test_exact_rank_equals_row_number(spark):
    df = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"),
        (F.hash("id") % 1000).alias("v"),
    )
    ranked = exact_rank(df, ["g"], [F.col("v"), F.col("id")], F.floor(F.col("v") / 100))
    window = Window.partitionBy("g").orderBy("v", "id")
    both = ranked.withColumn("want", F.row_number().over(window))
    assert both.filter("rank <> want").count() == 0 and both.count() == 3000


def test_exact_rank_over_everything(spark):
    df = spark.range(500).select("id", (F.col("id") * 7 % 10).alias("v"))
    ranked = exact_rank(df, [], [F.col("v"), F.col("id")], F.col("v")).orderBy("v", "id").select("rank")
    assert [r[0] for r in ranked.collect()] == list(range(1, 501))


def test_hash_rank_is_a_permutation_and_depends_on_the_seed(spark):
    df = spark.range(1000).withColumn("g", F.lit("all"))
    first = {r.id: r["rank"] for r in hash_rank(df, ["g"], 1, "id").collect()}
    second = {r.id: r["rank"] for r in hash_rank(df, ["g"], 2, "id").collect()}
    assert sorted(first.values()) == list(range(1, 1001)) and first != second


def test_exact_rank_in_two_levels(spark):
    df = spark.range(2000).select("id", (F.col("id") % 2).alias("g"), (F.hash("id") % 500).alias("v"))
    ranked = exact_rank(df, ["g"], [F.col("v"), F.col("id")], F.floor(F.col("v") / 10), "rank", F.floor(F.col("v") / 100))
    both = ranked.withColumn("want", F.row_number().over(Window.partitionBy("g").orderBy("v", "id")))
    assert both.filter("rank <> want").count() == 0 and both.count() == 2000


def test_hash_rank_with_small_buckets(spark, monkeypatch):
    monkeypatch.setattr(distribution, "BUCKET_ROWS", 2)
    monkeypatch.setattr(distribution, "COARSE_DIGITS", 2)
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("g"))
    window = Window.partitionBy("g").orderBy(distribution.seeded_hash(7, F.col("id")), "id")
    both = hash_rank(df, ["g"], 7, "id").withColumn("want", F.row_number().over(window))
    assert both.filter("rank <> want").count() == 0 and both.count() == 3000


def test_exact_rank_plan_never_groups_a_whole_key(spark):
    df = spark.range(100).withColumn("g", F.col("id") % 2)
    plan = hash_rank(df, ["g"], 1, "id")._jdf.queryExecution().executedPlan().toString()
    by_row = [line for line in plan.splitlines() if "Exchange hashpartitioning(g#" in line]
    # only the bucket counts are exchanged by the group alone
    assert sum("__bucket" not in line.split("],")[0] for line in by_row) <= 1
    assert any("__bucket" in line for line in by_row)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_with_hot_keys(spark, how):
    left = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 2).alias("k"))
    right = spark.range(1, 5).select(F.col("id").alias("k"), F.col("id").alias("v"))
    hot = hot_keys(left, "k", 100)
    assert sorted(hot) == [0, 1]
    plain = sorted(map(str, lookup_join(left, right, "k", how).collect()))
    assert sorted(map(str, lookup_join(left, right, "k", how, hot).collect())) == plain


def test_hot_key_list_is_bounded(spark):
    left = spark.range(10).select(F.col("id").alias("k"))
    with pytest.raises(ValueError):
        lookup_join(left, left, "k", hot=list(range(1001)))
    assert len(hot_keys(left, "k", 1, limit=3)) == 3


def test_values_frame_keeps_quotes(spark):
    rows = [("it's", 1), ('a "b" \\ c', None)]
    assert [tuple(r) for r in values_frame(spark, rows, "t string, n bigint").collect()] == rows

"""Exact quantiles against NumPy, without buffers that grow with the data."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadwright.operators import brands, judge
from threadwright.operators.quantiles import exact_quantile


def groups(seed: int) -> dict:
    rng = np.random.default_rng(seed)
    return {
        "even": np.arange(1000.0),
        "ties": rng.integers(0, 4, 3000).astype(float),
        "one": np.array([7.5]),
        "two": np.array([1.0, 2.0]),
        "wide": np.concatenate([rng.normal(size=500), [1e300, -1e300, 0.0]]),
        "hot": np.concatenate([np.zeros(2000), rng.random(500)]),
        None: rng.random(99),
    }


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.9, 1.0])
@pytest.mark.parametrize("parts", [4, 256])
def test_quantiles_of_groups(spark, q, parts):
    data = groups(3)
    rows = [(g, float(v)) for g, values in data.items() for v in values] + [("one", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(4)
    got = {r.g: r.m for r in exact_quantile(df, "x", q, ["g"], "m", parts).collect()}
    assert set(got) == set(data)
    for g, values in data.items():
        assert got[g] == pytest.approx(float(np.quantile(values, q)), rel=1e-12, abs=1e-12)


def test_quantile_of_all_rows(spark):
    df = spark.range(10_001).select((F.col("id") * 7 % 10_001).alias("x"))
    assert exact_quantile(df, "x", 0.25).first()[0] == 2500.0
    assert exact_quantile(df.filter("x < 4"), "x", 0.5).first()[0] == 1.5
    assert exact_quantile(df.limit(0), "x", 0.5).collect()[0][0] is None


def test_no_buffer_holds_all_values(spark):
    rows = spark.range(50).selectExpr("id AS tweet_id", "CAST(id % 3 AS STRING) AS author_id", "TRUE AS is_support", "FALSE AS dangling")
    stats = rows.selectExpr(
        "tweet_id AS root", "author_id AS brand", "1L AS n_support", "1L AS n_customer", "tweet_id AS size", "1L AS n_distinct_brands"
    )
    scored = rows.select(F.col("tweet_id").alias("overall"))
    for df in (brands.brand_metrics(rows, stats), judge.low_quartile(scored)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "percentile_approx" in plan and "median(" not in plan and "percentile(" not in plan
    assert [r.overall for r in judge.low_quartile(scored).orderBy("overall").collect()] == list(range(13))

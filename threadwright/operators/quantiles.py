"""Exact quantiles by narrowing to a part of the values; no buffer grows with the data.

Approximate quantiles (a sketch of fixed size) cut the values of a group into parts of about equal numbers.
The parts are counted exactly, which tells the part a wanted rank lies in whatever the sketch's error, and only
this part's distinct values are ranked, by counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PARTS = 256
SKETCH = 10_000


def exact_quantile(df: DataFrame, column: str, q: float, by: Sequence[str] = (), name: str = "quantile", parts: int = PARTS) -> DataFrame:
    """(by, ``name``): the ``q``-quantile of each group as a double, interpolated between neighbours.

    Null values do not count, and a group without others is left out; a null key is a group. Without ``by`` one row
    comes back, null if there is no value.
    """
    keys = [f"__k{i}" for i in range(len(by))] or ["__k0"]
    named = [F.col(c).alias(k) for c, k in zip(by, keys, strict=True)] if by else []
    if not by:  # one key for all rows that the optimizer does not fold, so that the joins stay joins by key
        named = [F.pmod(F.xxhash64(F.col(column)), F.lit(1)).alias("__k0")]
    values = df.filter(F.col(column).isNotNull()).select(*named, F.col(column).cast("double").alias("v"))
    same = [f"a.{k} <=> b.{k}" for k in keys]

    cuts = F.percentile_approx("v", F.array(*[F.lit(i / parts) for i in range(1, parts)]), SKETCH)
    edges = values.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.array_distinct(cuts).alias("edges"))
    counted = values.groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("m"))
    on = F.expr(" AND ".join(same))
    placed = counted.alias("a").join(edges.alias("b"), on).select(*[f"a.{k}" for k in keys], "v", "m", "n", "edges")
    placed = placed.withColumn("part", F.size(F.filter("edges", lambda e: e < F.col("v")))).drop("edges")

    # the two ranks (from 0) whose values the quantile lies between
    at = F.lit(q) * (F.col("n") - 1)
    before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy(*keys, "n", "part").agg(F.sum("m").alias("size"))
    sums = sums.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)))
    wanted = sums.select("*", F.explode(F.array(F.floor(at), F.ceil(at))).alias("rank")).distinct()
    wanted = wanted.filter("start <= rank AND rank < start + size").select(*keys, "part", "start", "rank")

    # ranks are few (two a group); only their parts are ordered, by distinct value
    inside = placed.alias("a").join(wanted.alias("b"), F.expr(" AND ".join([*same, "a.part = b.part"])))
    inside = inside.select(*[f"a.{k}" for k in keys], "v", "m", "n", "start", "rank")
    upto = Window.partitionBy(*keys, "rank").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = inside.withColumn("end", F.col("start") + F.sum("m").over(upto))
    found = reached.filter((F.col("end") - F.col("m") <= F.col("rank")) & (F.col("rank") < F.col("end")))

    low, high, share = F.min_by("v", "rank"), F.max_by("v", "rank"), F.max(at - F.floor(at))
    value = F.when(share == 0, low).otherwise((1 - share) * low + share * high)
    if not by:
        return found.agg(value.alias(name))
    return found.groupBy(*keys).agg(value.alias(name)).select(*[F.col(k).alias(c) for c, k in zip(by, keys, strict=True)], name)

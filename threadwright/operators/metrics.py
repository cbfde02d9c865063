"""Classification metrics over (truth, prediction) columns.

Predictions are first combined into confusion counts; every metric is arithmetic on that small
table. Zero denominators give 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .distribution import values_frame


def zero_safe(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def confusion_counts(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    return df.groupBy(F.col(truth).alias("truth"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(df: DataFrame, truth: str, prediction: str, labels: Sequence[str]) -> DataFrame:
    """Every (truth, prediction) cell of the fixed labels in order, zero cells included."""
    grid = [(i, a, j, b) for i, a in enumerate(labels) for j, b in enumerate(labels)]
    cells = values_frame(
        df.sparkSession, grid, "truth_index bigint, truth string, prediction_index bigint, prediction string"
    )
    return cells.join(confusion_counts(df, truth, prediction), ["truth", "prediction"], "left").na.fill(0, ["n"])


def per_class_metrics(df: DataFrame, truth: str, prediction: str, labels: Sequence[str] | None = None) -> DataFrame:
    """Precision, recall, F1 and support per label, over fixed labels or those that occur."""
    counts = confusion_counts(df, truth, prediction)
    hit = F.when(F.col("truth") == F.col("prediction"), F.col("n")).otherwise(0)
    sides = counts.select(
        F.explode(
            F.array(
                F.struct(F.col("truth").alias("label"), hit.alias("tp"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted")),
                F.struct(F.col("prediction").alias("label"), F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted")),
            )
        ).alias("s")
    ).select("s.*")
    totals = sides.groupBy("label").agg(*[F.sum(c).alias(c) for c in ("tp", "support", "predicted")])
    if labels is not None:
        fixed = values_frame(df.sparkSession, [(name,) for name in labels], "label string")
        totals = fixed.join(totals, "label", "left").na.fill(0, ["tp", "support", "predicted"])
    scored = totals.withColumn("precision", zero_safe(F.col("tp"), F.col("predicted"))).withColumn(
        "recall", zero_safe(F.col("tp"), F.col("support"))
    )
    f1 = zero_safe(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return scored.withColumn("f1", f1).select("label", "precision", "recall", "f1", "support")


def summary_metrics(df: DataFrame, truth: str, prediction: str, labels: Sequence[str] | None = None) -> DataFrame:
    """Accuracy, macro F1 and support-weighted F1."""
    classes = per_class_metrics(df, truth, prediction, labels)
    f1 = classes.agg(
        F.avg("f1").alias("macro_f1"),
        zero_safe(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("weighted_f1"),
    )
    return f1.select(accuracy(df, truth, prediction).scalar().alias("accuracy"), "macro_f1", "weighted_f1")


def accuracy(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    equal = F.coalesce(F.col(truth) == F.col(prediction), F.lit(False))
    return df.agg(F.avg(equal.cast("double")).alias("accuracy"))


def binary_metrics(df: DataFrame, truth: str, prediction: str, positive: str) -> DataFrame:
    """Accuracy and precision, recall, F1 of one positive label."""
    said, real = F.col(prediction) == positive, F.col(truth) == positive
    counts = df.agg(
        F.count_if(said & real).alias("tp"),
        F.count_if(said).alias("said"),
        F.count_if(real).alias("real"),
        F.avg((F.col(truth) == F.col(prediction)).cast("double")).alias("accuracy"),
    )
    scored = counts.withColumn("precision", zero_safe(F.col("tp"), F.col("said"))).withColumn(
        "recall", zero_safe(F.col("tp"), F.col("real"))
    )
    f1 = zero_safe(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return scored.withColumn("f1", f1).select("accuracy", "precision", "recall", "f1")


def constant_baseline(df: DataFrame, value: str, out: str = "baseline") -> DataFrame:
    return df.withColumn(out, F.lit(value))


def class_distribution(df: DataFrame, label_col: str, split_col: str, splits: Sequence[str]) -> DataFrame:
    """Rows per label and split, zero filled."""
    return df.groupBy(F.col(label_col).alias("label")).agg(
        *[F.count_if(F.col(split_col) == s).alias(s) for s in splits]
    )


def category_shares(df: DataFrame, column: str, labels: Sequence[str]) -> DataFrame:
    """Count and percentage per category of a closed vocabulary, zero classes shown."""
    counts = df.groupBy(F.col(column).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    fixed = values_frame(df.sparkSession, [(name,) for name in labels], "label string")
    total = df.agg(F.count(F.lit(1)).alias("t")).scalar()
    return (
        fixed.join(counts, "label", "left")
        .na.fill(0, ["n"])
        .withColumn("pct", zero_safe(F.col("n") * 100.0, total))
    )


def rare_classes(df: DataFrame, column: str, labels: Sequence[str], below_pct: float = 5.0) -> DataFrame:
    return category_shares(df, column, labels).filter(F.col("pct") < below_pct)


def tag_counts(df: DataFrame, tags: dict[str, Column]) -> DataFrame:
    """Rows per non-exclusive tag, counted in one pass."""
    row = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(c).alias(name) for name, c in tags.items()])
    pairs = ", ".join(f"'{name}', `{name}`" for name in tags)
    long = row.selectExpr("n_rows", f"stack({len(tags)}, {pairs}) AS (tag, n)")
    return long.select("tag", "n", zero_safe(F.col("n") * 100.0, F.col("n_rows")).alias("pct"))


def first_per_class(df: DataFrame, class_col: str, id_col: str, *columns: str) -> DataFrame:
    """The row with the smallest id of each class."""
    picked = df.groupBy(class_col).agg(F.min_by(F.struct(id_col, *columns), id_col).alias("r"))
    return picked.select(class_col, *[F.col(f"r.{c}").alias(c) for c in (id_col, *columns)])


def failures(df: DataFrame, id_col: str, *flags: str) -> DataFrame:
    """Rows where not all flags hold; order by ``id_col`` and limit for the first ones."""
    ok = F.lit(True)
    for flag in flags:
        ok = ok & F.coalesce(F.col(flag), F.lit(False))
    return df.filter(~ok)


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*order).limit(n)

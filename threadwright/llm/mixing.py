"""Mixing sources to target weights by a budget that flows down a tree of sources.

A token budget goes down a tree (by default domain, language, source). Each node splits its share
among its children by weight, but none gets more than its whole subtree can give (its tokens
times the number of epochs allowed); what a child cannot use goes to its siblings in proportion to
their weights. So a shortage is made up inside the smallest subtree that can do it, and reaches
an ancestor's other children only when the whole subtree is short. Each leaf then takes whole
epochs and, of the next, the prefix of a seeded order that fits its budget.

All arithmetic is on whole numbers. The tree is a table with one row per leaf and is handled by
windows over siblings; documents are only ever ranked inside (leaf, hash bucket), so a leaf with a
third of all documents is spread out.

Defined results: null names of a level count as ''; a null or negative token count is 0, and a
document without tokens is taken if its place lies in the prefix. A weight that is not given is 1; weight 0
shuts a subtree out. Equal documents (same id) share a place in the order and are taken together
or not at all. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WHOLE = "decimal(38,0)"


def word_count(text_col: str = "text"):
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def _weight(depth: int, weights: Mapping[tuple[str, ...], int], names: Sequence[str]):
    """Weight of the node at ``depth`` levels below the root: its full path, or its name alone."""
    out = None
    ordered = sorted(weights.items(), key=lambda x: -len(x[0]))
    for path, weight in ordered:
        if len(path) == depth:
            cols = list(zip(names[:depth], path, strict=True))
        elif len(path) == 1:
            cols = [(names[depth - 1], path[0])]
        else:
            continue
        match = F.lit(True)
        for name, value in cols:
            match = match & (F.col(name) == value)
        out = F.when(match, weight) if out is None else out.when(match, weight)
    return (F.lit(1) if out is None else out.otherwise(1)).cast("long")


def leaf_budgets(
    leaves: DataFrame, levels: Sequence[str], weights: Mapping[tuple[str, ...], int], budget: int, max_epochs: int
) -> DataFrame:
    """Add ``budget`` to one row per leaf (level names and ``tokens``)."""
    table = leaves.withColumn("__cap", F.col("tokens") * F.lit(max_epochs)).withColumn("budget", F.lit(budget).cast("long"))
    for depth in range(1, len(levels) + 1):
        own = list(levels[:depth])
        if depth > 1:
            parent = list(levels[: depth - 1])
        else:
            table = table.withColumn("__root", F.lit(0))
            parent = ["__root"]
        name = levels[depth - 1]
        nodes = table.groupBy(*dict.fromkeys([*parent, *own])).agg(F.sum("__cap").cast(WHOLE).alias("cap"), F.first("budget").cast(WHOLE).alias("given"))
        nodes = nodes.withColumn("w", _weight(depth, weights, levels).cast(WHOLE)).withColumn(
            "ratio", F.when(F.col("w") > 0, F.col("cap").cast("double") / F.col("w").cast("double"))
        )
        rising = Window.partitionBy(*parent).orderBy(F.col("ratio").asc_nulls_last(), name)
        siblings = Window.partitionBy(*parent)
        so_far = rising.rowsBetween(Window.unboundedPreceding, 0)
        nodes = nodes.withColumn("cap_sum", F.sum("cap").over(so_far)).withColumn(
            "w_above", F.sum("w").over(siblings) - F.sum("w").over(so_far)
        )
        # a child is filled up if the level at which it is full still fits the parent's budget
        level_cost = (F.col("cap_sum") * F.col("w") + F.col("cap") * F.col("w_above")).cast(WHOLE)
        nodes = nodes.withColumn("full", (F.col("w") > 0) & (level_cost <= (F.col("given") * F.col("w")).cast(WHOLE)))
        nodes = nodes.withColumn("used", F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(siblings), F.lit(0).cast(WHOLE)))
        nodes = nodes.withColumn("w_open", F.coalesce(F.sum(F.when(~F.col("full"), F.col("w"))).over(siblings), F.lit(0).cast(WHOLE)))
        share = F.expr("cast((given - used) * w as decimal(38,0)) div w_open")
        got = F.when(F.col("full"), F.col("cap").cast("long")).when(F.col("w_open") > 0, share.cast("long")).otherwise(F.lit(0).cast("long"))
        table = table.drop("budget").join(nodes.select(*dict.fromkeys([*parent, *own]), got.alias("budget")), list(dict.fromkeys([*parent, *own])))
    return table.drop("__cap", "__root")


def mix_to_weights(
    docs: DataFrame,
    tokens_col: str,
    levels: Sequence[str] = ("domain", "lang", "source"),
    weights: Mapping[tuple[str, ...], int] | None = None,
    budget: int | None = None,
    budget_share: float = 0.5,
    max_epochs: int = 4,
    seed: int = 11,
    id_col: str = "doc_id",
) -> DataFrame:
    """The chosen rows of ``docs`` with ``epoch`` (0, 1, ...), one row per repetition.

    ``weights`` maps a full path or a single name to a whole-number weight. Without ``budget`` it
    is ``budget_share`` of all tokens. Only ids, level names and counts are stored and ranked; rows
    of ``docs`` meet the (small) table of leaf cutoffs and are never shuffled by id.
    """
    names = [f"__l{i}" for i in range(len(levels))]
    level_cols = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in zip(levels, names, strict=True)]
    tokens = F.greatest(F.coalesce(F.col(tokens_col).cast("long"), F.lit(0)), F.lit(0))
    slim = staged(docs.select(F.col(id_col).alias("__id"), *level_cols, tokens.alias("tokens")), "mix")
    total, most = slim.groupBy(*names).agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n")).agg(F.sum("t"), F.max("n")).first()
    if budget is None:
        budget = int((total or 0) * budget_share)
    width = 2  # hex digits of a bucket, such that the largest leaf has about ten thousand rows in each
    while (most or 0) / 16**width > 10_000:
        width += 1

    leaves = slim.groupBy(*names).agg(F.sum("tokens").alias("tokens"))
    plan = leaf_budgets(leaves, names, weights or {}, budget, max_epochs)
    plan = plan.withColumn("full", F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(0).cast("int"))
    plan = staged(plan.withColumn("rest", F.col("budget") - F.col("full") * F.col("tokens")), "mix-plan")

    def place(epoch, doc):
        return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), doc.cast("string")))

    ranked = slim.join(plan.filter("rest > 0").select(*names, "full", "rest"), names).withColumn("h", place(F.col("full"), F.col("__id")))
    ranked = ranked.withColumn("b", F.substring("h", 1, width))
    before = Window.partitionBy(*names).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    buckets = ranked.groupBy(*names, "b").agg(F.sum("tokens").alias("n"), F.max(F.struct("h", "__id")).alias("last"), F.first("rest").alias("rest"))
    buckets = staged(buckets.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))), "mix-buckets")
    edge = buckets.filter((F.col("start") < F.col("rest")) & (F.col("start") + F.col("n") > F.col("rest")))
    fine = (
        ranked.join(edge.select(*names, "b", "start"), [*names, "b"])
        .withColumn("end", F.col("start") + F.sum("tokens").over(_peers(names)))
        .filter(F.col("end") <= F.col("rest"))
        .groupBy(*names)
        .agg(F.max(F.struct("h", "__id")).alias("last"))
    )
    coarse = buckets.filter(F.col("start") + F.col("n") <= F.col("rest")).groupBy(*names).agg(F.max("last").alias("last"))
    cutoff = coarse.unionByName(fine).groupBy(*names).agg(F.max("last").alias("__last"))
    take = staged(plan.join(cutoff, names, "left").select(*names, F.col("full").alias("__full"), "__last"), "mix-cutoffs")

    base = docs.drop("epoch")
    keyed = base.withColumns({n: c for n, c in zip(names, level_cols, strict=True)})
    epochs = keyed.join(take, names).withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("__full"))))
    own = F.struct(place(F.col("epoch"), F.col(id_col)).alias("h"), F.col(id_col).alias("__id"))
    kept = epochs.filter((F.col("epoch") < F.col("__full")) | (own <= F.col("__last")))
    return kept.select(*base.columns, "epoch")


def _peers(names: Sequence[str]):
    """Running sums in which rows with the same place count together."""
    return Window.partitionBy(*names, "b").orderBy(F.struct("h", "__id")).rangeBetween(Window.unboundedPreceding, Window.currentRow)

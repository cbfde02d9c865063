"""Whitening of embeddings with MLlib's distributed block matrices.

Centred rows get consecutive numbers and become an ``IndexedRowMatrix``, whose blocks hold a bounded
number of rows. The transpose times the matrix is the scatter; only this (dimensions x dimensions) and
the column sums reach the driver, where ``eigh`` gives the components. Multiplying the block matrix by the
whitening matrix projects all rows. The middle dimension of the scatter product is split: otherwise MLlib
would add up all blocks in one task, as the result is a single block.

Spark's matrices are fed from and read back as DataFrames, so no row passes through Python.

Defined results: a vector that is null, empty, or holds null or non-finite entries is left out, and so
are entries too large for a whole number on the grid, and vectors of another length than the most
frequent one (the shorter one if two are). Components without variance (up to rounding) are not
returned: equal vectors, or a single one, give no rows. Repeated rows count, and come out, as often as they
occur; null ids are kept. ``deviation`` is null where it does not fit a long. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, staged

BLOCK_ROWS = 4096
#: Variance below this share of the total counts as rounding.
FLAT = 1e-12
MADE = {
    "n": "bigint",
    "deviation": "bigint",
    "whitened": "array<double>",
    "explained": "array<double>",
    "identity_error": "double",
}
_LONG = (1 << 63) - 1
_WIDEST = float(1 << 62)


def lattice(vector: Column, scale: int = 1024, shift: int = 100_000) -> Column:
    """Entries on a grid of whole numbers; null for a vector that has none there."""
    entries = F.transform(vector.cast("array<double>"), lambda c: F.floor(c * scale) + shift)
    fine = F.forall(vector.cast("array<double>"), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * scale < _WIDEST))
    return F.when(F.coalesce(fine, F.lit(False)) & (F.size(vector) > 0), entries)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored with consecutive numbers ``row`` from 0.

    Spark numbers rows within each task; the tasks' counts, one row a task, give their offsets.
    """
    at = F.monotonically_increasing_id()
    dealt = staged(df.withColumn("__at", at), name)
    task = F.shiftright("__at", 33)
    counts = dealt.groupBy(task.alias("__task")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("__task", F.coalesce(before, F.lit(0)).alias("__offset"))
    inside = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    rows = dealt.withColumn("__task", task).join(offsets, "__task").withColumn("row", F.col("__offset") + inside)
    return rows.drop("__task", "__offset", "__at")


def column_sums(rows: DataFrame, x: str) -> tuple[int, list[int], int, int]:
    """Number of rows, exact sum of every dimension, smallest and largest entry."""
    spread = rows.select(F.posexplode(x).alias("dim", "x"))
    sums = spread.groupBy("dim").agg(F.sum(F.col("x").cast("decimal(20,0)")).alias("s"), F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    found = sorted(sums.collect())
    if not found:
        return 0, [], 0, 0
    return found[0]["n"], [int(r["s"]) for r in found], min(r["lo"] for r in found), max(r["hi"] for r in found)


def deviation(x: Column, n: int, sums: list[int], lo: int, hi: int) -> Column:
    """Exact sum over the dimensions of ``(n * x - sum)`` squared."""
    if len(sums) * (n * (hi - lo)) ** 2 <= _LONG and n * max(abs(lo), abs(hi)) <= _LONG:  # no step can overflow
        total = F.array(*[F.lit(s).cast("long") for s in sums])
        gaps = F.zip_with(x, total, lambda a, s: n * a - s)
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda acc, g: acc + g * g)
    wide = "decimal(38,0)"
    total = F.array(*[F.lit(str(s)).cast(wide) for s in sums])
    gaps = F.zip_with(x, total, lambda a, s: (F.try_multiply(a.cast(wide), F.lit(n).cast(wide)) - s).cast(wide))
    squares = F.aggregate(gaps, F.lit(0).cast(wide), lambda acc, g: F.try_add(acc, F.try_multiply(g, g).cast(wide)).cast(wide))
    return squares.try_cast("bigint")


def block_matrix(rows: DataFrame, row: str, values: Column, n: int, dims: int, block_rows: int) -> BlockMatrix:
    vectors = MLUtils.convertVectorColumnsFromML(rows.select(F.col(row).alias("index"), array_to_vector(values).alias("vector")), "vector")
    return IndexedRowMatrix(vectors, n, dims).toBlockMatrix(block_rows, dims)


def product(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """``left`` times ``right`` with the middle dimension cut into ``splits``, which Python's API does not offer."""
    java = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, left.rowsPerBlock, right.colsPerBlock)


def components(scatter: np.ndarray, n: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Variances, unit vectors (rows) and shares of the total variance of the first components."""
    covariance = (scatter + scatter.T) / (2 * n)
    values, vectors = np.linalg.eigh(covariance)
    trace = float(np.trace(covariance))
    order = [k for k in np.argsort(-values, kind="stable") if values[k] > FLAT * trace][:most]
    values, vectors = values[order], vectors.T[order]
    for v in vectors:  # one of two signs: the largest entry is positive
        v *= np.sign(v[np.abs(v).argmax()])
    return values, vectors, values / trace if trace else values


def identity_error(whitened: DataFrame, column: str, width: int) -> float:
    """Largest entry of the covariance of ``column`` minus the identity."""
    at = [F.get(column, F.lit(i)) for i in range(width)]
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    found = whitened.agg(*[F.covar_pop(at[i], at[j]) for i, j in pairs]).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(found, pairs, strict=True))


def whiten(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    most: int = 8,
    scale: int = 1024,
    shift: int = 100_000,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``id_col``, ``n``, ``deviation``, ``whitened`` (array of up to ``most``), ``explained`` and ``identity_error``."""
    spark = df.sparkSession
    placed = df.select(F.col(id_col), lattice(F.col(vector_col), scale, shift).alias("__x")).filter("__x IS NOT NULL")
    placed = staged(placed, "grid-vectors")
    lengths = placed.groupBy(F.size("__x").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    dims = lengths["dims"] if lengths else 0
    same = placed.filter(F.size("__x") == dims)
    n, sums, lo, hi = column_sums(same, "__x")
    nothing = same.limit(0).select(id_col, *[F.lit(None).cast(kind).alias(name) for name, kind in MADE.items()])
    if n < 2:
        return nothing
    rows = staged(numbered(same, "grid-rows"), "numbered-vectors")
    means = F.array(*[F.lit(s / n) for s in sums])  # whole numbers divide with one rounding
    centred = F.zip_with("__x", means, lambda a, m: a.cast("double") - m)
    blocks = block_matrix(rows, "row", centred, n, dims, block_rows)
    blocks.persist(StorageLevel.MEMORY_ONLY)  # read three times; blocks that do not fit are made again
    splits = partitions(df)
    scatter = product(blocks.transpose(), blocks, splits).toLocalMatrix().toArray()
    values, vectors, explained = components(scatter, n, most)
    if not len(values):
        return nothing
    weights = (vectors / np.sqrt(values)[:, None]).T
    small = DenseMatrix(dims, len(values), weights.ravel(order="F"))
    right = BlockMatrix(spark.sparkContext.parallelize([((0, 0), small)], 1), dims, len(values), dims, len(values))
    indexed = product(blocks, right, 1).toIndexedRowMatrix()
    found = callMLlibFunc("getIndexedRows", indexed._java_matrix_wrapper._java_model)  # a DataFrame of (index, vector)
    found = MLUtils.convertVectorColumnsToML(found, "vector")
    projected = staged(found.select(F.col("index").alias("row"), vector_to_array("vector").alias("whitened")), "whitened-vectors")
    blocks._java_matrix_wrapper._java_model.blocks().unpersist(False)
    error = identity_error(projected, "whitened", len(values))
    apart = rows.select(F.col(id_col), "row", deviation(F.col("__x"), n, sums, lo, hi).alias("deviation"))
    shares = F.array(*[F.lit(float(e)) for e in explained])
    facts = {"n": F.lit(n).cast("long"), "explained": shares, "identity_error": F.lit(float(error))}
    return apart.join(projected, "row").withColumns(facts).select(id_col, *MADE)

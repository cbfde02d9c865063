"""Near-duplicate vectors by int8 tile products with rigorous error bounds.

Equal vectors are collapsed to one with a count. The distinct ones are quantised to int8 with a scale each and dealt
by hash into tiles of a bounded number of rows; every pair of tiles is one small task. Inside it the
tile product of the int8 values (small whole numbers, so single precision holds them exactly) with the norms of the
quantisation errors bounds every cosine from above. Only int8 values, scales and norms travel to these tasks, which
name the vectors that have a pair that might reach the threshold. Just those are then sent in double precision, once
per pair of tiles in which they have such a pair, and their pairs are computed exactly. A task returns link counts
and a spanning forest of its links, never the pairs, so a dense group costs rows, not pairs.

All pairs of tiles are compared, which is what an exact answer for arbitrary vectors asks for: work
grows with the square of the number of distinct vectors, in independent tasks of constant size.

Defined results: one row comes back per row. A vector that is null, empty, zero, or has null or non-finite components
links with nothing, nor do vectors of different lengths. Ids should be unique; rows that repeat an id with the same
vector count as one link but are listed as often. A row without an id links with nothing, has no component and is
kept. Ties (cosine exactly at the threshold) link.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged
from .components import Forest, components

TILE_ROWS = 8192
BLOCK = 1024
SLACK = 1e-9  # far above the rounding of the bounds, far below what matters


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 values, scales, norms of the quantised vectors and norms of the errors."""
    scale = np.abs(unit).max(axis=1) / 127.0
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    back = q * scale[:, None]
    return q, scale, np.linalg.norm(back, axis=1), np.linalg.norm(unit - back, axis=1)


def unit_rows(values: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that squares neither overflow nor vanish."""
    x = values / np.abs(values).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Tile:
    """Quantised rows: ids, int8 values, scales, norms of the quantised vectors and of the errors."""

    def __init__(self, ids: bytes, q: bytes, bounds: bytes):
        self.ids = np.frombuffer(ids, np.int64)
        self.q = np.frombuffer(q, np.int8).reshape(len(self.ids), -1)
        self.scale, self.norm, self.error = np.frombuffer(bounds, np.float64).reshape(3, -1)


def possible_rows(a: Tile, b: Tile, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of either tile with a pair (of two different rows) whose cosine may reach the threshold."""
    kind = np.float32 if a.q.shape[1] * 127**2 < 1 << 24 else np.float64  # whole numbers stay exact
    of_a, of_b = np.zeros(len(a.ids), bool), np.zeros(len(b.ids), bool)
    for i in range(0, len(a.ids), BLOCK):
        r = slice(i, i + BLOCK)
        left = a.q[r].astype(kind)
        for j in range(i if same else 0, len(b.ids), BLOCK):
            c = slice(j, j + BLOCK)
            near = (left @ b.q[c].astype(kind).T) * (a.scale[r, None] * b.scale[None, c]).astype(kind)
            bound = threshold - SLACK - a.norm[r, None] * b.error[None, c] - a.error[r, None]
            possible = near >= bound.astype(np.float32) - np.float32(1e-6)
            if same and i == j:
                np.fill_diagonal(possible, False)
            of_a[r] |= possible.any(axis=1)
            of_b[c] |= possible.any(axis=0)
    if same:
        of_a = of_b = of_a | of_b
    return np.flatnonzero(of_a), np.flatnonzero(of_b)


class Exact:
    """Rows in double precision: ids, numbers of copies and vectors of length one."""

    def __init__(self, ids: np.ndarray, copies: np.ndarray, values: np.ndarray):
        self.ids, self.copies, self.unit = ids, copies, unit_rows(values.reshape(len(ids), -1))


def _labels(link: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Component numbers of the rows and columns of a bipartite link matrix (big where none)."""
    rows, cols = link.shape
    big = rows + cols
    of_row = np.where(link.any(axis=1), np.arange(rows), big)
    while True:
        of_col = np.where(link, of_row[:, None], big).min(axis=0, initial=big)
        fresh = np.minimum(of_row, np.where(link, of_col[None, :], big).min(axis=1, initial=big))
        if (fresh == of_row).all():
            return of_row, of_col
        of_row = fresh


def tile_links(a: Exact, b: Exact, same: bool, threshold: float) -> pa.Table:
    """Per vector with links between the two tiles: their number (with copies) and a root."""
    n = len(a.ids)
    ids = a.ids if same else np.concatenate([a.ids, b.ids])
    shift = 0 if same else n
    counts = np.zeros(len(ids), np.int64)
    forest = Forest(len(ids))
    for i in range(0, n, BLOCK):
        for j in range(i if same else 0, len(b.ids), BLOCK):
            link = a.unit[i : i + BLOCK] @ b.unit[j : j + BLOCK].T >= threshold
            rows, cols = (start + np.arange(size) for start, size in zip((i, j), link.shape, strict=True))
            if same and i == j:
                link &= rows[:, None] != cols[None, :]
            if not link.any():
                continue
            counts[rows] += link @ b.copies[cols]
            if not same or i != j:
                counts[shift + cols] += a.copies[rows] @ link
            of_row, of_col = _labels(link)
            for at, label in ((rows, of_row), (shift + cols, of_col)):
                for position, k in zip(at.tolist(), label.tolist(), strict=True):
                    if k < len(rows):
                        forest.join(position, int(rows[k]))
    hit = np.flatnonzero(counts)
    smallest: dict[int, int] = {}
    roots = [forest.root(k) for k in hit.tolist()]
    for k, root in zip(hit.tolist(), roots, strict=True):
        smallest[root] = min(smallest.get(root, int(ids[k])), int(ids[k]))
    return pa.table({"id": ids[hit], "links": counts[hit], "root": pa.array([smallest[r] for r in roots], pa.int64())})


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.9) -> DataFrame:
    """``id_col``, ``n_links``, ``component_id`` and ``kept`` for every row."""
    v = F.col("v")
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    fine = F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0)
    keyed = staged(
        rows.withColumn("ok", F.coalesce(fine, F.lit(False))).select("id", "v", "ok", F.xxhash64("v").alias("h"), F.xxhash64(F.reverse("v"), F.lit(1)).alias("g")),
        "vectors",
    )
    members = keyed.filter("ok").select("id", "h", "g")
    copies = members.distinct().groupBy("h", "g").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    first = keyed.filter("ok").join(copies, ["h", "g"]).filter("id = rep").select("rep", "copies", "v").dropDuplicates(["rep"])
    distinct = staged(first.withColumn("size", F.size("v").cast("long")), "distinct-vectors")
    tiles = max(1, -(-distinct.count() // TILE_ROWS))

    def pack(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        values = group.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        q, *bounds = quantise(unit_rows(values.reshape(group.num_rows, -1)))
        ids = group.column("rep").to_numpy().astype(np.int64)
        return pa.table({"size": [key[0].as_py()], "t": [key[1].as_py()], "ids": [ids.tobytes()], "q": [q.tobytes()], "bounds": [np.stack(bounds).tobytes()]})

    dealt = distinct.withColumn("t", F.pmod(F.xxhash64("rep"), F.lit(tiles)))
    packed = staged(dealt.groupBy("size", "t").applyInArrow(pack, "size long, t long, ids binary, q binary, bounds binary"), "tiles")
    other = packed.withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tiles - 1).cast("long"))))
    pairs = other.select("size", F.least("t", "o").alias("a"), F.greatest("t", "o").alias("b"), "t", "ids", "q", "bounds")

    def search(group: pa.Table) -> pa.Table:
        group = group.sort_by("t")
        sides = [Tile(*(group.column(c)[k].as_py() for c in ("ids", "q", "bounds"))) for k in range(group.num_rows)]
        a, b = group.column("a")[0].as_py(), group.column("b")[0].as_py()
        found = []
        if len(sides) == 2 or a == b:  # else the other tile holds no vector of this length
            of_a, of_b = possible_rows(sides[0], sides[-1], a == b, threshold)
            found = [sides[0].ids[of_a]] if a == b else [sides[0].ids[of_a], sides[1].ids[of_b]]
        reps = np.concatenate([*found, np.zeros(0, np.int64)])
        second = np.repeat([False, True][: len(found)], [len(x) for x in found])
        return pa.table({"rep": reps, "a": np.full(len(reps), a), "b": np.full(len(reps), b), "second": pa.array(second, pa.bool_())})

    near = staged(pairs.groupBy("size", "a", "b").applyInArrow(search, "rep long, a long, b long, second boolean"), "possible")

    def compare(group: pa.Table) -> pa.Table:
        group = group.sort_by("rep")
        same = group.column("a")[0].as_py() == group.column("b")[0].as_py()
        second = group.column("second").to_numpy(zero_copy_only=False).astype(bool)
        sides = []
        for part in [group] if same else [group.filter(pa.array(~second)), group.filter(pa.array(second))]:
            values = part.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            sides.append(Exact(*(part.column(c).to_numpy().astype(np.int64) for c in ("rep", "copies")), values))
        return tile_links(sides[0], sides[-1], same, threshold)

    exact = near.join(distinct, "rep").select("size", "a", "b", "second", "rep", "copies", "v")
    found = staged(exact.groupBy("size", "a", "b").applyInArrow(compare, "id long, links long, root long"), "tile-links")
    group = components(found, "id", "root").withColumnRenamed("id", "rep")
    links = found.groupBy("id").agg(F.sum("links").alias("links")).withColumnRenamed("id", "rep")
    known = copies.join(links, "rep", "left").join(group, "rep", "left")
    linked = members.join(known, ["h", "g"]).select(
        "id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    alone = keyed.filter("not ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))

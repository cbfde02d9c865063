"""Signature trees: which pairs of sets may overlap enough, by OR-combined token bitmaps.

A set of ``n`` tokens has a bitmap of the next power of two of ``2 n`` bits. Every bit that one bitmap
has and the other lacks stands for a token the other set does not hold, which bounds the overlap of
two sets from above. A node keeps the OR of its sets' bitmaps, their range of sizes and their least
number of bits, which bounds the overlap of any two sets below two nodes; a dual traversal descends
only where that bound still allows the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

LEAF = 16


def width_of(n: np.ndarray | int) -> np.ndarray:
    """Bits of the bitmap of a set of ``n`` tokens: a power of two, 64 at least."""
    return np.maximum(64, 1 << np.ceil(np.log2(2 * np.maximum(n, 1))).astype(np.int64))


def bitmap(tokens: np.ndarray, width: int) -> np.ndarray:
    bits = np.zeros(width, dtype=np.uint8)
    bits[(tokens % np.uint64(width)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def folded(maps: np.ndarray) -> np.ndarray:
    """Bitmaps of half the width for the same sets."""
    half = maps.shape[-1] // 2
    return maps[..., :half] | maps[..., half:]


def overlap_needed(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap with which sets of these sizes reach the Jaccard threshold."""
    return -((-percent * (n + m)) // (100 + percent))


def may_link(sizes_a, maps_a, sizes_b, maps_b, percent: int) -> np.ndarray:
    """Pairwise (broadcast) test of two sets by size and bitmap bound."""
    lost_a = np.bitwise_count(maps_a & ~maps_b).sum(axis=-1, dtype=np.int64)
    lost_b = np.bitwise_count(maps_b & ~maps_a).sum(axis=-1, dtype=np.int64)
    most = np.minimum(sizes_a - lost_a, sizes_b - lost_b)
    return most >= overlap_needed(sizes_a, sizes_b, percent)


class Tree:
    """Sets of one bitmap width, sorted by size; level 0 are leaves of ``LEAF`` sets."""

    def __init__(self, index: np.ndarray, sizes: np.ndarray, maps: np.ndarray):
        order = np.lexsort((maps[:, 0], sizes))
        self.index, self.sizes, self.maps = index[order], sizes[order], maps[order]
        bits = np.bitwise_count(self.maps).sum(axis=1, dtype=np.int64)
        starts = np.arange(0, len(index), LEAF)
        level = (
            np.bitwise_or.reduceat(self.maps, starts),
            np.minimum.reduceat(self.sizes, starts),
            np.maximum.reduceat(self.sizes, starts),
            np.minimum.reduceat(bits, starts),
            np.maximum.reduceat(self.sizes - bits, starts),
        )
        self.levels = [level]
        while len(level[0]) > 1:
            starts = np.arange(0, len(level[0]), 2)
            folds = (np.bitwise_or, np.minimum, np.maximum, np.minimum, np.maximum)
            level = tuple(f.reduceat(part, starts) for f, part in zip(folds, level, strict=True))
            self.levels.append(level)

    def half(self) -> Tree:
        """The same tree with bitmaps of half the width."""
        out = object.__new__(Tree)
        out.index, out.sizes, out.maps = self.index, self.sizes, folded(self.maps)
        bits = np.bitwise_count(out.maps).sum(axis=1, dtype=np.int64)
        out.levels, starts = [], np.arange(0, len(self.index), LEAF)
        least, excess = np.minimum.reduceat(bits, starts), np.maximum.reduceat(out.sizes - bits, starts)
        for k, level in enumerate(self.levels):
            if k:
                at = np.arange(0, len(least), 2)
                least, excess = np.minimum.reduceat(least, at), np.maximum.reduceat(excess, at)
            out.levels.append((folded(level[0]), level[1], level[2], least, excess))
        return out

    def leaf(self, k: int) -> slice:
        return slice(k * LEAF, min((k + 1) * LEAF, len(self.index)))


def nodes_may_link(a: tuple, i: int, b: tuple, j: int, percent: int) -> bool:
    """Whether any two sets below two nodes may reach the threshold."""
    if 100 * a[2][i] < percent * b[1][j] or 100 * b[2][j] < percent * a[1][i]:
        return False
    common = int(np.bitwise_count(a[0][i] & b[0][j]).sum())
    # a set has at most (size - bits) tokens more than bits, and only common bits can be shared
    most = min(a[4][i] + common, b[4][j] + common, a[2][i], b[2][j])
    return most >= overlap_needed(a[1][i], b[1][j], percent)


def tree_pairs(a: Tree, b: Tree, percent: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs that may link, leaf pair by leaf pair, by dual traversal."""
    stack = [(len(a.levels) - 1, 0, len(b.levels) - 1, 0)]
    while stack:
        la, i, lb, j = stack.pop()
        if same and (i << la) > ((j + 1) << lb) - 1:
            continue
        if not nodes_may_link(a.levels[la], i, b.levels[lb], j, percent):
            continue
        if la == lb == 0:
            x, y = a.leaf(i), b.leaf(j)
            fine = may_link(a.sizes[x, None], a.maps[x, None], b.sizes[None, y], b.maps[None, y], percent)
            if same and i == j:
                fine = np.triu(fine, 1)
            r, c = np.nonzero(fine)
            if len(r):
                yield a.index[x][r], b.index[y][c]
        elif la >= lb:
            stack += [(la - 1, k, lb, j) for k in (2 * i, 2 * i + 1) if k < len(a.levels[la - 1][0])]
        else:
            stack += [(la, i, lb - 1, k) for k in (2 * j, 2 * j + 1) if k < len(b.levels[lb - 1][0])]


def _bands(widths: np.ndarray) -> list[int]:
    return sorted(set(widths.tolist()))


def block_pairs(index: np.ndarray, sizes: np.ndarray, maps: list[np.ndarray], percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of one block that may link; sets whose widths are not neighbours cannot."""
    widths = np.array([len(m) for m in maps])
    trees = {}
    for w in _bands(widths):
        at = np.flatnonzero(widths == w)
        trees[w] = Tree(index[at], sizes[at], np.stack([maps[k] for k in at.tolist()]))
    for w, tree in trees.items():
        yield from tree_pairs(tree, tree, percent, True)
        if 2 * w in trees:
            yield from tree_pairs(tree, trees[2 * w].half(), percent, False)


def small_block_pairs(block: np.ndarray, sizes: np.ndarray, maps: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within blocks that are a single leaf each, for many (sorted) blocks at once."""
    n = len(block)
    left, right = [], []
    for step in range(1, LEAF):
        if n <= step:
            break
        i = np.flatnonzero(block[step:] == block[:-step])
        left.append(i)
        right.append(i + step)
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    i, j = np.concatenate(left), np.concatenate(right)
    near = (100 * sizes[i] >= percent * sizes[j]) & (100 * sizes[j] >= percent * sizes[i])
    i, j = i[near], j[near]
    widths = np.array([len(m) for m in maps])
    low = np.minimum(widths[i], widths[j])
    fine = np.zeros(len(i), dtype=bool)
    for w in _bands(low) if len(low) else ():
        at = np.flatnonzero(low == w)
        used, inverse = np.unique(np.concatenate([i[at], j[at]]), return_inverse=True)
        rows = np.stack([maps[k] if len(maps[k]) == w else folded(maps[k]) for k in used.tolist()])
        p, q = inverse[: len(at)], inverse[len(at) :]
        for s in range(0, len(at), 4096):
            e = slice(s, s + 4096)
            fine[at[e]] = may_link(sizes[i[at[e]]], rows[p[e]], sizes[j[at[e]]], rows[q[e]], percent)
    return i[fine], j[fine]

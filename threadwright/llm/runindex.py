"""A run-length index: run-compressed Burrows-Wheeler transform with suffixes sampled at run ends.

``RunIndex`` keeps, for each run of equal letters in the transform, its letter, its place, where the
run maps to, and the text positions of its first and last suffix. That is enough to stream
matching statistics: walking a text from its end, the index row that shares the longest match
with the rest of the text is followed by one step of the last-to-first mapping, or, where the
letter does not fit, from the nearest run of that letter on either side. Many texts are
walked at once, one array operation per step.
"""

from __future__ import annotations

import numpy as np

SEPARATOR, END = 0xFF, 0xFE  # bytes that never occur in UTF-8


def words_at(data: np.ndarray, at: np.ndarray | slice) -> np.ndarray:
    """Eight bytes from each position, as one number; ``data`` has eight spare bytes at the end."""
    return np.ndarray((len(data) - 7,), np.uint64, buffer=data, strides=(1,))[at].copy()


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Positions of the suffixes in order, by doubling over packed starts; the last letter must be unique.

    Each round only sorts the suffixes that are not told apart yet. Letters are bytes or numbers from 0.
    """
    n = len(text)
    if text.dtype == np.uint8:
        keys, step = words_at(np.concatenate([text, np.zeros(8, np.uint8)]), slice(0, n)).byteswap(), 8
    else:
        keys, step = text, 1
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = ranked[1:] != ranked[:-1]
    group = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))  # a suffix ranks as the first of its group
    rank = np.zeros(n + 1, np.int64)
    rank[order] = group + 1  # 0 stands for the end
    while True:
        at = np.flatnonzero(~fresh | np.concatenate([~fresh[1:], [False]]))
        if not len(at):
            return order
        members = order[at]
        after = rank[np.minimum(members + step, n)]
        within = np.lexsort((after, group[at]))
        members, after, heads = members[within], after[within], group[at]
        order[at] = members
        split = np.ones(len(at), dtype=bool)
        split[1:] = (heads[1:] != heads[:-1]) | (after[1:] != after[:-1])
        fresh[at] = split
        group[at] = np.maximum.accumulate(np.where(split, at, 0))
        rank[members] = group[at] + 1
        step *= 2


def common_prefix(a: np.ndarray, at_a: np.ndarray, b: np.ndarray, at_b: np.ndarray, limit: int) -> np.ndarray:
    """Length of the common prefix from each pair of positions, up to about ``limit``."""
    out = np.zeros(len(at_a), np.int64)
    alive = np.arange(len(at_a))
    for step in range(0, limit, 8):
        if not len(alive):
            break
        x = words_at(a, at_a[alive] + step) ^ words_at(b, at_b[alive] + step)
        low = x & (~x + np.uint64(1))  # lowest differing bit
        same = np.where(x == 0, 8, np.bitwise_count(low - np.uint64(1)).astype(np.int64) // 8)
        out[alive] += same
        alive = alive[same == 8]
    return out


def common_letters(a: np.ndarray, at_a: np.ndarray, b: np.ndarray, at_b: np.ndarray, limit: int) -> np.ndarray:
    """The same for letters that are numbers."""
    out = np.zeros(len(at_a), np.int64)
    alive = np.arange(len(at_a))
    for step in range(limit):
        alive = alive[a[at_a[alive] + step] == b[at_b[alive] + step]]
        out[alive] += 1
    return out


class RunIndex:
    def __init__(self, text: np.ndarray, limit: int):
        """``text`` is bytes without ``END``, or numbers from 0; matches are only told apart up to ``limit`` letters."""
        self.limit = limit
        small = text.dtype == np.uint8
        self.shared = common_prefix if small else common_letters
        body = np.append(text, np.uint8(END) if small else text.max(initial=0) + 1)
        order = suffix_array(body)
        letters = body[order - 1]
        change = np.ones(len(body), dtype=bool)
        change[1:] = letters[1:] != letters[:-1]
        self.start = np.flatnonzero(change)
        self.letter = letters[self.start].astype(np.int64)
        length = np.diff(np.append(self.start, len(body)))
        by_letter = np.lexsort((self.start, self.letter))
        self.target = np.empty(len(self.start), np.int64)  # where the first row of the run maps to
        self.target[by_letter] = np.concatenate([[0], np.cumsum(length[by_letter])[:-1]])
        self.first, self.last = order[self.start], order[self.start + length - 1]
        self.length = length
        self.keys = self.letter[by_letter] * len(self.start) + by_letter  # rising
        self.run_of_key = by_letter
        self.padded = np.concatenate([body, np.full(limit + 16, SEPARATOR if small else body[-1] + 1, body.dtype)])

    def pointers(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Walk ``data[begin:end]`` of every piece from its end.

        Returns positions in ``data`` and, for each, the text position of a longest match there.
        ``data`` has ``limit + 16`` spare bytes at its end.
        """
        order = np.argsort(begin - end, kind="stable")  # longest first: live pieces are a prefix
        begin, end = begin[order], end[order]
        lengths = end - begin
        run = np.zeros(len(begin), np.int64)
        row = np.zeros(len(begin), np.int64)
        place = np.full(len(begin), self.first[0], np.int64)
        positions, found = [], []
        n = len(self.start)
        for step in range(int(lengths.max(initial=0))):
            live = int(np.searchsorted(-lengths, -step, side="left"))
            at = end[:live] - 1 - step
            c = data[at].astype(np.int64)
            r, q, p = run[:live], row[:live], place[:live]
            odd = np.flatnonzero(self.letter[r] != c)
            if len(odd):
                slot = np.searchsorted(self.keys, c[odd] * n + r[odd])
                above = np.maximum(slot - 1, 0)
                below = np.minimum(slot, n - 1)
                up, down = self.run_of_key[above], self.run_of_key[below]
                has_up = (slot > 0) & (self.letter[up] == c[odd])
                has_down = (slot < n) & (self.letter[down] == c[odd])
                rest = at[odd] + 1
                both = has_up & has_down
                use_up = has_up.copy()
                if both.any():
                    k = np.flatnonzero(both)
                    longer = self.shared(data, rest[k], self.padded, self.last[up[k]], self.limit) >= self.shared(
                        data, rest[k], self.padded, self.first[down[k]], self.limit
                    )
                    use_up[k] = longer
                r[odd] = np.where(use_up, up, np.where(has_down, down, 0))
                q[odd] = np.where(use_up, self.start[up] + self.length[up] - 1, np.where(has_down, self.start[down], 0))
                p[odd] = np.where(use_up, self.last[up], np.where(has_down, self.first[down], self.first[0]))
                lost = odd[~(has_up | has_down)]
            else:
                lost = odd
            q[:] = self.target[r] + q - self.start[r]
            p -= 1
            np.maximum(p, 0, out=p)
            q[lost], p[lost] = 0, self.first[0]
            r[:] = np.searchsorted(self.start, q, side="right") - 1
            positions.append(at)
            found.append(p.copy())
        empty = np.zeros(0, np.int64)
        return (np.concatenate(positions), np.concatenate(found)) if positions else (empty, empty)

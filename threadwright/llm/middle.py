"""Fill-in-the-middle transformation with rank and select on the UTF-8 bytes, eight at a time.

A chunk of texts is viewed as little-endian uint64 words. Plain arithmetic marks, in the high bit of
each byte, the bytes that end a unit (a word with the blanks before it, or blanks at the end of a
text) and the bytes that begin a code point. Population counts of the words and their running sum
answer "how many before this byte" (rank); the k-th mark is found by binary search in the running
sum, then inside the word by comparing the byte-wise prefix counts with the rest (select). No unit
is ever materialised, and all documents of a chunk are cut at once.

Defined results: a null text is empty, and empty texts stay plain with no unit; so do texts that hold
a sentinel. A null id draws as the empty string does. Repeated rows come out as often as they occur.
Extra columns pass through, but those named like an output are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_chunks, utf8

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINEL = "<[PSM]>"
MADE = ["n", "form", "prefix_chars", "middle_chars", "output"]

_ONES = np.uint64(0x0101010101010101)
_HIGH = np.uint64(0x8080808080808080)
_LOW = np.uint64(0x7F7F7F7F7F7F7F7F)
_BYTE, _ONE, _SEVEN = np.uint64(8), np.uint64(1), np.uint64(7)


def view_words(data: np.ndarray) -> np.ndarray:
    """The bytes as uint64 words, with zero bytes behind them (at least one)."""
    padded = np.zeros((len(data) // 8 + 1) * 8, np.uint8)
    padded[: len(data)] = data
    return padded.view("<u8")


def blank_bytes(x: np.ndarray) -> np.ndarray:
    """High bit of every byte that is a space or one of the characters 9 to 13.

    Additions to 7-bit values reach the high bit exactly from a threshold on, and never the next byte.
    """
    seven = x & _LOW
    no_space = (seven ^ (_ONES * np.uint64(0x20))) + _LOW
    from_9, from_14 = seven + _ONES * np.uint64(0x80 - 9), seven + _ONES * np.uint64(0x80 - 14)
    return (~no_space | (from_9 & ~from_14)) & ~x & _HIGH


def unit_ends(x: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """High bit of every byte that ends a unit: before a blank if not blank itself, or last of its text."""
    blank = blank_bytes(x)
    following = blank >> _BYTE
    following[:-1] |= blank[1:] << np.uint64(56)
    ends = ~blank & following & _HIGH
    last = offsets[1:][np.diff(offsets) > 0] - 1
    ends.view(np.uint8)[last] |= 0x80
    return ends


def point_starts(x: np.ndarray) -> np.ndarray:
    """High bit of every byte that begins a code point."""
    return ~(x & ~(x << _ONE)) & _HIGH


class Marks:
    """Rank and select over marked bytes."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(marks), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Number of marked bytes before each position."""
        word = at >> 3
        inside = (_ONE << (_BYTE * (at & 7).astype(np.uint64))) - _ONE
        return self.before[word] + np.bitwise_count(self.marks[word] & inside)

    def select(self, k: np.ndarray) -> np.ndarray:
        """Position of each ``k``-th marked byte, counted from 1."""
        word = np.searchsorted(self.before[1:], k)
        rest = (k - self.before[word]).astype(np.uint64)
        counts = (self.marks[word] >> _SEVEN) * _ONES  # byte i: marks in the bytes up to i
        reached = ((counts | _HIGH) - rest * _ONES) & _HIGH
        return 8 * word + 8 - np.bitwise_count(reached).astype(np.int64)


def draws(ids: Sequence[str | None], seed: int) -> np.ndarray:
    """Four 32-bit numbers of each id."""
    digests = b"".join(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids)
    return np.frombuffer(digests, ">u4").reshape(-1, 4).astype(np.int64)


def arrange(data: np.ndarray, offsets: np.ndarray, plain: np.ndarray, h: np.ndarray, spm_percent: int) -> tuple:
    """Units, form, code points of prefix and middle, and output of every text of a chunk.

    ``plain`` flags texts that stay as they are whatever the draws say.
    """
    x = view_words(data)
    units, points = Marks(unit_ends(x, offsets)), Marks(point_starts(x))
    start, end = offsets[:-1], offsets[1:]
    first = units.rank(start)
    n = units.rank(end) - first
    plain = plain | (n == 0)
    a, b = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
    cuts = []
    for k in (np.minimum(a, b), np.maximum(a, b)):
        cut, some = start.copy(), k > 0
        cut[some] = units.select((first + k)[some]) + 1
        cuts.append(cut)
    spm = h[:, 3] % 100 < spm_percent
    form = np.where(plain, "plain", np.where(spm, "spm", "psm"))
    ranks = [points.rank(at) for at in (start, *cuts)]
    body, output = memoryview(data), []
    for i, (s, p, q, e) in enumerate(zip(start.tolist(), cuts[0].tolist(), cuts[1].tolist(), end.tolist(), strict=True)):
        if plain[i]:
            output.append(bytes(body[s:e]))
        elif spm[i]:
            output.append(b"".join((SUFFIX, body[q:e], PREFIX, body[s:p], MIDDLE, body[p:q])))
        else:
            output.append(b"".join((PREFIX, body[s:p], SUFFIX, body[q:e], MIDDLE, body[p:q])))
    chars = [pa.array(hi - lo, pa.int64(), mask=plain) for lo, hi in pairwise(ranks)]
    return pa.array(n, pa.int64()), pa.array(form.tolist(), pa.string()), *chars, pa.array(output, pa.binary()).view(pa.string())


def fill_in_middle(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    columns: Sequence[str] | None = None,
    seed: int = 42,
    percent: int = 50,
    spm_percent: int = 80,
) -> DataFrame:
    """The listed columns (default: all but the text) with ``n`` units, ``form``, lengths and ``output``."""
    kept = [c for c in (df.columns if columns is None else columns) if c != text_col and c not in MADE]
    schema = T.StructType([df.schema[c] for c in kept])
    for name in MADE:
        schema = schema.add(name, "string" if name in ("form", "output") else "long")

    def transform(batches):
        for batch in text_chunks(batches, text_col):
            data, offsets = utf8(batch.column(text_col))
            h = draws(batch.column("__id").to_pylist(), seed)
            plain = (h[:, 2] % 100 >= percent) | np.asarray(pc.match_substring_regex(batch.column(text_col), SENTINEL).fill_null(False))
            made = arrange(np.ascontiguousarray(data), offsets, plain, h, spm_percent)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *made], names=[*kept, *MADE])

    keyed = df.withColumn("__id", F.col(id_col).cast("string"))
    return keyed.select(*dict.fromkeys([*kept, text_col, "__id"])).mapInArrow(transform, schema)


def restored(output: Column, form: Column) -> Column:
    """The text an output was made from; exact, as no sentinel can arise where pieces meet."""
    piece = F.split(output, SENTINEL, -1)
    at = [F.get(piece, F.lit(i)) for i in range(4)]
    return F.when(form == "psm", F.concat(at[1], at[3], at[2])).when(form == "spm", F.concat(at[2], at[3], at[1])).otherwise(output)

"""Best-fit-decreasing packing of tokenised documents into fixed-length sequences.

Only the *number* of pieces of each length decides how best fit packs them, so the packing is
planned on at most ``capacity`` counts. The planner keeps the open bins by remaining capacity in
a segment tree and finds the tightest one that fits in logarithmic time; bins with equal
remaining capacity, and pieces of equal length, are handled as runs, so the plan stays small
however many documents there are. Spark then gives each piece its rank among the pieces of its
length and reads its place off the plan: no task ever sees all pieces.

Defined results: a null text is an empty one and still gets the end id. Texts longer than
``capacity`` ids are cut into full pieces; the last may be shorter. Ties between equal bins or equal
pieces are broken by rank. Repeated rows are packed as often as they occur. An empty table gives
no rows. Other columns are dropped unless named.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import CHUNK_BYTES, Words, partitions, staged, text_chunks, utf8

CACHE_WORDS = 2_000_000  # about 30 bytes each
_SEPARATOR, _SEPARATOR_ID = "<|startoftext|>", 49406
_TAIL = np.zeros(256, dtype=bool)
_TAIL[list(b".,;:!?|)")] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[b for b in range(128) if chr(b).isalpha()]] = True


class WordEncoder:
    """Ids of whole texts by way of a cache of words.

    The vocabulary's rules never join characters across white space, nor a letter with the
    punctuation after it, and they lower-case; so a text's ids are those of its words in order,
    and a trailing run of plain punctuation may be encoded apart. Words that hold the separator
    themselves are encoded alone. The cache is a few flat arrays, looked up by binary search for all words of a
    chunk at once; it tells words apart by 64-bit hashes, as the deduplicating operators do.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)  # sorted hashes of words, and the place of each among the words
        self.place = np.zeros(0, np.int64)
        self.ids = np.zeros(1 << 20, np.uint16)
        self.starts = np.zeros(1 << 16, np.int64)
        self.n_ids = self.n_words = 0

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, one after the other, and how many each has; none may hold the separator."""
        ids = np.array(self.tokenizer.encode_batch_fast([_SEPARATOR.join(words)], add_special_tokens=False)[0].ids, np.uint16)
        between = ids == _SEPARATOR_ID
        return ids[~between], np.diff(np.flatnonzero(between), prepend=-1, append=len(ids)) - 1

    def _learn(self, words: list[str], hashes: np.ndarray) -> None:
        """Add words by their hashes, which are sorted and new."""
        alone = {k for k, w in enumerate(words) if _SEPARATOR in w}
        found: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        for i in range(0, len(words), 2000):
            group = words[i : i + 2000]
            special = [k for k in range(len(group)) if i + k in alone] if alone else []
            ids, lengths = self._encoded(["" if i + k in alone else w for k, w in enumerate(group)] if special else group)
            for k in reversed(special):
                own = np.array(self.tokenizer.encode(group[k], add_special_tokens=False).ids, np.uint16)
                ids, lengths[k] = np.insert(ids, int(lengths[:k].sum()), own), len(own)
            found.append(ids)
            counts.append(lengths)
        lengths = np.concatenate(counts)
        end, n = self.n_ids + int(lengths.sum()), self.n_words + len(words)
        if end > len(self.ids):
            self.ids = np.resize(self.ids, max(end, 2 * len(self.ids)))
        if n + 1 > len(self.starts):
            self.starts = np.resize(self.starts, max(n + 1, 2 * len(self.starts)))
        self.ids[self.n_ids : end] = np.concatenate(found)
        self.starts[self.n_words : n + 1] = self.n_ids + np.concatenate([[0], np.cumsum(lengths)])
        at = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, at, hashes)
        self.place = np.insert(self.place, at, np.arange(self.n_words, n))
        self.n_ids, self.n_words = end, n

    def _unknown(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.arange(len(hashes))
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.flatnonzero(self.known[at] != hashes)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the offsets of the texts."""
        data, offsets = utf8(column)
        words = Words(data, offsets)
        if not len(words):
            return np.zeros(0, np.uint16), np.zeros(len(offsets), np.int64)
        data = data.copy()
        initial = data[words.starts]
        upper = (initial >= 65) & (initial <= 90)
        data[words.starts[upper]] += 32
        # the last byte that is not plain punctuation; cut there if it is an ASCII letter
        core = np.maximum.accumulate(np.where(_TAIL[data], -1, np.arange(len(data))))[words.ends - 1] + 1
        cut = (core > words.starts) & (core < words.ends) & _LETTER[data[np.maximum(core, 1) - 1]]
        at = np.repeat(np.arange(len(words)), 1 + cut)
        second = np.zeros(len(at), dtype=bool)
        second[1:] = at[1:] == at[:-1]
        words.starts, words.ends = np.where(second, core[at], words.starts[at]), np.where(cut[at] & ~second, core[at], words.ends[at])
        hashes = words.hashes(data)
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        fresh = self._unknown(distinct)
        if self.n_words + len(fresh) > CACHE_WORDS:  # the cache starts anew and must hold all of this chunk
            self._forget()
            fresh = np.arange(len(distinct))
        if len(fresh):
            body = data.tobytes()
            spans = zip(words.starts[first[fresh]].tolist(), words.ends[first[fresh]].tolist(), strict=True)
            self._learn([body[s:e].decode() for s, e in spans], distinct[fresh])
        index = self.place[np.searchsorted(self.known, distinct)][inverse]
        begin, lengths = self.starts[index], self.starts[index + 1] - self.starts[index]
        total = np.concatenate([[0], np.cumsum(lengths)])
        take = np.arange(total[-1]) + np.repeat(begin - total[:-1], lengths)
        first_word = np.searchsorted(words.starts, offsets)
        return self.ids[take], total[first_word]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder_of(path: str) -> WordEncoder:
    """One encoder per Python worker and vocabulary, so that its cache outlives a task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def tokenized_pieces(
    df: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 4096,
    end_id: int = 1,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``capacity`` ids: id, piece, start, length, ids_crc32 and optionally the ids."""
    schema = T.StructType([df.schema[id_col]]).add("piece", "integer").add("start", "long").add("length", "long").add("ids_crc32", "long")
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))

    def pieces(batches):
        encoder = encoder_of(tokenizer_path)
        for batch in text_chunks(batches, text_col, CHUNK_BYTES):
            flat, offsets = encoder.encode(batch.column(text_col))
            rows, piece, start, length, crc, lists = [], [], [], [], [], []
            ended = offsets + np.arange(len(offsets))  # with one end id a document
            ids = np.full(ended[-1], end_id, "<u4")
            inner = np.ones(ended[-1], dtype=bool)
            inner[ended[1:] - 1] = False
            ids[inner] = flat
            for row, (first, end) in enumerate(pairwise(ended.tolist())):
                for k, at in enumerate(range(0, end - first, capacity)):
                    part = ids[first + at : min(first + at + capacity, end)]
                    rows.append(row)
                    piece.append(k)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        lists.append(part)
            columns = [
                batch.column(id_col).take(pa.array(rows, pa.int64())),
                pa.array(piece, pa.int32()),
                *(pa.array(x, pa.int64()) for x in (start, length, crc)),
                *([pa.array(lists, pa.list_(pa.int32()))] if with_ids else []),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.select(*dict.fromkeys([id_col, text_col])).mapInArrow(pieces, schema)


class CapacityTree:
    """Segment tree over remaining capacities; knows for which ones a bin is open."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.size)

    def mark(self, remaining: int, is_open: bool) -> None:
        i = remaining + self.size
        self.open[i] = is_open
        while i > 1:
            i //= 2
            self.open[i] = self.open[2 * i] or self.open[2 * i + 1]

    def tightest(self, need: int) -> int | None:
        """Smallest remaining capacity of at least ``need`` with an open bin."""
        i = need + self.size
        if self.open[i]:
            return need
        while i > 1:
            if i % 2 == 0 and self.open[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.open[2 * i] else 2 * i + 1
                return i - self.size
            i //= 2
        return None


@dataclass(frozen=True)
class Run:
    """Pieces of one length, by rank: ``per_bin`` in each of consecutive bins, from ``offset`` on."""

    length: int
    first_rank: int
    count: int
    first_bin: int
    per_bin: int
    offset: int


def best_fit_plan(counts: dict[int, int], capacity: int) -> tuple[list[Run], int]:
    """Best-fit decreasing over piece counts by length; the runs and the number of bins.

    The tightest bin stays the tightest while it takes pieces of one length, so it takes as many
    as fit; equal bins do the same one after the other.
    """
    tree, spans = CapacityTree(capacity), {r: [] for r in range(capacity + 1)}
    runs: list[Run] = []
    bins = 0

    def put(remaining: int, span: tuple[int, int]) -> None:
        if span[0] < span[1] and remaining:
            spans[remaining].append(span)
            tree.mark(remaining, True)

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            remaining = tree.tightest(length)
            if remaining is None:
                remaining, per_bin = capacity, capacity // length
                first = bins
                bins += -(-left // per_bin)
                last = bins
            else:
                first, last = spans[remaining].pop()
                tree.mark(remaining, bool(spans[remaining]))
                per_bin = remaining // length
            full = min(left // per_bin, last - first)
            if full:
                runs.append(Run(length, rank, full * per_bin, first, per_bin, capacity - remaining))
                put(remaining - per_bin * length, (first, first + full))
                rank += full * per_bin
                left -= full * per_bin
                first += full
            if left and first < last:
                runs.append(Run(length, rank, left, first, per_bin, capacity - remaining))
                put(remaining - left * length, (first, first + 1))
                first, left = first + 1, 0
            put(remaining, (first, last))
    return runs, bins


def pack(pieces: DataFrame, capacity: int = 4096, id_col: str = "doc_id", buckets: int | None = None) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces (``id_col``, ``piece``, ``length``, ...).

    Ranks within a length come from ranks within (length, hash bucket) and the buckets' sizes, so
    a length that a third of all pieces share is spread over all buckets.
    """
    buckets = buckets or max(64, 4 * partitions(pieces))
    counts = {int(n): int(c) for n, c in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    runs, _ = best_fit_plan(counts, capacity)
    columns = np.array([(r.length, r.first_rank, r.first_bin, r.per_bin, r.offset) for r in runs], np.int64).reshape(-1, 5)
    ranks = columns[:, :2]  # sorted by falling length and rising rank
    bounds = {int(n): (int(a), int(b)) for n, a, b in zip(*_ranges(ranks[:, 0]), strict=True)}

    keyed = pieces.withColumn("__b", F.pmod(F.xxhash64(id_col, "piece"), F.lit(buckets)))
    sizes = keyed.groupBy("length", "__b").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("length").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy("length", "__b").orderBy(id_col, "piece")
    ranked = (
        keyed.withColumn("__rank", F.row_number().over(inside) - 1)
        .join(starts, ["length", "__b"])
        .withColumn("__rank", F.col("__rank") + F.col("__start"))
        .select(*pieces.columns, "__rank")
    )
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    schema = T.StructType([pieces.schema[c] for c in kept]).add("sequence_id", "long").add("offset", "long")

    def place(batches):
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "__rank"))
            at = np.zeros(len(length), np.int64)
            for n in np.unique(length):
                of, (a, b) = length == n, bounds[int(n)]
                at[of] = a + np.searchsorted(columns[a:b, 1], rank[of], side="right") - 1
            _, first_rank, first_bin, per_bin, offset = columns[at].T
            step = rank - first_rank
            sequence, place_in = first_bin + step // per_bin, offset + step % per_bin * length
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(sequence), pa.array(place_in)], names=schema.names)

    return ranked.mapInArrow(place, schema)


def _ranges(keys: np.ndarray) -> tuple[Sequence[int], Sequence[int], Sequence[int]]:
    """Keys of consecutive equal values with their begin and end."""
    begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[begin], begin, np.append(begin[1:], len(keys)) if len(keys) else begin

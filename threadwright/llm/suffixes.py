"""Byte-level deduplication of long repeated strings with a run-length index.

A window of 50 bytes recurs if it starts in several documents. Documents are compared in steps
that move little data:

1. Documents are stored once in blocks of bounded bytes. Of every window the smallest hash of its inner byte
   runs is its *anchor*; consecutive windows with one anchor form a *piece*.
2. Each block asks once for every distinct piece, whichever of its documents hold it: what it asks is dealt out by
   hash of the anchor, and the answers come back to the block. Pieces that are equal in several documents are settled by
   the smallest of them. Only where an anchor comes with different pieces are their windows compared one by one, once
   per distinct piece, and only if the anchor recurs with more of its surroundings.
3. A block builds a run-length index over the confirmed stretches of its documents, streams matching statistics of the
   documents' candidate stretches, compares the bytes of what it finds and marks matches whose first document is smaller.
   The letters of the index are whole pieces (or the confirmed part of one), not bytes.

Questions and answers travel as packed arrays, one row for each block and bucket: a string in very many documents is
asked for once a block, and no document's or string's rows are gathered in one place. Strings are told apart by 64-bit
hashes of their bytes. A block's index is built from the block's own matching windows, so it does not verify what the
hashes found. Everything is judged on the input.

Defined results: a null text is empty; one shorter than a window loses nothing. Rows with a null id
are left as they are and do not count as earlier documents. Repeated rows share an id and do not
dedup each other. Removed bytes may split a character, so what is kept is bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import mix, partitions, release, row_sums, sliding, staged, text_chunks, utf8
from .runindex import SEPARATOR, RunIndex, common_prefix, words_at

WINDOW, GRAM = 50, 24
CHUNK = 1 << 18  # bytes of text at once; several arrays of eight bytes per byte are alive
BLOCK = 1 << 21  # bytes of text that ask together
BUCKET = 1 << 25  # bytes of text whose questions make up a bucket
SPAN = 32  # pieces that the index is walked over at once
NONE = np.iinfo(np.uint64).max
_LOW = np.uint64(0xFFFFFFFF)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], np.uint64)


def span_hashes(padded: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``size`` bytes (24 to 56) from each position."""
    out = np.zeros(len(at), np.uint64)
    for k, offset in enumerate(inner(size, 8)):
        out += words_at(padded, at + offset) * _ODD[k]
        out ^= out >> np.uint64(31)
    return mix(out)


def inner(size: int, part: int) -> list[int]:
    """Offsets of parts that cover ``size``."""
    return [*range(0, size - part, part), size - part]


def gram_hashes(padded: np.ndarray, n: int, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes from each of the first ``n`` positions."""
    words = words_at(padded, slice(0, n + gram - 8))
    out = words[:n] * _ODD[0]
    shifted = np.empty(n, np.uint64)
    for k, offset in enumerate(inner(gram, 8)[1:], 1):
        out ^= np.right_shift(out, np.uint64(31), out=shifted)
        out += words[offset : offset + n]
        out *= _ODD[k % len(_ODD)]
    return out


class Pieces:
    """Windows of a chunk, grouped into pieces: their first and last window, rows and anchors."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int, gram: int):
        self.data, self.offsets, self.window, self.gram = data, offsets, window, gram
        self.padded = np.concatenate([data, np.full(window + 16, SEPARATOR, np.uint8)])
        rows = np.flatnonzero(np.diff(offsets) >= window)  # rows with a window
        if len(rows):
            self.grams = gram_hashes(self.padded, len(data) - gram + 1, gram)
            anchor = sliding(self.grams, window - gram + 1, np.minimum)
            fresh = np.ones(len(anchor), dtype=bool)
            np.not_equal(anchor[1:], anchor[:-1], out=fresh[1:])
            starts, ends = offsets[rows], offsets[rows + 1] - window + 1
            fresh[starts] = True
            fresh[ends[ends < len(fresh)]] = True  # windows across two rows are put aside
            begin = np.flatnonzero(fresh)
            stop = np.append(begin[1:], len(anchor))
            row = np.searchsorted(offsets, begin, side="right") - 1
            fine = offsets[row + 1] - begin >= window
            begin, stop, row = begin[fine], stop[fine], row[fine]
            # a long run of one anchor is cut, so that its first and last window cover a piece
            part = window // 2
            parts = -(-(stop - begin) // part)
            step = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
            begin, stop, self.piece_row = (np.repeat(x, parts) for x in (begin, stop, row))
            self.begin = begin + step * part
            self.last = np.minimum(self.begin + part, stop) - 1
            self.anchor = anchor[self.begin]
        else:
            self.grams = self.anchor = np.zeros(0, np.uint64)
            self.begin = self.last = self.piece_row = np.zeros(0, np.int64)
        self.piece = self.stretch_hashes(self.begin, self.last)

    def stretch_hashes(self, begin: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hash of the bytes of windows ``begin`` to ``last``, at most half a window apart."""
        out = (last - begin).astype(np.uint64)
        for at in (begin, last):
            for offset in inner(self.window, self.gram):
                out += self.grams[at + offset]
                out = mix(out)
        return out

    def windows(self, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows of some pieces, and the piece of each."""
        count = self.last[pieces] - self.begin[pieces] + 1
        step = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        return np.repeat(self.begin[pieces], count) + step, np.repeat(pieces, count)

    def ends(self, pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Piece and hash of the anchors widened by half of what a window adds, to either side; and pieces with several anchors.

        A window holds its anchor with at least that much more on one side. All places of a piece's anchor
        are widened, as another text may have the piece with fewer of them.
        """
        more = (self.window - self.gram + 1) // 2
        count = self.last[pieces] - self.begin[pieces] + 1 + self.window - self.gram
        of = np.repeat(np.arange(len(pieces)), count)
        at = self.begin[pieces[of]] + np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
        here = self.grams[at] == self.anchor[pieces[of]]
        of, at = of[here], at[here]
        places = np.bincount(of, minlength=len(pieces))
        row, sides = self.piece_row[pieces[of]], []
        for start, side in ((at - more, np.uint64(1)), (at, np.uint64(0))):
            fits = (start >= self.offsets[row]) & (start + self.gram + more <= self.offsets[row + 1])
            sides.append((pieces[of[fits]], mix(span_hashes(self.padded, start[fits], self.gram + more) + side)))
        return *(np.concatenate(x) for x in zip(*sides, strict=True)), pieces[places > 1]


# --- questions and answers ----------------------------------------------------------------


class Deal:
    """How ids and questions are packed: ids count from the smallest, in four bytes if that is enough."""

    def __init__(self, low: int, high: int, size: int, tasks: int):
        self.low, self.buckets = low, max(4 * tasks, -(-size // BUCKET))
        doc = "<u4" if high - low < 2**32 - 1 else "<u8"
        self.question = np.dtype([("key", "<u4"), ("sub", "<u8"), ("doc", doc)])
        self.answer = np.dtype([("sub", "<u8"), ("first", doc), ("several", "u1")])

    def docs(self, column: pa.Array) -> np.ndarray:
        return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) - np.int64(self.low).view(np.uint64)


def packed(place: np.ndarray, records: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Places that have records, and the records of each as bytes."""
    small = place.astype(np.uint16) if place.max(initial=0) < 2**16 else place  # sorted by counting
    order = np.argsort(small, kind="stable")
    place, records = place[order], records[order]
    fresh = np.ones(len(place), dtype=bool)
    fresh[1:] = place[1:] != place[:-1]
    begin = np.flatnonzero(fresh)
    ends = (np.append(begin, len(place)) * records.dtype.itemsize).astype(np.int32)
    blobs = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(ends), pa.py_buffer(records)])
    return pa.array(place[begin].astype(np.int64)), blobs


def unpacked(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """Records of a column of bytes, and the row of each."""
    data, offsets = utf8(column)
    return data.view(kind), np.repeat(np.arange(len(column)), np.diff(offsets) // kind.itemsize)


def questions(block: int, key: np.ndarray, sub: np.ndarray, doc: np.ndarray, deal: Deal, once: bool = True) -> pa.RecordBatch:
    """What a block asks, dealt out by ``key``.

    ``once``: a ``sub`` has one ``key``, and is asked for by its first and last document in the block only.
    """
    if once and len(sub):
        order = np.argsort(sub)
        key, sub, doc = key[order], sub[order], doc[order]
        begin = np.flatnonzero(np.concatenate([[True], sub[1:] != sub[:-1]]))
        low, high = np.minimum.reduceat(doc, begin), np.maximum.reduceat(doc, begin)
        also = begin[low < high]
        key, sub = (np.concatenate([x[begin], x[also]]) for x in (key, sub))
        doc = np.concatenate([low, high[low < high]])
    made = np.empty(len(key), deal.question)
    made["key"], made["sub"], made["doc"] = key & _LOW, sub, doc
    bucket, blobs = packed(((key >> np.uint64(32)) % np.uint64(deal.buckets)).astype(np.int64), made)
    return pa.RecordBatch.from_arrays([bucket, pa.array(np.full(len(bucket), block)), blobs], names=["bucket", "block", "blob"])


def answered(asked: DataFrame, deal: Deal, name: str, every: bool = False) -> DataFrame:
    """Per block what it is told: for each ``sub`` of a key that recurs its first document.

    Documents learn of a smaller one that has the ``sub``, and the first one whether the key has ``several``. ``every``: all
    that share a key with another document are answered.
    """

    def judged(table: pa.Table) -> pa.Table:
        asking = table.column("block").to_numpy()
        records, row = unpacked(table.column("blob").combine_chunks(), deal.question)
        key, sub = records["key"].astype(np.uint64), records["sub"].copy()
        joint = (key << np.uint64(32)) | (sub >> np.uint64(32))
        order = np.argsort(joint)
        joint, sorted_sub = joint[order], sub[order]
        if ((joint[1:] == joint[:-1]) & (sorted_sub[1:] != sorted_sub[:-1])).any():
            order = np.lexsort((sub, key))
        key, sub, doc, block = key[order], sub[order], records["doc"][order], asking[row[order]]
        new_key = np.concatenate([[True], key[1:] != key[:-1]])
        new_sub = new_key | np.concatenate([[True], sub[1:] != sub[:-1]])
        subs, keys = np.flatnonzero(new_sub), np.flatnonzero(new_key)
        of_sub, of_key = np.cumsum(new_sub) - 1, np.cumsum(new_key) - 1
        first = np.minimum.reduceat(doc, subs)[of_sub]
        keep = (np.minimum.reduceat(doc, keys) < np.maximum.reduceat(doc, keys))[of_key]
        several = (np.add.reduceat(new_sub.astype(np.int64), keys) > 1)[of_key]
        if not every:
            keep &= (doc > first) | several
        made = np.empty(int(keep.sum()), deal.answer)
        made["sub"], made["first"], made["several"] = sub[keep], first[keep], several[keep]
        number, place = np.unique(block[keep], return_inverse=True)
        place, blobs = packed(place, made)
        return pa.table({"block": pa.array(number[place.to_numpy()].astype(np.int64)), "blob": blobs})

    told = staged(asked.groupBy("bucket").applyInArrow(judged, "block long, blob binary"), name)
    release(spark=asked.sparkSession)
    return told


def told(table: pa.Table, deal: Deal) -> np.ndarray:
    """Answers to a block by rising ``sub``, each once."""
    answers = unpacked(table.column("blob").combine_chunks(), deal.answer)[0] if table.num_rows else np.empty(0, deal.answer)
    answers = answers[np.argsort(answers["sub"])]
    fresh = np.ones(len(answers), dtype=bool)
    fresh[1:] = answers["sub"][1:] != answers["sub"][:-1]
    return answers[fresh]


def looked_up(sub: np.ndarray, answers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``sub`` are answered, and the index of their answers."""
    subs = answers["sub"].copy()
    if not len(subs):
        return np.zeros(len(sub), dtype=bool), np.zeros(len(sub), np.int64)
    slot = np.minimum(np.searchsorted(subs, sub), len(subs) - 1)
    return subs[slot] == sub, slot


def first_pieces(p: Pieces, docs: np.ndarray, answers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each piece the smaller document that has it, or ``NONE``; and whether its windows are compared with other pieces."""
    found, slot = looked_up(p.piece, answers)
    if not len(answers):
        return np.full(len(p.piece), NONE), found
    first, doc = answers["first"][slot].astype(np.uint64), docs[p.piece_row]
    return np.where(found & (first < doc), first, NONE), found & (first == doc) & (answers["several"][slot] > 0)


# --- the steps ----------------------------------------------------------------------------


def in_blocks(docs: DataFrame, text_col: str) -> DataFrame:
    """Rows with the number of their block as ``__block``; stored, so that it stays the same."""
    schema = T.StructType([*docs.schema.fields, T.StructField("__block", T.LongType())])

    def numbered(batches):
        block = TaskContext.get().partitionId() << 32
        for batch in text_chunks(batches, text_col, BLOCK):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, block))], names=schema.names)
            block += 1

    return staged(docs.mapInArrow(numbered, schema), "byte-blocks")


def same_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Consecutive rows of one block; a block may come in several parts."""
    for batch in batches:
        block = batch.column("block").to_numpy()
        begin = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])) if len(block) else []
        for a, b in zip(begin, [*begin[1:], len(block)], strict=True):
            yield int(block[a]), batch.slice(a, b - a)


def asked_by(rows: pa.Table | pa.RecordBatch, deal: Deal, window: int, gram: int, ask: Callable) -> list[np.ndarray]:
    """Key, sub and document of what ``ask`` makes of the chunks of a block."""
    parts = [(np.zeros(0, np.uint64),) * 3]
    batches = rows.combine_chunks().to_batches() if isinstance(rows, pa.Table) else [rows]
    for chunk in text_chunks(batches, "text", CHUNK):
        parts.append(ask(Pieces(*utf8(chunk.column("text")), window, gram), deal.docs(chunk.column("doc"))))
    return [np.concatenate(x) for x in zip(*parts, strict=True)]


QUESTIONS = "bucket long, block long, blob binary"


def shared_pieces(texts: DataFrame, deal: Deal, window: int, gram: int) -> DataFrame:
    """Per block its pieces that a smaller document has, and those to compare window by window."""

    def ask(batches):
        for block, rows in same_block(batches):
            yield questions(block, *asked_by(rows, deal, window, gram, lambda p, docs: (mix(p.anchor), p.piece, docs[p.piece_row])), deal)

    return answered(texts.mapInArrow(ask, QUESTIONS), deal, "pieces")


def promising_pieces(texts: DataFrame, pieces: DataFrame, deal: Deal, window: int, gram: int) -> DataFrame:
    """Pieces to compare that share more than their anchor with another document.

    Two hashes a piece replace its windows, of which most recur nowhere: anchors of common words are widened
    to either side, and a piece stays if one of these recurs.
    """

    def ask(rows, found):
        answers = told(found, deal)

        def of_chunk(p, docs):
            asked = np.flatnonzero(first_pieces(p, docs, answers)[1])
            of, key, always = p.ends(asked)
            of = np.concatenate([of, always, always])
            doc = docs[p.piece_row[of]]
            doc[len(of) - len(always) :] ^= np.uint64(1)  # pieces that stay in any case come with a second document
            return np.concatenate([key, p.piece[always], p.piece[always]]), p.piece[of], doc

        return pa.Table.from_batches([questions(rows.column("block")[0].as_py(), *asked_by(rows, deal, window, gram, of_chunk), deal, once=False)])

    asked = texts.groupBy("block").cogroup(pieces.groupBy("block")).applyInArrow(ask, QUESTIONS)
    return answered(asked, deal, "promising-pieces", every=True)


def shared_windows(texts: DataFrame, promising: DataFrame, deal: Deal, window: int, gram: int) -> DataFrame:
    """Per block the windows of its promising pieces that start in a smaller document."""

    def ask(rows, found):
        answers = told(found, deal)

        def of_chunk(p, docs):
            at, of = p.windows(np.flatnonzero(looked_up(p.piece, answers)[0]))
            key = span_hashes(p.padded, at, window)
            return key, key, docs[p.piece_row[of]]

        return pa.Table.from_batches([questions(rows.column("block")[0].as_py(), *asked_by(rows, deal, window, gram, of_chunk), deal)])

    asked = texts.groupBy("block").cogroup(promising.groupBy("block")).applyInArrow(ask, QUESTIONS)
    return answered(asked, deal, "byte-windows")


class Stretches:
    """Runs of known windows of one piece each, by place; a stretch may go on where the one before it ends."""

    def __init__(self, p: Pieces, docs: np.ndarray, pieces: np.ndarray, windows: np.ndarray):
        first, asked = first_pieces(p, docs, pieces)
        whole = np.flatnonzero(first < NONE)
        at, of = p.windows(np.flatnonzero(asked & (first == NONE)))
        found, slot = looked_up(span_hashes(p.padded, at, p.window), windows)
        at, of, label = at[found], of[found], windows["first"][slot[found]].astype(np.uint64)
        smaller = label < docs[p.piece_row[of]]
        at, of, label = at[smaller], of[smaller], label[smaller]
        fresh = np.ones(len(at), dtype=bool)
        fresh[1:] = (at[1:] != at[:-1] + 1) | (of[1:] != of[:-1])
        begin = np.flatnonzero(fresh)
        last = np.append(begin[1:], len(at))[: len(begin)] - 1
        label = np.maximum.reduceat(label, begin) if len(begin) else label
        self.begin, self.last = np.concatenate([p.begin[whole], at[begin]]), np.concatenate([p.last[whole], at[last]])
        self.row = np.concatenate([p.piece_row[whole], p.piece_row[of[begin]]])
        self.label = np.concatenate([first[whole], label])
        order = np.argsort(self.begin)
        self.begin, self.last, self.row, self.label = (x[order] for x in (self.begin, self.last, self.row, self.label))
        self.follows = np.zeros(len(self.begin), dtype=bool)
        self.follows[1:] = (self.begin[1:] == self.last[:-1] + 1) & (self.row[1:] == self.row[:-1])
        self.size = self.last - self.begin + p.window
        _, self.source, self.letter = np.unique(p.stretch_hashes(self.begin, self.last), return_index=True, return_inverse=True)

    def __len__(self) -> int:
        return len(self.begin)

    def indexed(self) -> tuple[np.ndarray, np.ndarray]:
        """The confirmed stretches as letters, each once, separated; and the stretch at every text position."""
        source = np.sort(self.source)
        apart = np.ones(len(source), dtype=bool)
        apart[1:] = (source[1:] != source[:-1] + 1) | ~self.follows[source[1:]]
        place = np.arange(len(source)) + np.cumsum(apart) - 1
        text, stretch = (np.full(len(source) + int(apart.sum()), x, np.int64) for x in (len(self.source), -1))
        text[place], stretch[place] = self.letter[source], source
        return text, stretch


def marked(p: Pieces, docs: np.ndarray, pieces: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Bytes of a chunk that lie in a long match with a smaller document."""
    covered = np.zeros(len(p.data) + 1, np.int64)
    s = Stretches(p, docs, pieces, windows)
    if len(s):
        text, stretch = s.indexed()
        index = RunIndex(text, 1)
        # windows that nothing is known of cannot match, so the walk covers the runs of the others
        first = np.flatnonzero(~s.follows)
        count = np.diff(np.append(first, len(s)))
        parts = -(-count // SPAN)
        step = (np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)) * SPAN
        begin = np.repeat(first, parts) + step
        letters = np.concatenate([s.letter, np.full(index.limit + 16, len(s.source))])
        at, place = index.pointers(letters, begin, np.minimum(begin + SPAN, np.repeat(first + count, parts)))
        same = stretch[np.minimum(place, len(stretch) - 1)]
        at, same = at[same >= 0], same[same >= 0]
        label = np.full(len(s.source), NONE)
        np.minimum.at(label, s.letter, s.label)
        fine = (s.size[at] == s.size[same]) & (label[s.letter[same]] < docs[s.row[at]])
        at, same = at[fine], same[fine]
        limit = int(s.size.max())
        at = at[common_prefix(p.padded, s.begin[at], p.padded, s.begin[same], limit) >= s.size[at]]
        np.add.at(covered, s.begin[at], 1)
        np.add.at(covered, s.begin[at] + s.size[at], -1)
    return np.cumsum(covered[:-1]) > 0


def remove_repeated_bytes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    columns: list[str] | None = None,
    with_kept: bool = False,
) -> DataFrame:
    """Cut every byte that a string of ``window`` bytes repeats from a smaller document.

    Adds ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and optionally ``kept`` (the bytes that stay) to
    the listed columns (default: all).
    """
    added = ["n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if with_kept else [])]
    kept = [c for c in (docs.columns if columns is None else columns) if c not in added]
    schema = T.StructType([docs.schema[c] for c in kept])
    for name, kind in zip(added, ["long", "long", "long", "string", "binary"], strict=False):
        schema = schema.add(name, kind)

    rows = in_blocks(docs.select(*dict.fromkeys([*kept, text_col]), F.col(id_col).cast("long").alias("__doc")), text_col)
    low, high, blocks = rows.agg(F.min("__doc"), F.max("__doc"), F.count_distinct("__block")).first()
    deal = Deal(low or 0, high or 0, blocks * BLOCK, partitions(docs))
    texts = rows.filter("__doc is not null").select(F.col("__block").alias("block"), F.col("__doc").alias("doc"), F.col(text_col).alias("text"))
    pieces = shared_pieces(texts, deal, window, gram)
    promising = promising_pieces(texts, pieces, deal, window, gram)
    windows = shared_windows(texts, promising, deal, window, gram)
    release(promising)

    def cut(chunk: pa.RecordBatch, pieces: np.ndarray, windows: np.ndarray) -> pa.RecordBatch:
        data, offsets = utf8(chunk.column(text_col))
        covered = np.zeros(len(data), dtype=bool)
        known = np.flatnonzero(chunk.column("__doc").is_valid().to_numpy(zero_copy_only=False))
        if len(known) and len(pieces):
            some = chunk.take(pa.array(known)) if len(known) < chunk.num_rows else chunk
            p = Pieces(*utf8(some.column(text_col)), window, gram)
            found = marked(p, deal.docs(some.column("__doc")), pieces, windows)
            covered[np.arange(len(p.data)) + np.repeat(offsets[known] - p.offsets[:-1], np.diff(p.offsets))] = found
        begins = covered.copy()
        begins[1:] &= ~covered[:-1]
        inside = offsets[(offsets > 0) & (offsets < len(covered))]
        begins[inside] = covered[inside]
        removed = row_sums(covered, offsets)
        left, ends = data[~covered].tobytes(), offsets - np.concatenate([[0], np.cumsum(removed)])
        left = [left[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        out = [chunk.column(c) for c in kept]
        out += [pa.array(np.diff(offsets)), pa.array(removed), pa.array(row_sums(begins, offsets))]
        out.append(pa.array([hashlib.sha256(x).hexdigest() for x in left], pa.string()))
        if with_kept:
            out.append(pa.array(left, pa.binary()))
        return pa.RecordBatch.from_arrays(out, names=schema.names)

    def cut_block(rows: pa.Table, found: pa.Table) -> pa.Table:
        kinds = [told(found.filter(pc.equal(found.column("kind"), k)), deal) for k in (0, 1)]
        return pa.Table.from_batches([cut(chunk, *kinds) for chunk in text_chunks(rows.combine_chunks().to_batches(), text_col, CHUNK)])

    found = pieces.withColumn("kind", F.lit(0)).unionByName(windows.withColumn("kind", F.lit(1)))
    return rows.groupBy("__block").cogroup(found.groupBy("block")).applyInArrow(cut_block, schema)

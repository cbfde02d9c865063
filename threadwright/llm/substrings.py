"""Substring deduplication: recurring passages found by Aho-Corasick automata.

A window of words recurs if it starts in several documents. Hashes propose, the automata decide:

1. *Anchors.* Of every window the smallest hash of its short word runs is its anchor; equal windows
   have equal anchors. One row per anchor and document tells which anchors recur at all.
2. *Passages.* Only windows with a recurring anchor are hashed. For each hash that recurs the
   smallest document is its holder, and the block of ``BLOCK`` words of that document in which it starts
   is its place. Every holder writes the words of its chosen blocks; every other document writes the
   stretches of its text whose windows have one place.
3. *Automata.* Stretches meet blocks by place, one block a place; those of a crowded place are dealt to as many
   copies of its block as they need. A shard of bounded bytes compiles the
   windows of its blocks, over exact words, into one automaton and streams its stretches through it. A window is
   cut where the automaton finds it in a block of a smaller document, and nowhere else.
4. *Collisions.* Windows that share a hash but are not in the block come out of the automaton unmatched.
   Their hashes (none, as a rule) are settled over all documents that hold them by the words themselves.

So the result does not depend on hashes: equal windows always share one, and different ones are told
apart by their words. Counting is combined before each shuffle, and a key's rows are only ever joined with
one row of that key, which adaptive execution can split, so a passage in a third of all documents
is no hot spot. Everything is judged on the input.

Defined results: a null text has no words; a document shorter than a window loses nothing. Rows
with a null id are left as they are and do not count as earlier documents. Repeated rows share an
id, so they do not dedup each other but are both cut by smaller documents; rows of one id with several
texts are told apart by a 64-bit hash of the text. Columns of the input are passed through; one named
like an added column is replaced.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Words, mix, recurring, release, row_sums, sliding, staged, text_chunks, utf8, window_hashes

WINDOW = 13
GRAM = 5
BLOCK = 256  # windows that one block of a document holds
CROWD = 256  # stretches of one place beyond which they are dealt to several copies of its block
SHARD_BYTES = 1 << 18  # block text that one automaton is compiled from


def window_anchors(hashes: np.ndarray, at: np.ndarray, window: int, gram: int) -> np.ndarray:
    """Smallest hash of the runs of ``gram`` words inside each window."""
    if not len(at):
        return np.zeros(0, np.uint64)
    grams = window_hashes(hashes, np.arange(len(hashes) - gram + 1), gram, seed=1)
    return sliding(grams, window - gram + 1, np.minimum)[at]


def distinct_pairs(row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, key) pairs."""
    if not len(row):
        return row, key
    fresh = np.ones(len(row), dtype=bool)
    fresh[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
    row, key = row[fresh], key[fresh]
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    fresh = np.ones(len(row), dtype=bool)
    fresh[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
    return row[fresh], key[fresh]


def occurrences(batch: pa.RecordBatch, row: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
    row, key = distinct_pairs(row, key)
    doc = batch.column("doc").to_numpy()
    return pa.RecordBatch.from_pydict({"key": pa.array(key.view(np.int64)), "doc": pa.array(doc[row], pa.int64())})


def listed(column: pa.Array, field: str | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and values of a list column (of longs, or of one field of structs)."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.drop_null().flatten()
    if field is not None:
        flat = flat.field(field)
    return np.repeat(np.arange(len(column)), lengths), flat.to_numpy(zero_copy_only=False)


def member(row: np.ndarray, key: np.ndarray, of_row: np.ndarray, of_key: np.ndarray) -> np.ndarray:
    """Which (row, key) pairs are among (of_row, of_key); keys are compared exactly, row by row."""
    out = np.zeros(len(row), dtype=bool)
    begin, end = np.searchsorted(row, np.unique(of_row)), np.searchsorted(row, np.unique(of_row), side="right")
    first, last = np.searchsorted(of_row, np.unique(of_row)), np.searchsorted(of_row, np.unique(of_row), side="right")
    for a, b, c, d in zip(begin, end, first, last, strict=True):
        out[a:b] = np.isin(key[a:b], of_key[c:d])
    return out


def lookup(row: np.ndarray, key: np.ndarray, of_row: np.ndarray, of_key: np.ndarray) -> np.ndarray:
    """Index in (of_row, of_key) of each (row, key) pair, or -1; ``row`` and ``of_row`` rise."""
    out = np.full(len(row), -1, np.int64)
    order = np.lexsort((of_key, of_row))
    of_row, of_key = of_row[order], of_key[order]
    rows = np.unique(of_row)
    begin, end = np.searchsorted(row, rows), np.searchsorted(row, rows, side="right")
    first, last = np.searchsorted(of_row, rows), np.searchsorted(of_row, rows, side="right")
    for a, b, c, d in zip(begin, end, first, last, strict=True):
        slot = np.minimum(c + np.searchsorted(of_key[c:d], key[a:b]), d - 1)
        out[a:b] = np.where(of_key[slot] == key[a:b], order[slot], -1)
    return out


def window_places(words: Words, at: np.ndarray, bodies: np.ndarray) -> np.ndarray:
    """A number for the text and the block of ``BLOCK`` words in which each window starts."""
    row = words.row[at]
    block = (at - words.first[row]) // BLOCK
    return mix(mix(bodies[row].view(np.uint64)) + block.astype(np.uint64)).view(np.int64)


def confirmed_passages(texts: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """For each ``doc`` of ``texts(doc, body, text)``, its windows whose hash recurs.

    ``ours`` lists (``key``, ``place``) of windows that no smaller document holds, ``theirs`` those that one does.
    """

    def anchor_rows(batches):
        for batch in text_chunks(batches, "text"):
            words = Words(*utf8(batch.column("text")))
            at = words.windows(window)
            yield occurrences(batch, words.row[at], window_anchors(words.hashes(), at, window, gram))

    anchors = staged(texts.select("doc", "text").mapInArrow(anchor_rows, "key long, doc long"), "anchors")
    firsts = staged(recurring(anchors, "key", "doc"), "recurring-anchors")
    release(spark=texts.sparkSession)
    shared = staged(anchors.join(firsts, "key").groupBy("doc").agg(F.collect_set("key").alias("anchors")), "shared-anchors")
    release(anchors, firsts)

    def window_rows(batches):
        for batch in text_chunks(batches, "text"):
            words = Words(*utf8(batch.column("text")))
            hashes, at = words.hashes(), words.windows(window)
            best = window_anchors(hashes, at, window, gram).view(np.int64)
            at = at[member(words.row[at], best, *listed(batch.column("anchors")))]
            key, row = window_hashes(hashes, at, window).view(np.int64), words.row[at]
            order = np.lexsort((key, row))  # stable: the first place of a repeated window comes first
            fresh = np.ones(len(order), dtype=bool)
            fresh[1:] = (row[order][1:] != row[order][:-1]) | (key[order][1:] != key[order][:-1])
            once = order[fresh]
            place = window_places(words, at[once], batch.column("body").to_numpy())
            doc = batch.column("doc").to_numpy()
            yield pa.RecordBatch.from_pydict({"key": key[once], "doc": pa.array(doc[row[once]], pa.int64()), "place": place})

    candidates = texts.join(shared.hint("shuffle_hash"), "doc")
    windows = staged(candidates.mapInArrow(window_rows, "key long, doc long, place long"), "windows")
    release(shared)
    holders = windows.groupBy("key").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.min_by("place", "doc").alias("chosen"))
    firsts = staged(holders.filter("first < last").select("key", "first", "chosen"), "recurring-windows")
    release(spark=texts.sparkSession)
    entry = F.struct("key", F.col("chosen").alias("place"))
    found = windows.join(firsts, "key").filter("doc > first or place = chosen")
    ours, theirs = (F.collect_set(F.when(side, entry)) for side in (F.col("doc") == F.col("first"), F.col("doc") > F.col("first")))
    passages = staged(found.groupBy("doc").agg(ours.alias("ours"), theirs.alias("theirs")), "passages")
    release(windows, firsts)
    return passages


def passage_parts(texts: DataFrame, passages: DataFrame, window: int) -> DataFrame:
    """Blocks (``at`` is -1) and stretches of the documents, by place, as the bytes of their words."""

    def part_rows(batches):
        for batch in text_chunks(batches, "text"):
            words = Words(*utf8(batch.column("text")))
            docs, bodies = batch.column("doc").to_numpy(), batch.column("body").to_numpy()
            windows = words.windows(window)
            keys = window_hashes(words.hashes(), windows, window).view(np.int64)
            out = {name: [] for name in ("place", "row", "at", "begin", "end")}
            for name in ("ours", "theirs"):
                of_row, of_key = listed(batch.column(name), "key")
                if not len(of_row) or not len(windows):
                    continue
                of_place = listed(batch.column(name), "place")[1]
                slot = lookup(words.row[windows], keys, of_row, of_key)
                hit = slot >= 0
                at, place = windows[hit], of_place[slot[hit]]
                if name == "ours":  # a block reaches over all its windows, whatever lies between them
                    mine = window_places(words, at, bodies) == place
                    at, place = at[mine], place[mine]
                    fresh = np.ones(len(at), dtype=bool)
                    fresh[1:] = (place[1:] != place[:-1]) | (words.row[at][1:] != words.row[at][:-1])
                else:
                    fresh = np.ones(len(at), dtype=bool)
                    fresh[1:] = (place[1:] != place[:-1]) | (words.row[at][1:] != words.row[at][:-1]) | (at[1:] != at[:-1] + 1)
                    run = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
                    fresh |= (np.arange(len(at)) - run) % BLOCK == 0
                if not len(at):
                    continue
                head = np.flatnonzero(fresh)
                tail = np.append(head[1:], len(at)) - 1
                row = words.row[at[head]]
                out["place"].append(place[head])
                out["row"].append(row)
                out["at"].append(np.full(len(head), -1) if name == "ours" else at[head] - words.first[row])
                out["begin"].append(words.starts[at[head]])
                out["end"].append(words.ends[at[tail] + window - 1])
            if not out["row"]:
                continue
            place, row, at, begin, end = (np.concatenate(v) for v in out.values())
            body = words.data.tobytes()
            text = [body[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
            yield pa.RecordBatch.from_pydict(
                {"place": place, "doc": docs[row], "body": bodies[row], "at": at, "text": pa.array(text, pa.binary())}
            )

    rows = texts.join(passages.hint("shuffle_hash"), "doc")
    return staged(rows.mapInArrow(part_rows, "place long, doc long, body long, at long, text binary"), "passage-parts")


def word_column(words: Words) -> pa.Array:
    """The words themselves, as one binary column."""
    lengths = words.ends - words.starts
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    letters = words.data[np.arange(offsets[-1]) + np.repeat(words.starts - offsets[:-1], lengths)]
    return pa.Array.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])


def lettered(numbers: np.ndarray) -> str:
    """One character per number from -1 on, leaving out the surrogates."""
    codes = numbers + 2
    return (codes + 0x800 * (codes >= 0xD800)).astype("<u4").tobytes().decode("utf-32-le")


def automaton_matches(stretches: Words, blocks: Words, of_block: np.ndarray, window: int) -> np.ndarray:
    """For each word of the stretches the smallest document whose blocks hold the window that starts there, or -1.

    ``of_block`` is the document of every block.
    """
    encoded = word_column(blocks).dictionary_encode()
    body = lettered(encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64))
    known = pc.index_in(word_column(stretches), value_set=encoded.dictionary).fill_null(-1)
    stream = lettered(known.to_numpy(zero_copy_only=False).astype(np.int64))
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    least: dict[str, int] = {}
    for block in np.argsort(of_block, kind="stable").tolist():  # the smallest document names a window
        doc = int(of_block[block])
        for start in range(int(blocks.first[block]), int(blocks.first[block + 1]) - window + 1):
            least.setdefault(body[start : start + window], doc)
    values = np.fromiter(least.values(), np.int64, len(least))
    for number, phrase in enumerate(least):
        automaton.add_word(phrase, number)
    out = np.full(len(stretches), -1, np.int64)
    if not least:
        return out
    automaton.make_automaton()
    ends: list[int] = []
    found: list[int] = []
    for a, b in zip(stretches.first[:-1].tolist(), stretches.first[1:].tolist(), strict=True):
        for end, number in automaton.iter(stream[a:b]):
            ends.append(a + end)
            found.append(number)
    out[np.asarray(ends, np.int64) - window + 1] = values[np.asarray(found, np.int64)]
    return out


def located(parts: DataFrame, window: int) -> DataFrame:
    """Words ``begin`` to ``end`` of documents that an automaton finds in smaller ones; and hashes it left unmatched (``key``)."""

    def match_rows(batches):
        for batch in text_chunks(batches, "block", SHARD_BYTES):
            place, held = batch.column("place").to_numpy(), batch.column("block")
            sizes = np.diff(utf8(held)[1])
            fresh = np.ones(batch.num_rows, dtype=bool)  # rows come sorted by place; several texts of a place all stay
            of_block = batch.column("first").to_numpy()
            fresh[1:] = (place[1:] != place[:-1]) | (of_block[1:] != of_block[:-1]) | (sizes[1:] != sizes[:-1])
            alike = np.flatnonzero(~fresh)
            if len(alike):
                fresh[alike] = ~pc.equal(held.take(pa.array(alike)), held.take(pa.array(alike - 1))).to_numpy(zero_copy_only=False)
            blocks = Words(*utf8(held.filter(pa.array(fresh))))
            words = Words(*utf8(batch.column("text")))
            first = automaton_matches(words, blocks, of_block[fresh], window)
            doc, body, start = (batch.column(c).to_numpy() for c in ("doc", "body", "at"))
            windows = words.windows(window)
            good = (first[windows] != -1) & (first[windows] < doc[words.row[windows]])
            at, row = windows[good], words.row[windows[good]]
            head = np.ones(len(at), dtype=bool)
            head[1:] = (at[1:] != at[:-1] + 1) | (row[1:] != row[:-1])
            tail = np.append(np.flatnonzero(head)[1:], len(at)) - 1 if len(at) else np.zeros(0, np.int64)
            row, begin, end = row[head], at[head], at[tail] + window
            shift = start[row] - words.first[row]
            bad = np.unique(window_hashes(words.hashes(), windows[~good], window).view(np.int64))
            pad = [None] * len(bad)
            fields = {"doc": doc[row], "body": body[row], "begin": begin + shift, "end": end + shift}
            columns = {name: pa.concat_arrays([pa.array(v, pa.int64()), pa.array(pad, pa.int64())]) for name, v in fields.items()}
            yield pa.RecordBatch.from_pydict({**columns, "key": pa.array([None] * len(row) + bad.tolist(), pa.int64())})

    stretches = parts.filter("at >= 0")
    crowded = stretches.groupBy("place").agg((F.count(F.lit(1)) / CROWD).cast("long").alias("shares")).filter("shares > 0")
    shares = F.coalesce("shares", F.lit(0).cast("long"))
    blocks = parts.filter("at < 0").select("place", F.col("doc").alias("first"), F.col("text").alias("block"))
    blocks = blocks.dropDuplicates(["place", "first", "block"]).join(crowded, "place", "left")
    blocks = blocks.withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), shares))).drop("shares")
    dealt = stretches.join(crowded, "place", "left").withColumn("share", F.pmod(F.xxhash64("doc", "at"), shares + 1)).drop("shares")
    met = dealt.join(blocks.hint("merge"), ["place", "share"])
    return staged(met.mapInArrow(match_rows, "doc long, body long, begin long, end long, key long"), "passage-matches")


def settled(texts: DataFrame, passages: DataFrame, keys: DataFrame, window: int) -> DataFrame:
    """Words of windows with one of ``keys`` that start in a smaller document, told by the words themselves."""

    def phrase_rows(batches):
        for batch in text_chunks(batches, "text"):
            words = Words(*utf8(batch.column("text")))
            at = words.windows(window)
            own = window_hashes(words.hashes(), at, window).view(np.int64)
            at = at[member(words.row[at], own, *listed(batch.column("keys")))]
            body, starts, ends = words.data.tobytes(), words.starts.tolist(), words.ends.tolist()
            phrase = [b" ".join([body[starts[i] : ends[i]] for i in range(a, a + window)]) for a in at.tolist()]
            row = words.row[at]
            doc, bodies = batch.column("doc").to_numpy()[row], batch.column("body").to_numpy()[row]
            yield pa.RecordBatch.from_pydict({"phrase": pa.array(phrase, pa.binary()), "doc": doc, "body": bodies, "begin": at - words.first[row]})

    held = passages.select("doc", F.explode(F.concat("ours.key", "theirs.key")).alias("key")).join(keys, "key", "left_semi")
    rows = texts.join(held.groupBy("doc").agg(F.collect_set("key").alias("keys")).hint("shuffle_hash"), "doc")
    phrases = staged(rows.mapInArrow(phrase_rows, "phrase binary, doc long, body long, begin long"), "unmatched-phrases")
    found = phrases.join(recurring(phrases, "phrase", "doc"), "phrase").filter("doc > first")
    return found.select("doc", "body", "begin", (F.col("begin") + window).alias("end"))


def repeated_spans(texts: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """For each (``doc``, ``body``) that loses words, the list ``spans`` of (``begin``, ``end``)."""
    passages = confirmed_passages(texts, window, gram)
    parts = passage_parts(texts, passages, window)
    release(spark=texts.sparkSession)
    matches = located(parts, window)
    release(parts)
    spans, keys = matches.filter("key is null").drop("key"), matches.select("key").filter("key is not null").distinct()
    if not keys.isEmpty():
        spans = spans.unionByName(settled(texts, passages, keys, window))
    out = staged(spans.groupBy("doc", "body").agg(F.collect_set(F.struct("begin", "end")).alias("spans")), "repeated-spans")
    release(passages, matches)
    return out


def marked_words(spans: pa.Array, words: Words) -> np.ndarray:
    """Words that lie in one of their row's spans."""
    row, begin = listed(spans, "begin")
    end = listed(spans, "end")[1]
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, words.first[row] + begin, 1)
    np.add.at(change, words.first[row] + end, -1)
    return np.cumsum(change[:-1]) > 0


def remove_repeated_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    columns: list[str] | None = None,
) -> DataFrame:
    """Cut every word that a window repeats from a smaller document.

    Adds ``n_words``, ``n_removed`` and ``kept_sha256`` to the listed columns (default: all). In the
    text of a document that loses words, the kept ones are joined by one space; other texts stay as
    they are.
    """
    kept = [c for c in (docs.columns if columns is None else columns) if c not in ("n_words", "n_removed", "kept_sha256")]
    texts = docs.filter(F.col(id_col).isNotNull())
    texts = texts.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text_col).alias("body"), F.col(text_col).alias("text"))
    spans = repeated_spans(texts, window, gram)
    schema = T.StructType([docs.schema[c] for c in kept])
    schema = schema.add("n_words", "long").add("n_removed", "long").add("kept_sha256", "string")

    def cut(batches):
        for batch in text_chunks(batches, text_col):
            column = batch.column(text_col)
            data, offsets = utf8(column)
            texts = column.to_pylist() if text_col in kept else None
            shared = np.flatnonzero(batch.column("__spans").is_valid())
            n_words, removed, digests = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64), [""] * batch.num_rows
            alone = np.ones(batch.num_rows, dtype=bool)
            alone[shared] = False
            for row in np.flatnonzero(alone).tolist():  # bytes.split() parts words exactly as the contract does
                own = data[offsets[row] : offsets[row + 1]].tobytes().split()
                n_words[row] = len(own)
                digests[row] = hashlib.sha256(b" ".join(own)).hexdigest()
            if len(shared):
                some = batch.take(pa.array(shared))
                words = Words(*utf8(some.column(text_col)))
                covered = marked_words(some.column("__spans"), words)
                n_words[shared], removed[shared] = words.counts, row_sums(covered, words.first)
                body = words.data.tobytes()
                starts, ends, stay = words.starts.tolist(), words.ends.tolist(), ~covered
                for k, row in enumerate(shared.tolist()):
                    a, b = words.first[k], words.first[k + 1]
                    left = b" ".join([body[starts[i] : ends[i]] for i in (a + np.flatnonzero(stay[a:b])).tolist()])
                    digests[row] = hashlib.sha256(left).hexdigest()
                    if texts is not None and removed[row]:
                        texts[row] = left.decode()
            out = [pa.array(texts, column.type) if c == text_col else batch.column(c) for c in kept]
            out += [pa.array(n_words), pa.array(removed), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(out, names=schema.names)

    added = [F.col(id_col).cast("long").alias("__doc"), F.xxhash64(text_col).alias("__body")]
    rows = docs.select(*dict.fromkeys([*kept, text_col]), *added)
    known = spans.select(*[F.col(c).alias(f"__{c}") for c in spans.columns])
    return rows.join(known.hint("shuffle_hash"), ["__doc", "__body"], "left").mapInArrow(cut, schema)

"""Term counts of texts in blocks, the store behind a TF-IDF index.

A block holds the counts of some four million bytes of texts: its dictionary, in parts by a hash of the
term, and for each term the texts that have it. Document frequencies are summed part by part over the
blocks' dictionaries and come back as plain numbers in dictionary order, so a term travels once per
block, postings do not travel at all, and a text's norm is summed where its postings lie.
"""

from __future__ import annotations

import ctypes
import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.staging import stage, stage_bucketed

BLOCK_BYTES = 4 << 20  # text of one block
PART_BYTES = 16 << 20  # text that each part of the vocabulary stands for
TOTAL = pa.struct([("n", pa.int32()), ("df", pa.binary())])
NOT_WORD = r"[^\p{L}\p{N}_]+"
_BASE = np.uint64(0x9E3779B97F4A7C15)


def text_terms(texts: pa.Array, stop_words: pa.Array, max_n: int) -> tuple[pa.Array, np.ndarray]:
    """Unigrams, and for ``max_n`` 2 also bigrams, of lower-cased texts; and the row each comes from."""
    words = pc.split_pattern_regex(texts, NOT_WORD)
    row = pc.list_parent_indices(words).to_numpy().astype(np.int64)
    words = words.flatten()
    kept = pc.and_(pc.greater_equal(pc.utf8_length(words), 2), pc.invert(pc.is_in(words, stop_words)))
    words, row = words.filter(kept), row[kept.to_numpy(zero_copy_only=False)]
    if max_n < 2 or not len(words):
        return words, row
    near = row[1:] == row[:-1]
    pairs = pc.binary_join_element_wise(words[:-1].filter(pa.array(near)), words[1:].filter(pa.array(near)), pa.scalar(" ", words.type))
    return pa.concat_arrays([words, pairs]), np.concatenate([row, row[1:][near]])


def _buffers(terms: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of large strings, with eight spare ones, and their offsets."""
    _, offsets, data = terms.buffers()
    offsets = np.frombuffer(offsets, np.int64)[terms.offset : terms.offset + len(terms) + 1]
    body = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return np.concatenate([body, np.zeros(8, np.uint8)]), offsets - offsets[0]


def _dictionary_order(terms: pa.Array, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the terms by part and first letters (which packs well), and the part of each term."""
    data, offsets = _buffers(terms)
    lengths = np.diff(offsets)
    words = np.ndarray((len(data) - 7,), np.uint64, buffer=data, strides=(1,))
    beyond = (np.uint64(8) * (8 - np.minimum(lengths, 8)).astype(np.uint64)).astype(np.uint64)
    first = words[offsets[:-1]] & (np.uint64(2**64 - 1) >> beyond)
    last = np.where(lengths < 8, first, words[np.maximum(offsets[1:] - 8, 0)])
    hashed = (first ^ (last * _BASE) ^ lengths.astype(np.uint64)) * _BASE
    part = ((((hashed ^ (hashed >> np.uint64(29))) * _BASE) >> np.uint64(33)) % np.uint64(parts)).astype(np.int32)
    order = np.argsort(first.byteswap())
    return order[np.argsort(part[order], kind="stable")], part


def give_back() -> None:
    """Return freed memory to the system, as workers wait for further tasks beside others."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def _listed(values: np.ndarray | pa.Array) -> pa.Array:
    """One row that holds all values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values))


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest needs."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0)))).tobytes()


def _unpacked(data: pa.Scalar, n: int) -> np.ndarray:
    data = data.as_py()
    return np.frombuffer(data, f"u{len(data) // n}" if n else np.uint8).astype(np.int64)


def _changes(column: pa.Array) -> np.ndarray:
    code = column.dictionary_encode(null_encoding="encode").indices.to_numpy()
    return np.concatenate([[True], code[1:] != code[:-1]])


def _block(batches: list[pa.RecordBatch], number: int, stop_words: pa.Array, max_n: int, parts: int) -> list:
    rows = pa.Table.from_batches(batches).combine_chunks()
    ids, copies = (rows.column(c).combine_chunks() for c in ("text_id", "copies"))
    other_id = _changes(ids)
    fresh = other_id | _changes(copies)
    if "digest" in rows.column_names:  # rows that repeat an id with its text stand for it once
        kept = fresh | _changes(rows.column("digest").combine_chunks())
        rows, ids, copies = (x.filter(pa.array(kept)) for x in (rows, ids, copies))
        other_id, fresh = other_id[kept], fresh[kept]
    entry = np.cumsum(fresh) - 1
    begin = np.flatnonzero(fresh)
    terms, row = text_terms(rows.column("text").combine_chunks().cast(pa.large_string()), stop_words, max_n)
    coded = terms.dictionary_encode()
    words, n = coded.dictionary, len(begin)
    if len(words):
        order, part = _dictionary_order(words, parts)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        words, part = words.take(pa.array(order)), part[order]
        key, tf = np.unique(rank[coded.indices.to_numpy()] * n + entry[row], return_counts=True)
    else:
        part, key, tf = (np.zeros(0, np.int64) for _ in range(3))
    of = key // n
    weight = copies.to_numpy()[begin][key % n]
    df = np.bincount(of, weights=weight, minlength=len(words)).astype(np.int64)
    cuts = pa.array(np.searchsorted(part, np.arange(parts + 1)), pa.int32())
    joined = pc.binary_join(pa.ListArray.from_arrays(cuts, words.cast(pa.string())), "\n")
    return [
        pa.array([number], pa.int64()),
        _listed(ids.take(pa.array(begin))),
        _listed((np.cumsum(other_id) - 1)[begin].astype(np.int32)),
        _listed(joined),
        _listed(pa.array([_packed(df[a:b]) for a, b in itertools.pairwise(cuts.to_pylist())], pa.binary())),
        pa.array([_packed(np.bincount(of, minlength=len(words)))]),
        pa.array([_packed(key % n)]),
        pa.array([_packed(tf)]),
    ]


def count_blocks(texts: DataFrame, stop_words: Sequence[str], max_n: int, buckets: int, parts: int) -> DataFrame:
    """Blocks of ``texts`` (text_id, copies, text), dealt by id, stored by block.

    Rows with the same id and number of copies count as one text, so the texts are sorted by id; with a
    ``digest`` of the text, equal ones of them count once.
    """
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType().add("block", "long").add("ids", T.ArrayType(texts.schema["text_id"].dataType)).add("unit", ints)
    schema = schema.add("terms", T.ArrayType(T.StringType())).add("df", T.ArrayType(T.BinaryType()))
    for name in ("n_texts", "text", "tf"):
        schema = schema.add(name, "binary")
    names, stops = schema.names, list(stop_words)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left_out = pa.array(stops, pa.large_string())
        pending, size, last, number = [], 0, None, TaskContext.get().partitionId() << 32
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("text_id")
            leads = _changes(ids)
            leads[0] = bool(pending) and ids[0].as_py() != last
            sizes = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False), dtype=np.int64)])
            start = 0
            while True:
                full = np.flatnonzero(leads[start:] & (sizes[start:-1] - sizes[start] + size >= BLOCK_BYTES))
                if not len(full):
                    break
                end = start + int(full[0])
                pending.append(batch.slice(start, end - start))
                yield pa.RecordBatch.from_arrays(_block(pending, number, left_out, max_n, parts), names=names)
                pending, size, start, number = [], 0, end, number + 1
            pending.append(batch.slice(start))
            size += int(sizes[-1] - sizes[start])
            last = ids[-1].as_py()
        if pending:
            yield pa.RecordBatch.from_arrays(_block(pending, number, left_out, max_n, parts), names=names)
        pending, batch = [], None
        give_back()

    order = [c for c in ("text_id", "copies", "digest") if c in texts.columns]
    rows = texts.select(*order, F.lower("text").alias("text")).sortWithinPartitions(*order)
    made = rows.mapInArrow(blocks, schema)
    return stage_bucketed(made, "blocks", "block", buckets, **{"compression": "zstd", "parquet.block.size": 16 << 20})


def document_frequencies(blocks: DataFrame, min_df: int, buckets: int) -> tuple[DataFrame, DataFrame]:
    """(block, df): the frequency of each of its terms over all blocks; and the vocabulary (term, df)."""
    parts = blocks.select("block", F.posexplode(F.arrays_zip("terms", "df")).alias("part", "d"))
    parts = parts.select("block", "part", "d.terms", "d.df").filter("terms <> ''")

    def summed(rows: pa.Table) -> pa.Table:
        lists = pa.concat_arrays([pc.split_pattern(c.cast(pa.large_string()), "\n") for c in rows.column("terms").chunks])
        coded, ends = lists.flatten().dictionary_encode(), np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
        code, sizes = coded.indices.to_numpy(), np.diff(ends).tolist()
        df = np.concatenate([_unpacked(x, n) for x, n in zip(rows.column("df"), sizes, strict=True)])
        total = np.bincount(code, weights=df).astype(np.int64)
        known = total >= min_df
        words = pc.binary_join(_listed(coded.dictionary.filter(pa.array(known)).cast(pa.string())), "\n")
        packed = [_packed(total[code[a:b]]) for a, b in itertools.pairwise(ends.tolist())]
        return pa.table(
            {
                "block": pa.concat_arrays([rows.column("block").combine_chunks(), pa.nulls(1, pa.int64())]),
                "part": pa.concat_arrays([rows.column("part").combine_chunks(), pa.nulls(1, pa.int32())]),
                "total": pa.array([{"n": n, "df": x} for n, x in zip(sizes, packed, strict=True)] + [None], TOTAL),
                "df": pa.concat_arrays([pa.nulls(rows.num_rows, pa.list_(pa.int64())), _listed(total[known])]),
                "terms": pa.concat_arrays([pa.nulls(rows.num_rows, pa.string()), words]),
            }
        )

    schema = "block long, part int, total struct<n int, df binary>, df array<bigint>, terms string"
    found = stage(parts.groupBy("part").applyInArrow(summed, schema), "frequencies")
    ordered = F.sort_array(F.collect_list(F.struct("part", "total")))
    of_block = found.filter("block IS NOT NULL").groupBy("block").agg(F.transform(ordered, lambda x: x["total"]).alias("total"))
    of_block = stage_bucketed(of_block.repartition(buckets, "block"), "block_frequencies", "block", buckets)
    words = found.filter("block IS NULL AND size(df) > 0").select(F.split("terms", "\n").alias("term"), "df")
    words = words.select(F.explode(F.arrays_zip("term", "df")).alias("v"))
    return of_block, words.select("v.term", "v.df")


def weighted(blocks: DataFrame, frequencies: DataFrame, n_docs: int, min_df: int, wanted: Sequence[str] | None = None) -> DataFrame:
    """(text_id, term, w): tf * idf with unit length per text; terms with ``df < min_df`` are dropped.

    With ``wanted`` only the postings of these terms come back; norms always cover all.
    """
    kind = blocks.schema["ids"].dataType.elementType
    schema = T.StructType().add("text_id", kind).add("term", "string").add("w", "double")

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = None if wanted is None else pa.array(wanted, pa.string())
        for batch in batches:
            for i in range(batch.num_rows):
                ids, unit, joined, total = (batch.column(c).slice(i, 1).flatten() for c in ("ids", "unit", "terms", "total"))
                df = np.concatenate([_unpacked(x, n) for x, n in zip(total.field("df"), total.field("n").to_pylist(), strict=True)])
                unit, n_texts = unit.to_numpy(), _unpacked(batch.column("n_texts")[i], len(df))
                text, tf = (_unpacked(batch.column(c)[i], int(n_texts.sum())) for c in ("text", "tf"))
                of = np.repeat(np.arange(len(df)), n_texts)
                of, text, tf = (x[df[of] >= min_df] for x in (of, text, tf))
                x = tf * (np.log((1.0 + n_docs) / (df + 1.0)) + 1.0)[of]
                norm = np.sqrt(np.bincount(unit[text], weights=x * x))
                words = pc.split_pattern(joined.filter(pc.not_equal(joined, "")), "\n").flatten()
                if only is not None:
                    asked = pc.is_in(words, only).to_numpy(zero_copy_only=False)[of]
                    of, text, x = of[asked], text[asked], x[asked]
                columns = [ids.take(pa.array(text)), words.take(pa.array(of)), pa.array(x / norm[unit[text]])]
                if len(of):
                    yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    columns = ["ids", "unit", "terms", "n_texts", "text", "tf", "total"]
    return blocks.join(frequencies.hint("shuffle_hash"), "block").select(*columns).mapInArrow(weigh, schema)

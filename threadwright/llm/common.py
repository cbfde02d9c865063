"""Helpers the training-data operators share: staged tables, Arrow text buffers and word hashes.

Whole batches of texts are handled as one byte buffer with offsets, so that words, windows and
counts are array operations. Text chunks are bounded in bytes, not in rows: a very long text is a
chunk of its own. Column names that begin with two underscores are reserved for the operators.
"""

from __future__ import annotations

import ctypes
import gc
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import discard, new_path, track

CHUNK_BYTES = 1 << 20
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back; cuts the lineage."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return track(spark.read.schema(df.schema).parquet(path), path)


def release(*tables: DataFrame, spark: SparkSession | None = None) -> None:
    """Delete stored tables that nothing reads any more, and let Spark drop finished shuffles.

    Spark removes a shuffle's files once the driver has collected the plan that made it, which on a
    quiet driver may be long after; a driver-side collection between phases keeps disk use flat.
    """
    for df in tables:
        spark = df.sparkSession
        discard(df)
    for _ in range(2):  # the first round frees the driver's handles, the second what they held
        gc.collect()
        if spark is not None:
            spark._jvm.System.gc()
        time.sleep(0.3)


def partitions(df: DataFrame) -> int:
    """Number of hash partitions that operators deal work out to."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def crc_mod(column: str, mod: int):
    return F.crc32(F.col(column).cast("string")) % mod


# --- Arrow buffers ------------------------------------------------------------------------


def text_chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes of text each (or a single row)."""
    for batch in batches:
        _, offsets = utf8(batch.column(column))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end
        give_back()


def give_back() -> None:
    """Return freed memory to the system: Python workers are reused, and share a node with others."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column and the offsets of its rows; a null is empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null(b"" if pa.types.is_binary(array.type) or pa.types.is_large_binary(array.type) else "")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    kind = np.int64 if wide else np.int32
    _, offs, data = array.buffers()
    if not len(array) or offs is None:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    offsets = np.frombuffer(offs, kind)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[offsets[0] : offsets[-1]], offsets - offsets[0]


# --- words and hashes ---------------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes (splitmix)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Words:
    """Words of a chunk: byte spans, row of each word and the first word of every row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        space = _SPACE[data]
        begins = ~space
        begins[1:] &= space[:-1]
        ends = ~space
        ends[:-1] &= space[1:]
        inner = offsets[(offsets > 0) & (offsets < len(data))]  # a row's end also ends a word
        if len(inner):
            begins[inner] = ~space[inner]
            ends[inner - 1] = ~space[inner - 1]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        self.row = np.repeat(np.arange(len(offsets) - 1), self.counts)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, data: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        data = self.data if data is None else data
        if not len(self):
            return np.zeros(0, np.uint64)
        lengths = self.ends - self.starts
        base = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(base, lengths)
        letters = data[place + np.repeat(self.starts, lengths)].astype(np.uint64) + np.uint64(1)
        letters *= powers(int(lengths.max()))[place]
        return mix(np.add.reduceat(letters, base) ^ (lengths.astype(np.uint64) << np.uint64(48)))

    def windows(self, size: int) -> np.ndarray:
        """Index of the first word of every window of ``size`` words that lies in one row."""
        room = self.first[1:][self.row] - np.arange(len(self))
        return np.flatnonzero(room >= size)


def window_hashes(words: np.ndarray, at: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hash of the ``size`` words from each position in ``at``."""
    factors = mix(np.arange(1 + seed * 101, size + 1 + seed * 101, dtype=np.uint64) * _BASE) | np.uint64(1)
    if 4 * len(at) < len(words):
        out = np.zeros(len(at), np.uint64)
        for i in range(size):
            out += words[at + i] * factors[i]
        return mix(out)
    n = max(len(words) - size + 1, 0)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out += words[i : i + n] * factors[i]
    return mix(out)[at]


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every run of ``width`` values."""
    out, have = values, 1
    while 2 * have <= width:
        out = pick(out[: len(out) - have], out[have:])
        have *= 2
    if have < width:
        out = pick(out[: len(out) - (width - have)], out[width - have :])
    return out


def row_sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of true flags between consecutive offsets."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def recurring(occurrences: DataFrame, key: str, doc: str) -> DataFrame:
    """Keys that occur in more than one document, with the ``first`` one (map-side combined)."""
    seen = occurrences.groupBy(key).agg(F.min(doc).alias("first"), F.max(doc).alias("last"))
    return seen.filter("first < last").select(key, "first")

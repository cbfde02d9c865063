"""Passages of benchmark items in documents, found by one Aho-Corasick automaton.

Texts are normalised to lower-cased words with one space around each, so that a window of words is a
plain string. Spark gathers the distinct windows of all items; the automaton over them is built once
per Python worker and reads every normalised document once. Ends of matches lead to word numbers, and
covered runs of words to places in the original text. Documents never leave their partition: there is
no shuffle of texts.

The automaton's size is bounded: windows go into it up to ``limit`` bytes (about 80 bytes of memory for each).
A larger benchmark is dealt by hash into several such sets, and each further set reads the documents
again, adding to what the earlier ones found; the result is the same.

Defined results: a null text has no words. An item without words occurs nowhere; items that repeat an id
are one item; a null item id is the empty name. Repeated documents come out as often as they occur, null
ids are kept. Extra columns pass through, but those named like an output are replaced.
"""

from __future__ import annotations

import uuid
from array import array
from collections.abc import Iterator, Sequence
from itertools import pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import staged, text_chunks, utf8

LIMIT = 4 << 20
MADE = ["n_words", "n_hit", "items", "word_runs", "spans"]
_RUNS = T.ArrayType(T.StructType().add("start", "long").add("length", "long"))
_WINDOWS_A_BATCH = 4096

#: Lower-cases A-Z; whatever is neither letter, digit nor beyond ASCII becomes a space.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def windows(words: list[bytes], size: int) -> Iterator[bytes]:
    """Runs of ``size`` words with a space around each; all words if there are fewer."""
    for i in range(max(len(words) - size + 1, min(len(words), 1))):
        yield b" " + b" ".join(words[i : i + size]) + b" "


def item_windows(items: DataFrame, id_col: str, text_cols: Sequence[str], size: int) -> DataFrame:
    """Distinct (``window``, ``item``) of all items; each text column is a text of its own."""

    def cut(batches):
        for batch in batches:
            found, names = [], []
            for i, name in enumerate(batch.column("item").to_pylist()):
                for c in range(1, batch.num_columns):
                    text = batch.column(c)[i].as_py()
                    for window in windows((text or "").encode().translate(FOLD).split(), size):
                        found.append(window)
                        names.append(name)
                        if len(found) == _WINDOWS_A_BATCH:
                            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array(names, pa.string())], names=["window", "item"])
                            found, names = [], []
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array(names, pa.string())], names=["window", "item"])

    texts = [F.col(c).cast("string").alias(f"text{i}") for i, c in enumerate(text_cols)]
    slim = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), *texts)
    return slim.mapInArrow(cut, "window binary, item string").distinct()


class Machine:
    """Automaton over windows; a window's value is its number of words and its items."""

    def __init__(self, rows: Sequence[tuple[bytes, str]]):
        owners: dict[bytes, list[str]] = {}
        for window, item in rows:
            owners.setdefault(bytes(window), []).append(item)
        self.sizes = np.array([w.count(b" ") - 1 for w in owners], np.int64)
        self.owners = list(owners.values())
        self.automaton = ahocorasick.Automaton()
        for number, window in enumerate(owners):
            self.automaton.add_word(window.decode("latin-1"), number)  # one character a byte
        self.automaton.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, set[str]]:
        """First words and ends (exclusive) of all matches, and the items they belong to."""
        line = b" " + b" ".join(words) + b" "
        ends, numbers = array("q"), array("q")
        for end, number in self.automaton.iter(line.decode("latin-1")) if self.owners else ():
            ends.append(end)
            numbers.append(number)
        if not ends:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), set()
        which = np.frombuffer(numbers, np.int64)
        spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
        last = np.searchsorted(spaces, np.frombuffer(ends, np.int64))
        return last - self.sizes[which], last, {item for number in set(numbers) for item in self.owners[number]}


_BUILT: dict[str, Machine] = {}


def _machine(token: str, rows) -> Machine:
    """The automaton of a set of windows, built once by a worker and kept until another is needed."""
    if token not in _BUILT:
        _BUILT.clear()
        _BUILT[token] = Machine(rows.value)
    return _BUILT[token]


def merged_runs(n: int, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the ``n`` places that the given runs cover."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    covered = np.concatenate([[False], np.cumsum(change[:-1]) > 0, [False]])
    edges = np.flatnonzero(covered[1:] != covered[:-1])
    return edges[::2], edges[1::2]


def original_spans(text: np.ndarray, folded: bytes, starts: np.ndarray, ends: np.ndarray) -> list[dict]:
    """Code points of the original text from the first to the last word of every run."""
    word = np.concatenate([[False], np.frombuffer(folded, np.uint8) != 32, [False]])
    edges = np.flatnonzero(word[1:] != word[:-1])
    points = np.concatenate([[0], np.cumsum((text & 0xC0) != 0x80)])
    a, b = points[edges[::2][starts]], points[edges[1::2][ends - 1]]
    return [{"start": s, "length": e - s} for s, e in zip(a.tolist(), b.tolist(), strict=True)]


def _pass(df: DataFrame, text_col: str, kept: list[str], rows, earlier: bool) -> DataFrame:
    token = uuid.uuid4().hex
    schema = T.StructType([df.schema[c] for c in kept]).add("n_words", "long").add("n_hit", "long")
    schema = schema.add("items", T.ArrayType(T.StringType())).add("word_runs", _RUNS).add("spans", _RUNS)
    runs_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
    types = [pa.int64(), pa.int64(), pa.list_(pa.string()), runs_type, runs_type]

    def scan(batches):
        machine = _machine(token, rows)
        for batch in text_chunks(batches, text_col):
            data, offsets = utf8(batch.column(text_col))
            folded = data.tobytes().translate(FOLD)
            before = [batch.column(c).to_pylist() for c in ("items", "word_runs")] if earlier else None
            made: list[list] = [[], [], [], [], []]
            for i, (a, b) in enumerate(pairwise(offsets.tolist())):
                words = folded[a:b].split()
                starts, ends, items = machine.scan(words)
                if before and before[1][i]:
                    starts = np.concatenate([starts, [r["start"] for r in before[1][i]]]).astype(np.int64)
                    ends = np.concatenate([ends, [r["start"] + r["length"] for r in before[1][i]]]).astype(np.int64)
                    items |= set(before[0][i])
                runs, spans = [], []
                if len(starts):
                    starts, ends = merged_runs(len(words), starts, ends)
                    runs = [{"start": s, "length": e - s} for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
                    spans = original_spans(data[a:b], folded[a:b], starts, ends)
                for column, value in zip(made, (len(words), sum(r["length"] for r in runs), sorted(items), runs, spans), strict=True):
                    column.append(value)
            arrays = [pa.array(column, kind) for column, kind in zip(made, types, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *arrays], names=[*kept, *MADE])

    read = dict.fromkeys([*kept, text_col, *(["items", "word_runs"] if earlier else [])])
    return df.select(*read).mapInArrow(scan, schema)


def find_benchmark_passages(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    columns: Sequence[str] | None = None,
    item_id_col: str = "item_id",
    item_text_cols: Sequence[str] = ("text",),
    size: int = 10,
    limit: int = LIMIT,
) -> DataFrame:
    """The listed columns (default: all but the text) with what the items' windows cover of each text.

    ``items`` are the sorted ids of items with an occurring window, ``word_runs`` the covered runs of
    words and ``spans`` the same as code points of the original text.
    """
    spark = docs.sparkSession
    kept = [c for c in (docs.columns if columns is None else columns) if c != text_col and c not in MADE]
    found = staged(item_windows(items, item_id_col, item_text_cols, size), "benchmark-windows")
    total = found.agg(F.coalesce(F.sum(F.octet_length("window") + F.octet_length("item")), F.lit(0))).first()[0]
    sets = max(1, -(-total // limit))
    dealt = found.withColumn("__set", F.pmod(F.xxhash64("window", "item"), F.lit(sets)))
    out = docs.select(*dict.fromkeys([*kept, text_col]))
    for number in range(sets):
        rows = [(bytes(r["window"]), r["item"]) for r in dealt.filter(F.col("__set") == number).select("window", "item").toLocalIterator()]
        further = number < sets - 1
        carried = [*kept, text_col] if further else kept
        out = _pass(out, text_col, carried, spark.sparkContext.broadcast(rows), earlier=number > 0)
        if further:
            out = staged(out, "documents-with-passages")
    return out

"""Records of quoted CSV and of JSON arrays, read from byte ranges of a file by many tasks.

A separator inside quotes does not end a record, and whether a byte range begins inside quotes depends
on all bytes before it. Spark's text source cuts files into ranges anywhere between two separators. Each
task takes its range as *pieces*: runs of lines between two lines with an odd number of quote marks, so
that the text between the separators of a piece is either all outside or all inside of quotes. The
number of such lines per range, summed along each file (one row a range), tells which; from there on
a piece resolves by itself: outside, every line is a record; inside, the piece continues the record that the
line before it began. Only records that cross a range or a piece's size limit are put together by a
shuffle, of their parts alone.

The pieces are stored first, so that the ranges cannot change between the two steps. Files are read
through Spark, wherever they lie; compressed files cannot be cut and are one range.

Quote marks must be balanced, and a field that contains one must be quoted with the mark doubled (CSV) or
escaped (JSON), as every writer does that follows the formats. In a file whose marks are not balanced,
everything after the last one is one record.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .staging import stage

PIECE_BYTES = 1 << 20
_PIECES = "path string, block long, seq long, odd boolean, opens boolean, closes boolean, head boolean, before string, text string"


def csv_marks(lines: pa.Array) -> np.ndarray:
    return pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)


def json_marks(lines: pa.Array) -> np.ndarray:
    """Quote marks that are not escaped."""
    return csv_marks(pc.replace_substring_regex(lines, r"(?s)\\.", ""))


class _Piece:
    """The run of lines being gathered, of one range of one file."""

    def __init__(self, path: str, block: int, seq: int, odd: bool, before: str | None, head: bool, opens: bool):
        self.path, self.block, self.seq, self.odd = path, block, seq, odd
        self.before, self.head, self.opens = before, head, opens
        self.lines: list[str] = []
        self.size = 0

    def row(self, closes: bool, separator: str) -> dict:
        return {
            "path": self.path,
            "block": self.block,
            "seq": self.seq,
            "odd": self.odd,
            "opens": self.opens,
            "closes": closes,
            "head": self.head,
            "before": self.before,
            "text": separator.join(self.lines) if self.lines else None,
        }


def _gather(rows: Iterator[tuple[str, int, str, bool]], separator: str) -> Iterator[dict]:
    """Pieces of lines in file order; ``rows`` are (path, block, line, odd number of marks)."""
    piece = None
    for path, block, line, odd in rows:
        if piece is None or (path, block) != (piece.path, piece.block):
            if piece is not None:
                yield piece.row(False, separator)
            piece = _Piece(path, block, 0, False, None, block == 0, False)
        piece.lines.append(line)
        piece.size += len(line)
        if odd:
            yield piece.row(True, separator)
            # the first record of a file is the one this line began, unless a whole line came before
            head = piece.head and not any(s.strip("\r") for s in piece.lines[:-1]) and not piece.odd
            piece = _Piece(path, block, piece.seq + 1, not piece.odd, line, head, True)
        elif piece.size >= PIECE_BYTES:
            yield piece.row(False, separator)
            head = piece.head and (piece.odd or not any(s.strip("\r") for s in piece.lines))
            piece = _Piece(path, block, piece.seq + 1, piece.odd, None, head, False)
    if piece is not None:
        yield piece.row(False, separator)


def pieces(spark: SparkSession, path: str, separator: str, marks: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    lines = spark.read.option("lineSep", separator).text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value")

    def cut(batches):
        def rows():
            for batch in batches:
                odd = marks(batch.column("value")) % 2 == 1
                columns = (batch.column(c).to_pylist() for c in ("path", "block", "value"))
                yield from zip(*columns, odd.tolist(), strict=True)

        made: list[dict] = []
        size = 0
        for row in _gather(rows(), separator):
            made.append(row)
            size += len(row["text"] or "")
            if size >= PIECE_BYTES:
                yield pa.RecordBatch.from_pylist(made, _SCHEMA)
                made, size = [], 0
        yield pa.RecordBatch.from_pylist(made, _SCHEMA)

    return stage(lines.mapInArrow(cut, _PIECES), "record-pieces")


_SCHEMA = pa.schema(
    [
        ("path", pa.string()),
        ("block", pa.int64()),
        ("seq", pa.int64()),
        ("odd", pa.bool_()),
        ("opens", pa.bool_()),
        ("closes", pa.bool_()),
        ("head", pa.bool_()),
        ("before", pa.string()),
        ("text", pa.string()),
    ]
)


def resolved(found: DataFrame) -> DataFrame:
    """Pieces with ``inside``: whether they lie inside quotes."""
    along = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    ranges = found.groupBy("path", "block").agg(F.count_if("closes").alias("flips"))
    starts = ranges.select("path", "block", (F.coalesce(F.sum("flips").over(along), F.lit(0)) % 2 == 1).alias("start"))
    return found.join(starts, ["path", "block"]).withColumn("inside", F.col("odd") != F.col("start"))


def records(found: DataFrame, separator: str, header: bool) -> DataFrame:
    """``record``: the text of every record, without its separator."""
    placed = resolved(found)
    lines = F.split("text", "\\Q" + separator + "\\E", -1)
    whole = F.when(F.col("closes"), F.slice(lines, 1, F.size(lines) - 1)).otherwise(lines)
    whole = F.filter(whole, lambda s: (s != "") & (s != "\r"))
    if header:
        whole = F.when(F.col("head"), F.slice(whole, 2, F.greatest(F.size(whole) - 1, F.lit(0)))).otherwise(whole)
    outside = placed.filter("NOT inside AND text IS NOT NULL").select(F.explode(whole).alias("record"))

    inside = placed.filter("inside").withColumn("part", F.concat_ws(separator, "before", "text"))
    kept = ~F.col("head") if header else F.lit(True)
    single = inside.filter(F.col("opens") & F.col("closes") & kept).select(F.col("part").alias("record"))

    parts = inside.filter("NOT (opens AND closes)").select("path", "block", "seq", "opens", "head", "before", "text", "part")
    order = Window.partitionBy("path").orderBy("block", "seq")  # parts of records that cross ranges
    named = parts.filter(F.col("before").isNotNull() | F.col("text").isNotNull()).withColumn("number", F.count_if("opens").over(order))
    joined = named.groupBy("path", "number").agg(
        F.sort_array(F.collect_list(F.struct("block", "seq", "part"))).alias("parts"), F.max("head").alias("head")
    )
    crossing = joined.filter(kept).select(F.array_join("parts.part", separator).alias("record"))
    return outside.unionByName(single).unionByName(crossing)


def read_quoted_csv(spark: SparkSession, path: str, schema: StructType, header: bool = True, **options) -> DataFrame:
    """CSV whose quoted fields may hold line breaks; one file is read by many tasks.

    Values equal those of Spark's ``multiLine`` reader with the same options, which reads a file in one task.
    Empty lines are no records; lines may end in one character or two, and line breaks inside quotes stay as they are.
    """
    text = records(pieces(spark, path, "\n", csv_marks), "\n", header)
    record = F.regexp_replace("record", r"\r\z", "")
    fixed = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "maxCharsPerColumn": "-1"}
    given = {name: str(value) for name, value in options.items()}
    ddl = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    parsed = text.select(F.from_csv(record, ddl, {**fixed, **given}).alias("row"))
    return parsed.select("row.*")


def read_flat_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Objects of one or more JSON arrays (or of JSON lines); one file is read by many tasks.

    The closing brace separates records, so objects must be flat: one that holds another object raises an
    error. An element that is not an object is left out.
    """
    text = records(pieces(spark, path, "}", json_marks), "}", header=False)
    body = F.regexp_replace("record", r"^[\s,\[\]\x{FEFF}]+", "")
    bare = F.regexp_replace(body, r'"(?:[^"\\]|\\.)*+"', "")
    nested = F.length(bare) - F.length(F.replace(bare, F.lit("{"), F.lit(""))) > 1
    checked = F.when(nested, F.raise_error(F.lit("an object holds another one; read nested records with whole_files=True"))).otherwise(F.concat(body, F.lit("}")))
    objects = text.select(body.alias("body"), checked.alias("record")).filter(F.contains("body", F.lit("{")))
    return objects.select(F.from_json("record", schema).alias("row")).select("row.*")

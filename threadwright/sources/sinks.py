"""Table, text and report sinks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import flatten_lines
from .staging import path_exists


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Parquet or CSV sink; CSV keeps quoted line breaks readable by :func:`read_messages`."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"').option("emptyValue", "")
        writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.format(fmt).save(path)


def write_customer_lines(messages: DataFrame, path: str) -> None:
    """One customer message per line, line breaks flattened to spaces."""
    lines = messages.filter("is_customer").select(flatten_lines(F.coalesce("text", F.lit(""))).alias("value"))
    lines.write.mode("overwrite").text(path)


def write_report(report: DataFrame, path: str) -> None:
    """Nested report (struct, map and array columns) as JSON."""
    report.write.mode("overwrite").json(path)


def array_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of one JSON array from rows of one JSON text each, for a single task that only passes them on."""
    started = False
    for batch in batches:
        if not batch.num_rows:
            continue
        before = pa.array(["," if started else "[", *[","] * (batch.num_rows - 1)])
        yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(before, batch.column(0).cast(pa.string()), "")], ["value"])
        started = True
    if started:
        yield pa.RecordBatch.from_arrays([pa.array(["]"])], ["value"])


def build_or_load(spark, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Reuse a complete stored table, otherwise build and store it first."""
    if not path_exists(spark, path.rstrip("/") + "/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)

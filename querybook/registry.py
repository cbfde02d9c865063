"""Query registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from .tables import Book, book


@dataclass(frozen=True)
class Query:
    name: str
    items: str
    build: Callable[[Book], DataFrame]
    sql: Callable[[], str] | None

    def __call__(self, spark, sf_dir: str) -> DataFrame:
        return self.build(book(spark, sf_dir))


QUERIES: dict[str, Query] = {}


def query(items: str, sql: Callable[[], str] | str | None = None):
    """Register the decorated function under its own name."""

    def wrap(fn: Callable[[Book], DataFrame]) -> Callable[[Book], DataFrame]:
        name = fn.__name__
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        text = (lambda: sql) if isinstance(sql, str) else sql
        QUERIES[name] = Query(name, items, fn, text)
        return fn

    return wrap

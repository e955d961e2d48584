"""Collects queries with their reference SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function under its own name; without SQL only its rows can be checked."""

    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return add


def rounded(df: DataFrame, places: int, columns: Sequence[str] | None = None) -> DataFrame:
    """Double columns rounded, because engines add up in different orders."""
    names = columns or [f.name for f in df.schema.fields if f.dataType.simpleString() == "double"]
    return df.select(*[F.round(c, places).alias(c) if c in names else F.col(c) for c in df.columns])

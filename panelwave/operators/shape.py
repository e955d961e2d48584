"""Helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_row(df: DataFrame, **columns: Column) -> Column:
    """Aggregates of ``df`` as one struct column, through a scalar subquery.

    A one-row statistic is used by other queries without a cross join and
    without a round trip of the values through Python.
    """
    return df.agg(F.struct(*[c.alias(n) for n, c in columns.items()]).alias("s")).scalar()


def rows_from(df: DataFrame, by: Sequence[str], structs: Sequence[Column]) -> DataFrame:
    """One output row per struct: turns wide aggregates into a long table."""
    return df.select(*by, F.inline(F.array(*structs)))


def struct(**fields: Column | str | int | float) -> Column:
    return F.struct(
        *[(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in fields.items()]
    )


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on keys of which each may be NULL; key columns come from the left."""
    if not keys:
        raise ValueError("a join needs keys")
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    condition = None
    for key in keys:
        same = F.col(key).eqNullSafe(F.col(f"_r_{key}"))
        condition = same if condition is None else condition & same
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def predicates(named: Mapping[str, str]) -> dict[str, Column]:
    return {name: F.expr(text) for name, text in named.items()}

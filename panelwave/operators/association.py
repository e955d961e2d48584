"""Pearson correlations in long form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwave.functions.numeric import correlation
from panelwave.operators.shape import rows_from, struct


def pearson(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(var_x, var_y, n, r)`` for all ordered pairs, from one aggregate.

    Rows with a NULL in any of the columns are left out of every pair. A
    constant column has no correlation (NULL), not even with itself.
    """
    complete = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).dropna(subset=list(columns))
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    wide = complete.agg(
        F.count(F.lit(1)).alias("_n"),
        *[correlation(F.col(a), F.col(b)).alias(f"_{a}_{b}") for a, b in pairs],
    )
    at = {c: i for i, c in enumerate(columns)}
    structs = [
        struct(
            var_x=a,
            var_y=b,
            n=F.col("_n"),
            r=F.col(f"_{a}_{b}" if at[a] <= at[b] else f"_{b}_{a}"),
        )
        for a in columns
        for b in columns
    ]
    return rows_from(wide, [], structs)


def ranked_with(matrix: DataFrame, target: str) -> DataFrame:
    """Correlations with the target, strongest first."""
    return (
        matrix.where((F.col("var_x") == target) & (F.col("var_y") != target))
        .select(F.col("var_y").alias("variable"), "r")
        .orderBy(F.abs("r").desc_nulls_last(), "variable")
    )

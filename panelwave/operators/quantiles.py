"""Exact quantiles that never gather a group's values in one task.

The built-in ``percentile`` keeps a value-to-count map of the whole group in one
task. Here equal values are first counted (a partial aggregate, so a hot value
costs one row per task), each distinct value falls into a bucket given by its
leading binary digits, and bucket totals say which buckets hold the wanted ranks.
Those are split again by the next 20 digits, so that values in a narrow range
part too, and what is ordered at last are at most 2**20 values that differ in
their last 20 digits alone. Buckets depend on the value alone and rise with it,
so they are the same in every task and after every retry; they affect the balance
of the work, never the result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwave.functions.numeric import finite_or_null
from panelwave.operators.shape import null_safe_join

DIGITS = 2**12
FINER = 2**20


def quantile_name(level: float) -> str:
    return "p" + f"{level * 100:g}".replace(".", "_")


def magnitude_bucket(value: Column) -> Column:
    """Sign, exponent and twelve leading binary digits as one rising bigint."""
    exponent, digits = _leading(value)
    position = F.lit(2**26) + exponent * (4 * DIGITS) + digits
    return F.when(value > 0, position).when(value < 0, -position).otherwise(F.lit(0).cast("long"))


def finer_bucket(value: Column) -> Column:
    """The 20 binary digits after those of ``magnitude_bucket``, rising with the value inside such a bucket."""
    exponent, digits = _leading(value)
    rest = F.floor((F.abs(value) / F.pow(F.lit(2.0), exponent) * DIGITS - digits) * FINER)
    return F.when(value > 0, rest).when(value < 0, -rest).otherwise(F.lit(0).cast("long"))


def _leading(value: Column) -> tuple[Column, Column]:
    size = F.abs(value)
    exponent = F.floor(F.log2(size))
    return exponent, F.floor(size / F.pow(F.lit(2.0), exponent) * DIGITS)


def value_counts_long(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """``(by, variable, value, n)`` of the finite values."""
    cells = [F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("value")) for c in columns]
    return (
        df.select(*by, F.inline(F.array(*cells)))
        .where(finite_or_null(F.col("value")).isNotNull())
        .groupBy(*by, "variable", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _holding(held: DataFrame, group: Sequence[str], name: str, bucket: Column, levels: Sequence[float]) -> DataFrame:
    """The values of the buckets that hold a wanted rank, with ``_start``, the number of values below their bucket.

    ``group`` names the groups, and inside them the buckets, that ``bucket`` divides; ``_start`` counts what lies below
    those. ``_all`` is the number of values of the group, where it is known already.
    """
    placed = held.withColumn(name, bucket)
    in_group = Window.partitionBy(*group)
    totals = placed.groupBy(*group, name).agg(
        F.sum("n").alias("_size"), F.first("_start").alias("_start"), F.first("_all").alias("_all")
    )
    totals = totals.withColumn("_upto", F.col("_start") + F.sum("_size").over(in_group.orderBy(name))).withColumn(
        "_all", F.coalesce("_all", F.sum("_size").over(in_group))
    )
    before = F.col("_upto") - F.col("_size")
    ranks = [fn(level * (F.col("_all") - 1)) for level in levels for fn in (F.floor, F.ceil)]
    holds = [(rank >= before) & (rank < F.col("_upto")) for rank in ranks]
    needed = totals.where(reduce(or_, holds)).select(*group, name, before.alias("_start"), "_all")
    return null_safe_join(placed.drop("_start", "_all"), needed, [*group, name])


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], levels: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Linearly interpolated quantiles: ``(by, variable, p25, p50, ...)``."""
    group = [*by, "variable"]
    freq = value_counts_long(df, columns, by)
    held = freq.withColumn("_start", F.lit(0).cast("long")).withColumn("_all", F.lit(None).cast("long"))
    for name, bucket in (("_bucket", magnitude_bucket), ("_finer", finer_bucket)):
        held = _holding(held, group, name, bucket(F.col("value")), levels)
        group = [*group, name]

    within = Window.partitionBy(*group).orderBy("value")
    ordered = held.withColumn("_cum", F.col("_start") + F.sum("n").over(within))
    group = [*by, "variable"]
    picked = ordered.groupBy(*group).agg(
        F.first("_all").alias("_all"),
        *[
            F.min(F.when(F.col("_cum") > fn(level * (F.col("_all") - 1)), F.col("value"))).alias(f"_{side}{i}")
            for i, level in enumerate(levels)
            for side, fn in (("lo", F.floor), ("hi", F.ceil))
        ],
    )
    return picked.select(*group, *[_interpolated(i, q).alias(quantile_name(q)) for i, q in enumerate(levels)])


def _interpolated(i: int, level: float) -> Column:
    rank = level * (F.col("_all") - 1)
    low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
    return low + (high - low) * (rank - F.floor(rank))


def approx_quantiles(
    df: DataFrame, columns: Sequence[str], levels: Sequence[float], by: Sequence[str] = (), accuracy: int = 10_000
) -> DataFrame:
    """Same shape from one bounded sketch per group; values of the data, not interpolated."""
    wide = df.groupBy(*by).agg(
        *[F.percentile_approx(c, list(levels), accuracy).alias(c) for c in columns]
    )
    structs = [
        F.struct(
            F.lit(c).alias("variable"),
            *[F.col(c)[i].cast("double").alias(quantile_name(q)) for i, q in enumerate(levels)],
        )
        for c in columns
    ]
    return wide.select(*by, F.inline(F.array(*structs)))


def exact_thresholds(df: DataFrame, column: str, levels: Sequence[float]) -> Column:
    """Ascending array of exact quantiles of the whole table, as a scalar subquery."""
    names = [quantile_name(q) for q in levels]
    return exact_quantiles(df, [column], levels).select(F.array(*names).alias("t")).scalar()

"""Comparing tables by key. No comparison multiplies rows of a repeated key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwave.functions.numeric import close_to


def orphans(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None) -> DataFrame:
    """Keys of the left table, with their row counts, that the right one lacks."""
    counted = left.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return counted.join(right.select(F.col(right_key or key).alias(key)).distinct(), key, "left_anti")


def overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys present in both tables; copies collapse before they are shuffled."""
    return left.select(key).distinct().intersect(right.select(key).distinct())


def only_in(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct rows of the left table that the right one lacks."""
    return left.select(*columns).distinct().subtract(right.select(*columns).distinct())


def members(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is listed; a list never multiplies rows."""
    return df.join(ids.select(key), key, "left_semi")


def _sides(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    l = left.select(*columns, F.lit(1).alias("_l"), F.lit(0).alias("_r"))
    r = right.select(*columns, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    return l.unionAll(r)


def coverage(left: DataFrame, right: DataFrame, key: str, values: Sequence[str] = ()) -> DataFrame:
    """Keys missing in the right table, extra in it, equal, and with other contents.

    Both tables are stacked and aggregated by content, then by key: two partial
    aggregates in place of a join, whatever the number of rows per key.
    """
    per_key = (
        _sides(left, right, [key, *values])
        .groupBy(key, *values)
        .agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
        .groupBy(key)
        .agg(
            F.sum("_l").alias("_l"),
            F.sum("_r").alias("_r"),
            F.max(F.col("_l") != F.col("_r")).alias("_differs"),
        )
    )
    left_only, right_only = F.col("_r") == 0, F.col("_l") == 0
    return per_key.agg(
        F.count_if(left_only).alias("missing"),
        F.count_if(right_only).alias("extra"),
        F.count_if(~left_only & ~right_only & F.col("_differs")).alias("mismatched"),
        F.count_if(~left_only & ~right_only & ~F.col("_differs")).alias("equal"),
    )


def numeric_difference(
    left: DataFrame, right: DataFrame, key: str, column: str, tolerance: float = 1e-6
) -> DataFrame:
    """Largest absolute difference of a column between rows of equal key.

    Per key only the extremes of both sides are kept, so the result over all
    pairs of a repeated key is exact without forming the pairs.
    """
    value = F.col(column)
    per_key = (
        _sides(left, right, [key, column])
        .groupBy(key)
        .agg(
            F.min(F.when(F.col("_l") == 1, value)).alias("l_min"),
            F.max(F.when(F.col("_l") == 1, value)).alias("l_max"),
            F.min(F.when(F.col("_r") == 1, value)).alias("r_min"),
            F.max(F.when(F.col("_r") == 1, value)).alias("r_max"),
        )
        .select(F.greatest(F.abs(F.col("l_max") - F.col("r_min")), F.abs(F.col("r_max") - F.col("l_min"))).alias("_d"))
    )
    return per_key.agg(
        F.count("_d").alias("compared_keys"),
        F.count_if(F.col("_d") > 0).alias("changed_keys"),
        F.count_if(F.col("_d") > tolerance).alias("beyond_tolerance"),
        F.max("_d").alias("max_abs_diff"),
    )


def join_on_id(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Inner join of scored frames on their record id, which is unique in each."""
    joined = frames[0]
    for frame in frames[1:]:
        joined = joined.join(frame, key)
    return joined


def stored_against_recomputed(
    stored: DataFrame, again: DataFrame, keys: Sequence[str], values: Sequence[str], tolerance: float = 1e-6
) -> DataFrame:
    """Report tables compared value by value: ``(keys, metric, stored, recomputed, passed)``; NULL groups meet."""
    cells = F.array(*[F.struct(F.lit(v).alias("metric"), F.col(v).cast("double").alias("value")) for v in values])
    a = stored.select(*keys, F.inline(cells)).withColumnRenamed("value", "stored")
    b = again.select(*keys, F.inline(cells)).withColumnRenamed("value", "recomputed")
    on = [*keys, "metric"]
    same_key = reduce(lambda x, y: x & y, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in on])
    both = a.alias("a").join(b.alias("b"), same_key, "full_outer")
    cells = both.select(*[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in on], "stored", "recomputed")
    return cells.withColumn("passed", _same("stored", "recomputed", tolerance))


def _same(left: str, right: str, tolerance: float) -> Column:
    l, r = F.col(left), F.col(right)
    return (l.isNull() & r.isNull()) | F.coalesce(close_to(l, r, tolerance), F.lit(False))

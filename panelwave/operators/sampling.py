"""Reproducible samples, splits and top rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwave.functions.codes import row_hash
from panelwave.operators.shape import one_row

# The seed and size of the deterministic sample.
SEED = 3066
SAMPLE_SIZE = 5000
PREFIXES = 16


def _order_key(id_col: Column, seed: int | None, method: str) -> tuple[Column, Column]:
    """Hash of the id and its first bits; a NULL id has a hash like any other."""
    if method == "md5":
        text = F.coalesce(id_col.cast("string"), F.lit(""))
        if seed is not None:
            text = F.concat_ws("-", id_col.cast("string"), F.lit(str(seed)))
        key = F.md5(text)
        return key, F.conv(F.substring(key, 1, 4), 16, 10).cast("int")
    key = row_hash(id_col, seed=seed)
    return key, F.shiftright(key, 64 - PREFIXES).cast("int")


def sample_by_hash(
    df: DataFrame, id_col: str, n: int = SAMPLE_SIZE, seed: int | None = SEED, method: str = "xxhash64"
) -> DataFrame:
    """The n rows with the smallest hash of their id, the same on every layout.

    A count per hash prefix first finds the prefixes that can hold those rows,
    so the final top-n gets about n rows in total and not n per task.
    """
    key, prefix = _order_key(F.col(id_col), seed, method)
    counts = df.select(prefix.alias("_p")).groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    # At most 2**16 prefixes exist, whatever the number of rows.
    running = counts.select("_p", F.sum("_n").over(Window.orderBy("_p")).alias("_upto"))
    last = one_row(running.where(F.col("_upto") >= n), p=F.min("_p"))["p"]
    kept = df.withColumn("_h", key).where(prefix <= F.coalesce(last, F.lit(2**PREFIXES)))
    return kept.orderBy("_h", id_col).limit(n).drop("_h")


def hash_split(df: DataFrame, id_col: str, fraction: float = 0.8) -> DataFrame:
    """Adds ``split`` (train or valid) from the id alone, independent of layout.

    The first 32 bits of md5 are compared with the fraction.
    """
    bits = F.conv(F.substring(F.md5(F.col(id_col).cast("string")), 1, 8), 16, 10).cast("long")
    return df.withColumn("split", F.when(bits < int(fraction * 2**32), "train").otherwise("valid"))


def sample_about(df: DataFrame, n: int, total: int, seed: int) -> DataFrame:
    """Bernoulli sample of about n of total rows."""
    return df.sample(fraction=min(1.0, n / max(total, 1)), seed=seed)


def random_split(df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = SEED) -> list[DataFrame]:
    return df.randomSplit(list(weights), seed=seed)


def best_row(table: DataFrame, *order: Column) -> DataFrame:
    return table.orderBy(*order).limit(1)


def best_per_group(table: DataFrame, group: Sequence[str], *order: Column) -> DataFrame:
    ranked = table.withColumn("_rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def same_sample(stored: DataFrame, drawn: DataFrame, id_col: str, order: str) -> DataFrame:
    """Positions at which a stored id list and a re-drawn one differ.

    Both lists are samples of bounded size, so numbering them is cheap.
    """
    numbered = [
        f.select(id_col, F.row_number().over(Window.orderBy(order, id_col)).alias("position")) for f in (stored, drawn)
    ]
    a, b = numbered[0], numbered[1].withColumnRenamed(id_col, "_drawn")
    return a.join(b, "position", "full_outer").agg(
        F.count(F.lit(1)).alias("positions"),
        F.count_if(~F.col(id_col).eqNullSafe(F.col("_drawn"))).alias("different"),
    )

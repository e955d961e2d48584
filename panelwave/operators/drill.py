"""Stored reports against recomputed ones: fingerprints of buckets first, rows only where those differ."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwave.functions.numeric import close_to
from panelwave.operators.shape import rows_from, struct

BUCKETS = 256
BUCKET = "_bucket"


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    """Bucket of a key; NULL parts count by their place."""
    return F.pmod(F.xxhash64(*[x for k in keys for x in (F.col(k), F.col(k).isNull())]), F.lit(buckets)).cast("int").alias(BUCKET)


def _marks(df: DataFrame, keys: Sequence[str], values: Sequence[str], tolerance: float) -> DataFrame:
    """``(bucket, rows, mark)``: what identifies the rows of a bucket, in any order.

    Values are rounded to a step of at most the tolerance first, so sums added up in another order mostly agree. Values
    that fall on two sides of a step only cause a closer look; two that fall on one are within the tolerance.
    """
    places = math.ceil(-math.log10(tolerance))
    cells = [F.col(k) for k in keys] + [F.round(F.col(v).cast("double"), places) + F.lit(0.0) for v in values]
    row = F.xxhash64(*[x for c in cells for x in (c, c.isNull())])
    return df.groupBy(BUCKET).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(row.cast("decimal(20,0)")).cast("string").alias("mark")
    )


def store_report(
    report: DataFrame, path: str, keys: Sequence[str], values: Sequence[str], buckets: int = BUCKETS, tolerance: float = 1e-6
) -> None:
    """The report by bucket of its key, and next to it the marks of the buckets."""
    spark = report.sparkSession
    rows = report.select(*keys, *values, _bucket(keys, buckets))
    rows.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{path}/rows")
    # An empty report has no bucket folder to read the columns from.
    marks = _marks(spark.read.schema(rows.schema).parquet(f"{path}/rows"), keys, values, tolerance)
    marks.write.mode("overwrite").parquet(f"{path}/marks")


def differing_buckets(path: str, again: DataFrame, keys: Sequence[str], values: Sequence[str],
                      buckets: int = BUCKETS, tolerance: float = 1e-6) -> list[int]:
    """Buckets whose marks differ: at most ``buckets`` whole numbers, whatever the size of the report."""
    stored = again.sparkSession.read.parquet(f"{path}/marks")
    found = _marks(again.select(*keys, *values, _bucket(keys, buckets)), keys, values, tolerance)
    both = stored.unionByName(found).groupBy(BUCKET, "rows", "mark").agg(F.count(F.lit(1)).alias("n"))
    return sorted(r[BUCKET] for r in both.where("n <> 2").select(BUCKET).distinct().collect())


def changed_cells(
    path: str, again: DataFrame, keys: Sequence[str], values: Sequence[str], buckets: int = BUCKETS, tolerance: float = 1e-6
) -> DataFrame:
    """``(keys, metric, stored, recomputed, stored_rows, recomputed_rows)`` of the cells that differ.

    Only the folders of differing buckets are read. Both sides are stacked and aggregated by key, in place of a join, so
    NULL keys compare equal and repeated keys form no pairs. Of the rows of a repeated key the extremes are compared;
    ``stored`` and ``recomputed`` are the larger ones. A key of one side alone shows with 0 rows on the other.
    """
    wrong = differing_buckets(path, again, keys, values, buckets, tolerance)
    inside = F.col(BUCKET).isin(wrong) if wrong else F.lit(False)
    again = again.select(*keys, *values, _bucket(keys, buckets))
    stored = again.sparkSession.read.schema(again.schema).parquet(f"{path}/rows")
    sides = stored.where(inside).withColumn("_side", F.lit(0)).unionByName(again.where(inside).withColumn("_side", F.lit(1)))
    cells = rows_from(sides, [*keys, "_side"], [struct(metric=v, value=F.col(v).cast("double")) for v in values])
    side = {n: F.when(F.col("_side") == i, F.col("value")) for i, n in enumerate(("stored", "recomputed"))}
    per_key = cells.groupBy(*keys, "metric").agg(
        *[F.max(v).alias(n) for n, v in side.items()],
        *[F.min(v).alias(f"_{n}") for n, v in side.items()],
        *[F.count(v).alias(f"_n_{n}") for n, v in side.items()],
        *[F.count_if(F.col("_side") == i).alias(f"{n}_rows") for i, n in enumerate(side)],
    )
    def same(a: str, b: str) -> Column:
        return (F.col(a).isNull() & F.col(b).isNull()) | F.coalesce(close_to(F.col(a), F.col(b), tolerance), F.lit(False))

    equal = (
        (F.col("stored_rows") == F.col("recomputed_rows")) & (F.col("_n_stored") == F.col("_n_recomputed"))
        & same("stored", "recomputed") & same("_stored", "_recomputed")
    )
    return per_key.where(~equal).select(*keys, "metric", "stored", "recomputed", "stored_rows", "recomputed_rows")

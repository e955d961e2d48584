"""Stages stored by record id, bucketed and sorted, so that two of them meet without moving a row."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Distinct rows that a bucket is meant to hold.
ROWS_PER_BUCKET = 4_000_000
MOST_BUCKETS = 65_536
#: Distinct rows of a bucket where the rows decide: one task holds a bucket of both stages while they meet.
ROWS_PER_TASK = 500_000
TIMES = "_times"


@dataclass(frozen=True)
class KeyedStage:
    """``rows``: the distinct rows that have a key, bucketed by it; ``keyless``: those whose key is NULL.

    Both carry ``_times``, the number of equal rows that each stands for.
    """

    rows: DataFrame
    keyless: DataFrame
    key: str
    buckets: int


def _named() -> str:
    return f"keyed_{uuid.uuid4().hex}"


def buckets_for(rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """A power of two, so that stages of similar sizes mostly agree; it depends on the rows alone."""
    wanted = max(1, -(-rows // rows_per_bucket))
    return min(MOST_BUCKETS, 1 << (wanted - 1).bit_length())


def store_keyed(df: DataFrame, path: str, key: str, buckets: int | None = None) -> KeyedStage:
    """Writes ``df`` below ``path`` by ``key`` and opens it again.

    Equal rows are counted before they are moved, so a row that a third of the table repeats is one row of its bucket.
    Rows without a key meet nothing; they lie apart, where they crowd no bucket. Without ``buckets`` the number follows
    from the distinct rows. Stages that are to meet need the same number: pass on that of the first.
    """
    spark = df.sparkSession
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(TIMES))
    counted.write.parquet(f"{path}/counted")
    counted = spark.read.schema(counted.schema).parquet(f"{path}/counted")
    keyed = counted.where(F.col(key).isNotNull())
    buckets = buckets or buckets_for(keyed.count(), ROWS_PER_TASK)
    placed = keyed.repartition(buckets, key)
    placed.write.bucketBy(buckets, key).sortBy(key).option("path", f"{path}/rows").format("parquet").saveAsTable(_named())
    counted.where(F.col(key).isNull()).write.parquet(f"{path}/keyless")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in counted.schema.fields)
    spark.createDataFrame([(key, buckets, fields)], "key string, buckets int, fields string").coalesce(1).write.parquet(f"{path}/layout")
    return open_keyed(spark, path)


def open_keyed(spark: SparkSession, path: str) -> KeyedStage:
    """A stored stage with its layout, also in a session that did not write it. Without a layout the write had not ended."""
    layout = spark.read.parquet(f"{path}/layout").first()
    name, where = _named(), path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({layout.fields}) USING parquet CLUSTERED BY (`{layout.key}`) SORTED BY (`{layout.key}`) "
        f"INTO {layout.buckets} BUCKETS LOCATION '{where}/rows'"
    )
    return KeyedStage(spark.table(name), spark.read.schema(layout.fields).parquet(f"{path}/keyless"), layout.key, layout.buckets)


def _per_key(stage: KeyedStage, key: str, values: tuple[str, ...], side: str) -> DataFrame:
    known = [
        x
        for v in values
        for x in (F.min(v).alias(f"{side}_min_{v}"), F.max(v).alias(f"{side}_max_{v}"), F.sum(F.when(F.col(v).isNotNull(), F.col(TIMES))).alias(f"{side}_n_{v}"))
    ]
    return stage.rows.groupBy(F.col(stage.key).alias(key)).agg(F.sum(TIMES).alias(f"{side}_rows"), *known)


def meet(left: KeyedStage, right: KeyedStage, *values: str) -> DataFrame:
    """One row per key of either stage: the key, ``l_rows`` and ``r_rows`` (0 where a side lacks it), and ``same``.

    ``same`` holds where both sides have the key equally often with equal least and largest ``values`` and as many NULLs;
    it is NULL where a side lacks the key. Both stages are aggregated and joined where they lie.
    """
    if left.buckets != right.buckets:
        raise ValueError(f"{left.buckets} and {right.buckets} buckets: these stages do not meet in place")
    key = left.key
    both = _per_key(left, key, values, "l").join(_per_key(right, key, values, "r"), key, "full_outer")
    same: Column = F.col("l_rows") == F.col("r_rows")
    for v in values:
        for part in ("min", "max", "n"):
            same = same & F.col(f"l_{part}_{v}").eqNullSafe(F.col(f"r_{part}_{v}"))
    present = F.col("l_rows").isNotNull() & F.col("r_rows").isNotNull()
    rows = [F.coalesce(f"{s}_rows", F.lit(0)).cast("long").alias(f"{s}_rows") for s in ("l", "r")]
    return both.select(key, *rows, F.when(present, same).alias("same"))


def difference(left: KeyedStage, right: KeyedStage, *values: str) -> DataFrame:
    """One row: how the keys of ``left`` stand to those of ``right``, and what neither can compare.

    ``orphans`` and ``missing`` are keys of one side alone, ``repeated`` keys that the left side has more than once,
    ``keyless`` its rows without a key, ``changed`` and ``equal`` keys of both.
    """
    l, r = F.col("l_rows"), F.col("r_rows")
    return meet(left, right, *values).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(n) for n, c in (("rows", l), ("right_rows", r))],
        F.count_if(l > 1).alias("repeated"),
        F.count_if((l > 0) & (r == 0)).alias("orphans"),
        F.count_if((l == 0) & (r > 0)).alias("missing"),
        F.count_if(~F.col("same")).alias("changed"),
        F.count_if(F.col("same")).alias("equal"),
    ).withColumn("keyless", left.keyless.agg(F.coalesce(F.sum(TIMES), F.lit(0)).cast("long")).scalar())


def group_sizes(stage: KeyedStage, group: str) -> DataFrame:
    """``(group, rows)`` of a stage, rows without a key included."""
    both = stage.rows.select(group, TIMES).unionAll(stage.keyless.select(group, TIMES))
    return both.groupBy(group).agg(F.sum(TIMES).cast("long").alias("rows"))

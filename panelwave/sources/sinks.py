"""Writing stages, models and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_periods(df: DataFrame, path: str, period: str, row: str) -> None:
    """Partitioned by period, replacing only the periods that are in ``df``.

    Rows are brought together by period in one shuffle. The rebalance lets
    adaptive execution split a period that holds most of the rows over many
    writers and merge small ones, by their actual sizes.
    """
    (
        df.hint("rebalance", period)
        .sortWithinPartitions(period, row)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(period)
        .parquet(path)
    )


def write_sorted(df: DataFrame, path: str, *order: str) -> None:
    """Globally ordered part files (file order is row order) without a single writer."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def to_json_rows(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct("*")).alias("json"))


def save_model(model, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def write_stage(df: DataFrame, path: str) -> DataFrame:
    """Write a frame and continue from the files: later reports do not compute it again."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_verified(df: DataFrame, path: str, key: Sequence[str]) -> DataFrame:
    """Write scored rows, then compare the re-read count with the rows that were written.

    The written rows are counted by an observation during the write itself.
    """
    written = Observation("written")
    stored = write_stage(df.observe(written, F.count(F.lit(1)).alias("rows")), path)
    return stored.select(*key).agg(
        F.lit(written.get["rows"]).cast("long").alias("written_rows"),
        F.count(F.lit(1)).alias("stored_rows"),
        F.count_if(F.greatest(*[F.col(k).isNull() for k in key], F.lit(False))).alias("null_keys"),
    ).withColumn("complete", F.col("written_rows") == F.col("stored_rows"))


def read_stage(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    frame = spark.read.parquet(path)
    return frame.select(*columns) if columns else frame


def first_records(df: DataFrame, n: int, *order: str) -> DataFrame:
    """First n rows in the given order; planned as a bounded top-n, not a full sort."""
    return df.orderBy(*order).limit(n)

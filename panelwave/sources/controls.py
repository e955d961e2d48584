"""Small control and dimension tables that come from the spec, not from data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwave.spec import UNKNOWN, Control

def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Driver rows as a DataFrame; Spark knows its size and picks the join."""
    return spark.createDataFrame(list(rows), schema)


def label_table(spark: SparkSession, labels: Mapping[str, Mapping[str, str]]) -> DataFrame:
    rows = [(variable, code, text) for variable, codes in labels.items() for code, text in codes.items()]
    return small_table(spark, rows, "variable string, code string, label string")


def control_table(spark: SparkSession, controls: Sequence[Control]) -> DataFrame:
    rows = [(c.name, p, c.expected) for c in controls for p in c.periods]
    return small_table(spark, rows, "name string, period string, expected long")


def with_label(df: DataFrame, code: str, labels: Mapping[str, str], name: str = "label") -> DataFrame:
    """Human label of a code column; unknown and NULL codes get the unknown label."""
    table = small_table(
        df.sparkSession, list(labels.items()), f"`{code}` string, `{name}` string"
    )
    joined = df.join(table, code, "left")
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(UNKNOWN)))


def label_coverage(codes: DataFrame, labels: DataFrame) -> DataFrame:
    """Codes in use ``(variable, code)`` that the label table does not name."""
    return codes.select("variable", "code").distinct().join(labels, ["variable", "code"], "left_anti")

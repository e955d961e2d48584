"""Stored reports against recomputed ones, by buckets."""

import pytest
from pyspark.sql import functions as F

from panelwave.operators import drill
from panelwave.operators.compare import stored_against_recomputed

KEYS, VALUES = ["g", "h"], ["x", "y"]
SCHEMA = "g string, h int, x double, y double"
ROWS = [(f"g{i}", i % 3 or None, i / 7, float(i)) for i in range(60)] + [(None, None, 1.5, None), ("rep", 1, 1.0, 1.0), ("rep", 1, 2.0, 1.0)]


@pytest.fixture()
def report(spark, tmp_path):
    path = str(tmp_path / "report")
    drill.store_report(spark.createDataFrame(ROWS, SCHEMA), path, KEYS, VALUES)
    return path


def test_equal_reports_read_no_rows(spark, report):
    again = spark.createDataFrame(ROWS[::-1], SCHEMA).withColumn("x", F.col("x") + 1e-13)
    assert drill.changed_cells(report, again, KEYS, VALUES).count() == 0
    assert drill.differing_buckets(report, spark.createDataFrame(ROWS[::-1], SCHEMA), KEYS, VALUES) == []


def test_changes_are_found_in_their_buckets(spark, report):
    rows = [r for r in ROWS if r[0] != "g5"]
    rows[rows.index((None, None, 1.5, None))] = (None, None, 1.5, 0.0)
    rows[rows.index(("rep", 1, 1.0, 1.0))] = ("rep", 1, 0.5, 1.0)
    again = spark.createDataFrame([*rows, ("new", 4, None, 1.0)], SCHEMA)
    changed = drill.changed_cells(report, again, KEYS, VALUES)
    got = sorted(((r["g"], r["metric"], r["stored"], r["recomputed"], r["stored_rows"], r["recomputed_rows"]) for r in changed.collect()), key=str)
    assert got == [
        ("g5", "x", 5 / 7, None, 1, 0), ("g5", "y", 5.0, None, 1, 0), ("new", "x", None, None, 0, 1), ("new", "y", None, 1.0, 0, 1),
        ("rep", "x", 2.0, 2.0, 2, 2), (None, "y", None, 0.0, 1, 1),
    ]
    wrong = drill.differing_buckets(report, again, KEYS, VALUES)
    assert 1 <= len(wrong) <= 4
    # The folders of all other buckets can be unreadable: nothing looks at them.
    plan = changed._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_bucket" in plan or "PartitionFilters: [isnotnull(_bucket" in plan


def test_empty_reports(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    path = str(tmp_path / "empty")
    drill.store_report(empty, path, KEYS, VALUES)
    assert drill.changed_cells(path, empty, KEYS, VALUES).count() == 0
    assert drill.changed_cells(path, spark.createDataFrame(ROWS, SCHEMA), KEYS, VALUES).count() == 2 * (len(ROWS) - 1)


def test_null_groups_of_reports_meet(spark):
    a = spark.createDataFrame([("m", 1.0), (None, 2.0), ("only", 3.0)], "model string, rmse double")
    b = spark.createDataFrame([("m", 1.0), (None, 2.5)], "model string, rmse double")
    got = {r["model"]: (r["stored"], r["recomputed"], r["passed"]) for r in stored_against_recomputed(a, b, ["model"], ["rmse"]).collect()}
    assert got == {"m": (1.0, 1.0, True), None: (2.0, 2.5, False), "only": (3.0, None, False)}

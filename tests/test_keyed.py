"""Stages laid out by key: comparisons in place, and what must not upset them."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from panelwave.sources.keyed import TIMES, buckets_for, difference, group_sizes, meet, open_keyed, store_keyed

FIELDS = "id long, `group` int"


def counters(left, right, *values):
    return difference(left, right, *values).first().asDict()


def test_every_kind_of_damage(spark, tmp_path):
    right = [(i, i % 3) for i in range(100)]
    left = [(i, i % 3) for i in range(2, 98)] + [(5, 2)] * 500 + [(None, 1)] * 40 + [(None, None), (1000, 0)]
    left[10] = (12, 1)
    a = store_keyed(spark.createDataFrame(left, FIELDS), str(tmp_path / "a"), "id", 4)
    b = store_keyed(spark.createDataFrame(right, FIELDS), str(tmp_path / "b"), "id", 4)
    want = {"rows": 597, "right_rows": 100, "repeated": 1, "orphans": 1, "missing": 4, "changed": 2, "equal": 94, "keyless": 41}
    assert counters(a, b, "group") == want
    assert counters(b, b, "group") == {"rows": 100, "right_rows": 100, "equal": 100} | dict.fromkeys(("repeated", "orphans", "missing", "changed", "keyless"), 0)
    # Equal rows are one row of a bucket; nothing is lost.
    assert a.rows.where("id = 5").select(TIMES).first()[0] == 501
    assert {r["group"]: r["rows"] for r in group_sizes(a, "group").collect()} == Counter(g for _, g in left)


def test_null_values_compare_equal(spark, tmp_path):
    rows = spark.createDataFrame([(1, None), (2, 1), (3, None)], FIELDS)
    a = store_keyed(rows, str(tmp_path / "a"), "id", 2)
    b = store_keyed(rows.withColumn("group", F.when(F.col("id") == 3, 0).otherwise(F.col("group"))), str(tmp_path / "b"), "id", 2)
    assert {r["id"]: r["same"] for r in meet(a, b, "group").collect()} == {1: True, 2: True, 3: False}


def test_no_row_moves(spark, tmp_path):
    rows = spark.range(5000).select("id", (F.col("id") % 7).cast("int").alias("group"))
    for name in ("a", "b"):
        store_keyed(rows, str(tmp_path / name), "id", 8)
    a, b = (open_keyed(spark, str(tmp_path / n)) for n in ("a", "b"))
    plan = meet(a, b, "group")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Bucketed: true") == 2
    assert counters(a, b, "group")["equal"] == 5000


def test_empty_stage_and_other_buckets(spark, tmp_path):
    rows = spark.createDataFrame([(1, 1)], FIELDS)
    a, none = store_keyed(rows, str(tmp_path / "a"), "id"), store_keyed(rows.limit(0), str(tmp_path / "none"), "id")
    assert (a.buckets, none.buckets) == (1, 1)
    assert counters(none, a, "group")["missing"] == 1 and counters(none, none)["rows"] == 0
    with pytest.raises(ValueError, match="buckets"):
        meet(a, store_keyed(rows, str(tmp_path / "c"), "id", 2))


def test_buckets_follow_rows():
    assert [buckets_for(n) for n in (0, 4_000_000, 4_000_001, 10**8, 10**12)] == [1, 1, 2, 32, 65_536]


def test_a_task_holds_a_bounded_bucket(spark, tmp_path):
    rows = spark.range(1_000_001).select("id", F.lit(1).alias("group"))
    stage = store_keyed(rows, str(tmp_path / "a"), "id")
    assert stage.buckets == 4
    assert max(r[0] for r in stage.rows.groupBy(F.input_file_name()).count().select("count").collect()) < 500_000

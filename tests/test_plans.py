"""Shapes the physical plans must keep."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from panelwave.operators import compare, evaluate, population, profile, sampling
from panelwave.operators.quantiles import exact_quantiles
from panelwave.workload.audits import RULES

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables are not here")
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "BatchEval")


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lines(spark):
    return spark.read.parquet(f"{DATA}/lineitem.parquet")


@pytest.fixture(scope="module")
def orders(spark):
    return spark.read.parquet(f"{DATA}/orders.parquet")


def test_no_cross_join_and_no_python_worker(lines, orders):
    banded = evaluate.with_band(evaluate.predict_mean(orders, orders, "o_totalprice"), "o_totalprice")
    frames = [
        exact_quantiles(lines, ["l_quantity", "l_tax"], [0.5], ["l_returnflag"]),
        profile.tail_concentration(orders, "o_totalprice"),
        profile.histogram(orders, "o_totalprice"),
        evaluate.error_table(banded, "o_totalprice", {"b": "pred_baseline"}, ["o_orderstatus", "band"]),
        compare.coverage(orders, orders, "o_orderkey", ["o_orderstatus"]),
        sampling.sample_by_hash(orders, "o_orderkey"),
    ]
    for frame in frames:
        assert not [word for word in FORBIDDEN if word in plan(frame)]


def test_audits_read_only_their_columns_in_one_scan(lines):
    text = plan(population.funnel(lines.select("l_quantity", "l_returnflag", "l_linestatus", "l_extendedprice", "l_tax", "l_discount", "l_linenumber"), RULES))
    assert text.count("FileScan") == 1 and "l_partkey" not in text and "l_shipdate" not in text


def test_eligibility_rules_reach_the_scan(spark, lines):
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")  # the plan text cuts long lists off otherwise
    try:
        text = plan(population.eligible(lines, RULES).select("l_orderkey"))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(l_quantity,5.0)" in text and "GreaterThan(l_extendedprice,2000.0)" in text


def test_top_n_is_not_a_full_sort(orders):
    assert "TakeOrderedAndProject" in plan(sampling.sample_by_hash(orders, "o_orderkey"))


def test_hot_value_is_counted_before_the_shuffle(lines):
    text = plan(exact_quantiles(lines.withColumn("v", F.lit(1.0)), ["v"], [0.5]))
    assert "partial_count(1)" in text

"""The fused check suite on rows that break each check, and its plan."""

import re

from pyspark.sql import functions as F

from panelwave.operators import suite as s
from panelwave.spec import PanelSpec, Rule

SPEC = PanelSpec(
    types={"k": "bigint", "q": "int", "age": "int", "pay": "double"},
    keys=("k",),
    rules=(Rule("1_age", "age >= 15"), Rule("2_pay", "pay > 0")),
    audited_codes={"q": (1, 2)},
    measures={"income": "pay"},
    categories={"Q": ("q", (1,))},
    target="income",
    predictors=(),
    violations={"poor": "income < 10"},
)
ROWS = [
    ("a", "1", "1", "20", "50"), ("a", "1", "1", "20", "50"), ("a", "2", "9", "x", "5"), ("a", None, "1", None, None),
    ("b", "1", "2", "30", "5"), (None, "7", None, "40", "70"),
]


def stage(spark, rows=ROWS):
    raw = spark.createDataFrame(rows, "period string, k string, q string, age string, pay string")
    return s.type_with_marks(raw, SPEC.types, ("period",))


def found(df):
    return {(r["scope"], r["measure"]): (r["observed"], r["expected"], r["passed"], r["severity"]) for r in df.collect()}


def controls(spark, *rows):
    return spark.createDataFrame(list(rows), s.CONTROL_SCHEMA)


def test_every_broken_row_shows(spark):
    wanted = controls(spark, ("a", "rows", 4), ("a", "quarter 1", 3), ("a", "eligible", 3), ("a", "missing pay", 1), ("c", "rows", 2), ("both", "rows", 5))
    got = found(s.suite(stage(spark), SPEC, wanted, {"both": ("a", "b")}, "q"))
    assert got["a", "rows"] == (4, 4, True, "error")
    assert got["a", "quarter 1"] == (3, 3, True, "error")
    assert got["a", "quarter 9"] == (1, 0, False, "error")
    assert got["a", "eligible"] == (2, 3, False, "error")
    assert got["a", "missing pay"] == (1, 1, True, "warn")
    assert got["a", "unconvertible age"] == (1, 0, False, "warn")
    assert got["a", "out of domain q"] == (1, 0, False, "warn")
    assert got["a", "null keys"] == (1, 0, False, "error")
    assert got["a", "surplus keys"] == (1, 0, False, "error") and got["a", "exact copies"] == (1, 0, False, "error")
    assert got["a", "funnel"] == (0, 0, True, "error")
    assert got["b", "unknown Q"] == (1, 0, False, "error") and got["b", "poor"] == (1, 0, False, "error")
    assert got["both", "rows"] == (5, 5, True, "error") and ("both", "eligible") not in got
    # A period without a control, a control without a period, and the NULL period.
    assert got["b", "rows"] == (1, None, False, "error")
    assert got["c", "rows"] == (0, 2, False, "error")
    assert got[None, "rows"][0] == 1 and got[None, "quarter NULL"] == (1, 0, False, "error")


def test_without_controls_counts_are_free(spark):
    got = found(s.suite(stage(spark), SPEC))
    assert not any(m in ("rows", "eligible") or m.startswith(("missing", "quarter")) for _, m in got)
    assert got["a", "surplus keys"][2] is False


def test_empty_stage(spark):
    assert found(s.suite(stage(spark, []), SPEC)) == {}
    assert found(s.suite(stage(spark, []), SPEC, controls(spark, ("a", "rows", 1))))["a", "rows"] == (0, 1, False, "error")


def test_two_scans(spark, tmp_path):
    stage(spark).write.parquet(str(tmp_path / "stage"))
    read = spark.read.parquet(str(tmp_path / "stage"))
    wanted = controls(spark, ("a", "rows", 4))
    plan = s.suite(read, SPEC, wanted, {"both": ("a", "b")}, "q").select(F.count(F.lit(1)))._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("FileScan parquet", plan)) == 2
    assert "Join" not in plan

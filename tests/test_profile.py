import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelwave.operators import association, profile, textaudit
from panelwave.operators.quantiles import exact_quantiles, exact_thresholds, magnitude_bucket

LEVELS = [0.0, 0.25, 0.5, 0.9, 0.95, 1.0]


def quantiles(spark, rows):
    df = spark.createDataFrame(rows, "g string, v double")
    return {r.g: list(r)[2:] for r in exact_quantiles(df, ["v"], LEVELS, ["g"]).collect()}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.floats(-1e12, 1e12)), min_size=1, max_size=60))
def test_exact_quantiles_equal_numpy(spark, rows):
    got = quantiles(spark, rows)
    for g in {r[0] for r in rows}:
        want = np.quantile([v for k, v in rows if k == g], LEVELS)
        assert np.allclose(got[g], want, rtol=1e-9, atol=1e-9)


def test_exact_quantiles_with_a_hot_value_and_a_hot_group(spark):
    rng = random.Random(1)
    rows = [("hot", 7.0)] * 3000 + [("hot", rng.lognormvariate(8, 1)) for _ in range(2000)] + [("cold", float(i)) for i in range(5)]
    rows += [("hot", None), ("hot", float("nan"))]
    got = quantiles(spark, rows)
    for g in ("hot", "cold"):
        values = [v for k, v in rows if k == g and v is not None and not math.isnan(v)]
        assert np.allclose(got[g], np.quantile(values, LEVELS))


def test_bucket_rises_with_the_value(spark):
    values = sorted([0.0, -1.0, 1.0, 2.0**52, -(2.0**52), 1e-300, 5e-324, 1e308] + [math.nextafter(2.0**k, s) for k in range(-40, 60) for s in (0, 1e300)])
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", magnitude_bucket(F.col("v")).alias("b"))
    buckets = [r.b for r in df.orderBy("v").collect()]
    assert buckets == sorted(buckets)


def test_summary_equals_builtins_and_layout_does_not_matter(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([(i % 3, rng.gauss(10, 3), float(i % 7) if i % 5 else None) for i in range(900)], "g int, x double, y double")
    want = {
        (r.g, c): (r[f"{c}q"], r[f"{c}s"], r[f"{c}n"])
        for r in df.groupBy("g").agg(
            *[f for c in "xy" for f in (F.expr(f"percentile({c}, array(0.25, 0.5, 0.75, 0.95))").alias(f"{c}q"), F.skewness(c).alias(f"{c}s"), F.count(c).alias(f"{c}n"))]
        ).collect()
        for c in "xy"
    }
    for frame in (df, df.repartition(9), df.coalesce(1)):
        got = profile.numeric_summary(frame, ["x", "y"], ["g"]).collect()
        assert len(got) == 6
        for r in got:
            q, s, n = want[(r.g, r.variable)]
            assert np.allclose([r.p25, r.p50, r.p75, r.p95], q) and math.isclose(r.skewness, s, rel_tol=1e-9) and r.n == n


def test_constant_column_has_no_shape(spark):
    row = profile.numeric_summary(spark.createDataFrame([(1.0,), (1.0,)], "x double"), ["x"]).first()
    assert row.skewness is None and row.sd == 0.0 and row.p95 == 1.0


def test_histogram_keeps_the_maximum_and_empty_bins(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 0, 1, 9, 10)], "x double")
    got = profile.histogram(df, "x", 10).orderBy("bin").collect()
    assert [r.n for r in got] == [2, 1, 0, 0, 0, 0, 0, 0, 0, 2]
    flat = profile.histogram(df.where("x = 0"), "x", 4).orderBy("bin").collect()
    assert [r.n for r in flat] == [2, 0, 0, 0]


def test_tail_and_mode(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 2.0), ("b", 3.0), ("a", 100.0)], "c string, v double")
    tail = profile.tail_concentration(df, "v").first()
    assert tail.n_high == 1 and math.isclose(tail.high_mass_pct, 100 * 100 / 106) and tail.above_mean_pct == 25.0
    mode = profile.modal_category(df, "c").first()
    assert (mode.c, mode.n, mode.pct) == ("a", 2, 50.0)


def test_category_shares_with_null_category(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0), (None, 4.0)], "c string, v double")
    got = {r.c: (r.n, r.median) for r in profile.category_table(df, "c", "v").collect()}
    assert got == {"a": (1, 1.0), None: (2, 3.0)}


def test_pearson_leaves_out_incomplete_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 1.0, 5.0), (3.0, 4.0, 5.0), (9.0, None, 5.0)], "a double, b double, c double")
    got = {(r.var_x, r.var_y): r.r for r in association.pearson(df, ["a", "b", "c"]).collect()}
    want = np.corrcoef([1, 2, 3], [2, 1, 4])[0, 1]
    assert math.isclose(got["a", "b"], want) and got["a", "b"] == got["b", "a"] and got["a", "c"] is None
    ranked = association.ranked_with(association.pearson(df, ["a", "b", "c"]), "a").collect()
    assert [r.variable for r in ranked] == ["b", "c"]


def test_period_change_and_pivot(spark):
    df = spark.createDataFrame([("p1", 10), ("p2", 7)], "period string, n int")
    assert [r.n_change for r in profile.period_change(df, "period", ["n"]).orderBy("period").collect()] == [None, -3]
    wide = profile.pivot_table(df, "period", "period", ["p1", "p3"], F.sum("n"), 0).orderBy("period").collect()
    assert [tuple(r) for r in wide] == [("p1", 10, 0), ("p2", 0, 0)]


def brute_claims(text, patterns, negators, before, after):
    import re

    found = []
    for pattern in patterns:
        for m in re.finditer(pattern, text, flags=re.IGNORECASE):
            start = max(text.rfind(c, 0, m.start()) for c in ".;\n")
            if not re.search(rf"\b({'|'.join(negators)})\b", text[start + 1 : m.start()], flags=re.IGNORECASE):
                found.append((pattern, m.start(), text[max(0, m.start() - before) : m.end() + after].replace("\n", " ")))
    return sorted(found)


TEXTS = [
    "Esto causa efecto. No causa nada; sin duda causa", "La población guatemalteca.\nTODO EL PAÍS y todo el pais", "ni esto; causan causan", "",
    "nó causa · ñandú causa", "causa causa causa. sino causa", "x" * 100 + " provoca " + "y" * 100,
]


def test_claims_against_brute_force(spark):
    rng = random.Random(3)
    words = ["causa", "no", "sin", "ni", "provocan", ".", ";", "\n", "casa", "à", "los guatemaltecos", "nadie", "Ocasiona"]
    texts = TEXTS + [" ".join(rng.choice(words) for _ in range(40)) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = {}
    for r in textaudit.claims(df, "id", "t").collect():
        got.setdefault(r.id, []).append((r.pattern, r.start, r.context))
    for i, text in enumerate(texts):
        want = brute_claims(text, textaudit.CLAIM_PATTERNS, textaudit.NEGATORS, 60, 20)
        assert sorted(got.get(i, [])) == want, text


def test_hygiene_counts(spark):
    df = spark.createDataFrame([(1, "see C:\\data and /home/x TODO"), (2, "datos sintéticos"), (3, "limpio")], "id int, t string")
    got = {(r.id, r.rule): r.hits for r in textaudit.pattern_counts(df, "id", "t").collect()}
    assert [got[1, "absolute_path"], got[1, "pending_marker"], got[2, "synthetic"], got[3, "absolute_path"]] == [2, 1, 1, 0]

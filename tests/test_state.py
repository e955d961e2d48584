"""States that add up, against the same statistics over all rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwave.operators import association, evaluate, profile, state


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    data = [
        (f"p{k % 4}", "abc"[k % 3] if k % 7 else None, float(v), float(1e6 + v * 3 + rng.normal()), None if k % 5 == 0 else float(k), 2.0)
        for k, v in enumerate(rng.gamma(2.0, 50.0, 600))
    ]
    data += [("p4", "a", float("nan"), 1.0, 1.0, 2.0), ("p4", "a", float("inf"), None, 1.0, 2.0), ("p5", "z", None, None, None, 2.0)]
    return spark.createDataFrame(data, "period string, g string, x double, y double, z double, flat double").cache()


def near(got, want, keys):
    order = lambda r: tuple((r[k] is None, r[k]) for k in keys)
    got, want = sorted(got, key=order), sorted(want, key=order)
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert a.asDict().keys() == b.asDict().keys()
        for k in a.asDict():
            if isinstance(b[k], float):
                assert a[k] == pytest.approx(b[k], rel=1e-8, abs=1e-8), (k, a, b)
            else:
                assert a[k] == b[k], (k, a, b)


@pytest.mark.parametrize("by", [[], ["g"]])
def test_merged_moments_are_those_of_all_rows(rows, by):
    columns = ["x", "y", "z", "flat"]
    states = state.moment_state(rows, columns, ["period", *by])
    got = state.moments_of(state.merge_moments(states, by), by)
    near(got.collect(), profile.moments(rows, columns, by).collect(), [*by, "variable"])


def test_merging_in_two_steps_is_merging_at_once(rows):
    states = state.moment_state(rows, ["x", "y"], ["period", "g"])
    steps = state.merge_moments(state.merge_moments(states, ["g"]))
    near(state.moments_of(steps).collect(), state.moments_of(state.merge_moments(states)).collect(), ["variable"])


def test_merged_products_give_the_correlations_of_all_rows(rows):
    columns = ["x", "z", "flat"]
    finite = rows.where("x is null or (not isnan(x) and x < double('inf'))")
    got = state.pearson_of(state.merge_products(state.product_state(rows, columns, ["period"])))
    near(got.collect(), association.pearson(finite, columns).collect(), ["var_x", "var_y"])


def test_merged_errors_give_the_metrics_of_all_rows(rows):
    scored = rows.where("x < 1000").withColumn("a", F.col("x") * 0.9 + 3).withColumn("b", F.when(F.col("z") > 9, F.lit(80.0)))
    models = {"one": "a", "two": "b"}
    got = state.metrics_of(state.merge_errors(state.error_state(scored, "x", models, ["period"])))
    near(got.collect(), evaluate.metrics(scored, "x", models).collect(), ["model"])


def test_ridge_is_the_solution_of_the_penalised_equations(rows):
    known = rows.where("x < 1000").select("x", "y", "z", "period").dropna()
    a = np.array(known.select("x", "z", "y").collect())
    centred = a - a.mean(axis=0)
    states = state.merge_products(state.product_state(known, ["x", "z", "y"], ["period"]))
    solved = state.ridge(states, ["x", "z"], "y", [0.0, 5.0])
    for penalty in (0.0, 5.0):
        beta = np.linalg.solve(centred[:, :2].T @ centred[:, :2] / len(a) + penalty * np.eye(2), centred[:, :2].T @ centred[:, 2] / len(a))
        got = {r.feature: r.coefficient for r in solved.where(F.col("penalty") == penalty).collect()}
        assert [got["x"], got["z"]] == pytest.approx(beta.tolist(), rel=1e-7)
        errors = a[:, 2] - got["(intercept)"] - a[:, :2] @ beta
        of = state.linear_errors(states, ["x", "z"], "y", solved).where(F.col("penalty") == penalty).first()
        assert (of.n, of.rmse) == (len(a), pytest.approx(np.sqrt((errors**2).mean()), rel=1e-6))
    with pytest.raises(ValueError, match="no complete rows"):
        state.ridge(state.merge_products(state.product_state(known.limit(0), ["x", "y"], ["period"])), ["x"], "y", [0.0])


def test_sketches_are_merged_within_their_bound(rows):
    merged = state.merge_sketches(state.quantile_sketch(rows, ["x", "z"], ["period"], 64), k=64)
    values = sorted(r.x for r in rows.where("x < 1e9").collect())
    got = {r.variable: r for r in state.sketch_quantiles(merged, [0.25, 0.5, 0.95], k=64).collect()}
    for level, name in ((0.25, "p25"), (0.5, "p50"), (0.95, "p95")):
        rank = np.searchsorted(values, got["x"][name], side="right") / len(values)
        assert abs(rank - level) <= got["x"]["rank_error"] + 1 / len(values)
    assert got["x"].n == len(values) and state.rank_error(400) < 0.025


def test_only_the_added_period_is_read(spark, rows, tmp_path):
    rows.write.partitionBy("period").parquet(str(tmp_path / "panel"))
    panel = spark.read.parquet(str(tmp_path / "panel"))
    store = str(tmp_path / "states")
    of = lambda df, by: state.moment_state(df, ["x"], by)
    first = state.add_period(panel, store, "period", ["p0", "p1", "p2"], of)
    assert {r.period for r in first.collect()} == {"p0", "p1", "p2"}
    both = state.add_period(panel, store, "period", ["p3"], of)
    want = profile.moments(rows.where("period < 'p4'"), ["x"]).collect()
    near(state.moments_of(state.merge_moments(both)).collect(), want, ["variable"])
    plan = of(panel.where(F.col("period").isin("p3")), ["period"])._jdf.queryExecution().sparkPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan and "p3" in plan
    again = state.add_period(panel.withColumn("x", F.lit(1.0)), store, "period", ["p0"], of)
    assert {(r.period, r.mean == 1.0) for r in again.collect()} == {("p0", True), ("p1", False), ("p2", False), ("p3", False)}

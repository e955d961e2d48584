"""Statistics from stored states: only the latest period is read, the others enter as states."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwave.operators import evaluate, models, state
from panelwave.session import scratch_dir
from panelwave.sources import sinks
from panelwave.workload.frames import OBS_SQL, obs
from panelwave.workload.registry import query, rounded

MEASURES = ["target", "qty", "lines", "acctbal"]
FEATURES = ["disc", "qty", "lines", "acctbal"]
LEVELS = (0.05, 0.25, 0.5, 0.75, 0.95)


def _stage(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str], list[str]]:
    """The panel stored by year, the years before the latest one, and the latest one."""
    path = scratch_dir(spark, "panel_by_year")
    panel = obs(spark, sf_dir).withColumn("year", F.concat(F.lit("y"), F.col("year").cast("string")))
    sinks.write_periods(panel, path, "year", "id")
    stage = sinks.read_stage(spark, path)
    years = sorted(r.year for r in stage.select("year").distinct().collect())
    return stage, years[:-1], years[-1:]


def _added(spark: SparkSession, sf_dir: str, of: Callable[[DataFrame, Sequence[str]], DataFrame], by: Sequence[str] = ()) -> DataFrame:
    """States of the earlier years, stored by an earlier run, with those of the latest year added by a later run."""
    stage, earlier, latest = _stage(spark, sf_dir)
    path = scratch_dir(spark, "states")
    state.add_period(stage, path, "year", earlier, of, by)
    return state.add_period(stage, path, "year", latest, of, by)


def _moments_sql(c: str) -> str:
    return f"""SELECT segment, '{c}' AS variable, count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS sd,
 round(min({c}), 4) AS min, round(max({c}), 4) AS max,
 round(sum(power({c} - m_{c}, 3)) / count({c}) / power(var_pop({c}), 1.5), 4) + 0.0 AS skewness,
 round(sum(power({c} - m_{c}, 4)) / count({c}) / power(var_pop({c}), 2) - 3, 4) + 0.0 AS kurtosis FROM centred GROUP BY segment"""


@query(f"""WITH {OBS_SQL}, centred AS (SELECT *, {", ".join(f"avg({c}) OVER (PARTITION BY segment) AS m_{c}" for c in MEASURES)} FROM obs)
{" UNION ALL ".join(_moments_sql(c) for c in MEASURES)}""")
def state_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moments per segment over all years."""
    states = _added(spark, sf_dir, lambda df, by: state.moment_state(df, MEASURES, by), ["segment"])
    return rounded(state.moments_of(state.merge_moments(states, ["segment"]), ["segment"]), 4)


@query(f"""WITH {OBS_SQL}, c AS (SELECT * FROM obs WHERE qty IS NOT NULL AND lines IS NOT NULL)
{" UNION ALL ".join(f"SELECT '{a}' AS var_x, '{b}' AS var_y, count(*) AS n, round(corr({a}, {b}), 6) AS r FROM c" for a in MEASURES for b in MEASURES)}""")
def state_pearson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlations over all years."""
    states = _added(spark, sf_dir, lambda df, by: state.product_state(df, MEASURES, by))
    return rounded(state.pearson_of(state.merge_products(states)), 6)


def _scored(df: DataFrame) -> DataFrame:
    """Two fixed predictors; one of them says nothing on orders without lines."""
    return df.withColumn("pred_line", F.col("qty") * 1500.0).withColumn("pred_level", F.lit(140000.0))


PREDICTORS = {"line": "pred_line", "level": "pred_level"}


@query(f"""WITH {OBS_SQL}, s AS (SELECT year, target, 'line' AS model, target - qty * 1500.0 AS e FROM obs
 UNION ALL SELECT year, target, 'level', target - 140000.0 FROM obs),
v AS (SELECT max(year) AS last FROM obs),
m AS (SELECT model, year = last AS test, count(e) AS n, avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse,
  1 - avg(e * e) / var_pop(target) FILTER (e IS NOT NULL) AS r2, avg(e) AS mean_error,
  100.0 * count(*) FILTER (e > 0) / CAST(count(e) AS DOUBLE) AS pct_under FROM s, v WHERE year >= last - 1 GROUP BY 1, 2)
SELECT t.model, t.n, round(t.mae, 4) AS mae, round(t.rmse, 4) AS rmse, round(t.r2, 6) AS r2, round(t.mean_error, 4) AS mean_error,
 round(t.pct_under, 4) AS pct_under, round(t.mae - o.mae, 4) AS mae_change, round(t.rmse - o.rmse, 4) AS rmse_change
FROM m AS t JOIN m AS o ON t.model = o.model AND t.test AND NOT o.test""")
def state_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of the latest year (test) and their change against the year before (validation)."""
    states = _added(spark, sf_dir, lambda df, by: state.error_state(_scored(df), "target", PREDICTORS, by))
    years = sorted(r.year for r in states.select("year").distinct().collect())
    out = state.metric_change(states, "year", years[-2:-1], years[-1:])
    return rounded(rounded(out, 6, ["r2"]), 4, ["mae", "rmse", "mean_error", "pct_under", "mae_change", "rmse_change"])


@query(f"""WITH {OBS_SQL} {" UNION ALL ".join(f"SELECT segment, '{c}' AS variable, CAST({q} AS DOUBLE) AS level, count({c}) AS n, true AS within FROM obs GROUP BY segment"
    for c in MEASURES for q in LEVELS)}""")
def sketch_rank_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles from stored sketches of all years; their true ranks lie within the stated bound of the level."""
    states = _added(spark, sf_dir, lambda df, by: state.quantile_sketch(df, MEASURES, by), ["segment"])
    merged = state.sketch_quantiles(state.merge_sketches(states, ["segment"]), LEVELS, ["segment"])
    cells = [F.struct(F.lit(q).alias("level"), F.col(state.quantile_name(q)).alias("answer")) for q in LEVELS]
    answers = merged.select("segment", "variable", "n", "rank_error", F.inline(F.array(*cells)))
    values = obs(spark, sf_dir).select("segment", F.inline(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("value")) for c in MEASURES])))
    counted = values.where("value IS NOT NULL").groupBy("segment", "variable", "value").agg(F.count(F.lit(1)).alias("times"))
    ranked = answers.join(counted, ["segment", "variable"]).groupBy("segment", "variable", "level", "n", "rank_error").agg(
        F.sum(F.when(F.col("value") < F.col("answer"), F.col("times")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("value") <= F.col("answer"), F.col("times")).otherwise(0)).alias("upto"),
        F.max(F.col("value") == F.col("answer")).alias("is_value"),
    )
    level, n, bound = F.col("level"), F.col("n"), F.col("rank_error")
    near = (F.col("below") / n <= level + bound) & (F.col("upto") / n >= level - bound)
    return ranked.select("segment", "variable", level.cast("decimal(3,2)").cast("double").alias("level"), "n", (near & F.col("is_value")).alias("within"))


@query(f"""WITH {OBS_SQL}, f AS (SELECT regr_slope(target, qty) AS b, regr_intercept(target, qty) AS a, count(qty) AS n FROM obs WHERE qty IS NOT NULL)
SELECT n, round(a, 4) AS intercept, round(b, 6) AS slope,
 (SELECT round(sqrt(avg(power(target - a - b * qty, 2))), 4) FROM obs, f WHERE qty IS NOT NULL) AS rmse FROM f""")
def ridge_one_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line of one feature and its error, from states of the years."""
    states = state.merge_products(_added(spark, sf_dir, lambda df, by: state.product_state(df, ["qty", "target"], by)))
    line = state.ridge(states, ["qty"], "target", [0.0])
    errors = state.linear_errors(states, ["qty"], "target", line)
    value = lambda name: F.max(F.when(F.col("feature") == name, F.col("coefficient")))
    wide = line.groupBy("penalty").agg(value("(intercept)").alias("intercept"), value("qty").alias("slope"))
    joined = wide.join(errors, "penalty")
    return joined.select("n", F.round("intercept", 4).alias("intercept"), F.round("slope", 6).alias("slope"), F.round("rmse", 4).alias("rmse"))


@query(f"""WITH {OBS_SQL}, n AS (SELECT count(*) FILTER (year >= 2000) AS valid_rows FROM obs WHERE qty IS NOT NULL)
SELECT unnest([0.0, 10.0, 100.0, 1000.0]::DOUBLE[]) AS penalty, valid_rows, true AS same_coefficients, true AS same_rmse FROM n""")
def ridge_against_fits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The linear fits of the grid against the solution of their normal equations, both from the same training rows.

    The iterative solver stops at a relative change of its objective, which
    leaves coefficients up to 0.0006 of their size from the solution; errors
    agree to a millionth.
    """
    panel = obs(spark, sf_dir).where("qty IS NOT NULL")
    train, valid = panel.where("year < 2000"), panel.where("year >= 2000")
    penalties = [0.0, 10.0, 100.0, 1000.0]
    configs = models.settings("linear", "lr_{regParam}", regParam=penalties, elasticNetParam=(0.0,))
    grid = models.fit_grid(train, valid, "id", "target", FEATURES, [], configs)
    scaler = grid.features.stages[-1]
    scale = {c: (float(m), float(s)) for c, m, s in zip(FEATURES, scaler.mean, scaler.std, strict=True)}

    def standard(df: DataFrame) -> DataFrame:
        return df.select("target", *[((F.col(c) - m) / s).alias(c) for c, (m, s) in scale.items()])

    columns = [*FEATURES, "target"]
    fitted, held = (state.merge_products(state.product_state(standard(df), columns)) for df in (train, valid))
    # The fits work on the target in units of its sample deviation, which divides their penalty.
    spread = math.sqrt(fitted.where("var_x = 'target' AND var_y = 'target'").select(F.col("product") / (F.col("n") - 1)).first()[0])
    solved = state.ridge(fitted, FEATURES, "target", [p / spread for p in penalties])
    solved = solved.withColumn("penalty", F.round(F.col("penalty") * spread, 6))
    rows = [
        (float(dict(c.params)["regParam"]), f, float(b))
        for name, model in grid.models.items()
        for c in [grid.configs[name]]
        for f, b in zip(["(intercept)", *FEATURES], [model.intercept, *model.coefficients], strict=True)
    ]
    fits = spark.createDataFrame(rows, "penalty double, feature string, fit double")
    same = solved.join(fits, ["penalty", "feature"]).groupBy("penalty").agg(
        F.every(F.abs(F.col("fit") - F.col("coefficient")) <= 1e-3 * F.greatest(F.lit(1.0), F.abs("coefficient"))).alias("same_coefficients")
    )
    errors = state.linear_errors(held, FEATURES, "target", solved).select("penalty", "n", "rmse")
    regs = spark.createDataFrame([(n, float(dict(c.params)["regParam"])) for n, c in grid.configs.items() if n in grid.models], "config_id string, penalty double")
    scored = grid.results.select("config_id", F.col("rmse").alias("fit_rmse")).join(regs, "config_id")
    close = F.abs(F.col("fit_rmse") - F.col("rmse")) <= 1e-6 * F.col("rmse")
    return same.join(errors, "penalty").join(scored, "penalty").select("penalty", F.col("n").alias("valid_rows"), "same_coefficients", close.alias("same_rmse"))

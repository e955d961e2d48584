"""Standardising, segments, regression under a split by period, error diagnosis."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwave.operators import checks as ck
from panelwave.operators import compare, evaluate, models, profile, sampling, segments
from panelwave.session import scratch_dir
from panelwave.sources import sinks
from panelwave.workload.frames import OBS_SQL, obs
from panelwave.workload.registry import query, rounded

TRAIN_YEARS = (1995, 1996, 1997, 1998, 1999)
TEST_YEARS = (2000, 2001)
MODELS = {"baseline": "pred_baseline", "line": "pred_line"}
GROUPS = ["segment", "status", "band"]
NUMERIC = ["qty", "lines", "acctbal"]
CATEGORIES = ["segment", "status", "priority"]
FEATURES = ["z_target", "z_acctbal", "z_person"]
CENTERS = ((-1.0, -0.5, -1.0), (0.0, 0.5, 1.0), (1.0, 0.0, -0.5))


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    panel = obs(spark, sf_dir).withColumn("qty", F.coalesce("qty", F.lit(0.0)))
    return models.split_by_period(panel, "year", TRAIN_YEARS, TEST_YEARS)


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows with two predictions that SQL can reproduce, stored as scored rows are."""
    train, test = _sides(spark, sf_dir)
    test = test.select("id", "period", "year", "segment", "status", "target", "qty")
    scored = evaluate.predict_line(train, evaluate.predict_mean(train, test, "target"), "target", "qty")
    return sinks.write_stage(scored, scratch_dir(spark, "scored"))


def _banded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.with_band(_scored(spark, sf_dir), "target")


SCORED_SQL = f"""{OBS_SQL},
o AS (SELECT * REPLACE (coalesce(qty, 0) AS qty) FROM obs),
fit AS (SELECT avg(target) AS m, regr_intercept(target, qty) AS a, regr_slope(target, qty) AS b FROM o WHERE year < 2000),
scored AS (SELECT id, period, segment, status, target, qty, m AS pred_baseline, a + b * qty AS pred_line FROM o, fit WHERE year >= 2000),
cut AS (SELECT quantile_cont(target, [0.25, 0.5, 0.75, 0.9, 0.95]) AS q FROM scored),
banded AS (SELECT scored.*, CASE WHEN target < q[1] THEN '<P25' WHEN target < q[2] THEN 'P25-P50' WHEN target < q[3] THEN 'P50-P75'
 WHEN target < q[4] THEN 'P75-P90' WHEN target < q[5] THEN 'P90-P95' ELSE '>=P95' END AS band FROM scored, cut),
long AS (SELECT *, 'baseline' AS model, pred_baseline AS p FROM banded UNION ALL SELECT *, 'line', pred_line FROM banded)"""

METRICS_SQL = """metrics AS (SELECT model, count(*) AS n, avg(abs(target - p)) AS mae, sqrt(avg((target - p) * (target - p))) AS rmse,
 1 - avg((target - p) * (target - p)) / var_pop(target) AS r2, avg(target - p) AS mean_error,
 100.0 * count(*) FILTER (target > p) / CAST(count(*) AS DOUBLE) AS pct_under FROM long GROUP BY 1)"""

ERRORS_SQL = """errors AS (SELECT grouping, label, model, count(*) AS rows, avg(target) AS mean_actual, avg(abs(target - p)) AS mae,
 avg(target - p) AS mean_error, sqrt(avg((target - p) * (target - p))) AS rmse, avg(p) AS mean_prediction,
 100.0 * count(*) FILTER (target > p) / CAST(count(*) AS DOUBLE) AS pct_under FROM (
 SELECT 'segment' AS grouping, segment AS label, * FROM long UNION ALL SELECT 'status', status, * FROM long
 UNION ALL SELECT 'band', band, * FROM long UNION ALL SELECT 'overall', 'all', * FROM long) GROUP BY 1, 2, 3)"""


@query(f"WITH {SCORED_SQL} SELECT id, target, round(pred_baseline, 4) AS pred_baseline, round(pred_line, 4) AS pred_line, "
       "round(target - pred_baseline, 4) AS residual_baseline, round(target - pred_line, 4) AS residual_line FROM scored")
def scored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = evaluate.with_residuals(_scored(spark, sf_dir), "target", MODELS)
    return rounded(scored.select("id", "target", *MODELS.values(), "residual_baseline", "residual_line"), 4)


@query(f"""WITH {SCORED_SQL}, {METRICS_SQL} SELECT model, n, round(mae, 4) AS mae, round(rmse, 4) AS rmse, round(r2, 6) AS r2,
 round(mean_error, 4) AS mean_error, round(pct_under, 6) AS pct_under FROM metrics WHERE model = 'baseline'""")
def baseline_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = evaluate.metrics(_scored(spark, sf_dir), "target", {"baseline": "pred_baseline"})
    return rounded(rounded(table, 6, ["r2", "pct_under"]), 4, ["mae", "rmse", "mean_error"])


@query(f"""WITH {SCORED_SQL}, {METRICS_SQL} SELECT model, n, round(mae, 4) AS mae, round(rmse, 4) AS rmse, round(r2, 6) AS r2,
 round(mean_error, 4) AS mean_error, round(pct_under, 6) AS pct_under FROM metrics WHERE model = 'line'""")
def ols_one_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = evaluate.metrics(_scored(spark, sf_dir), "target", {"line": "pred_line"})
    return rounded(rounded(table, 6, ["r2", "pct_under"]), 4, ["mae", "rmse", "mean_error"])


@query(f"""WITH {SCORED_SQL} SELECT unnest(['P25', 'P50', 'P75', 'P90', 'P95']) AS band,
 CAST(unnest([0.25, 0.5, 0.75, 0.9, 0.95]) AS DOUBLE) AS level, round(unnest(q), 4) AS threshold FROM cut""")
def target_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.thresholds(_sides(spark, sf_dir)[1], "target"), 4)


@query(f"WITH {SCORED_SQL} SELECT band, count(*) AS n, min(target) AS low, max(target) AS high FROM banded GROUP BY 1")
def target_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _banded(spark, sf_dir).groupBy("band").agg(
        F.count(F.lit(1)).alias("n"), F.min("target").alias("low"), F.max("target").alias("high")
    )


@query(f"""WITH {SCORED_SQL}, {ERRORS_SQL} SELECT grouping, label, model, rows, round(mean_actual, 4) AS mean_actual, round(mae, 4) AS mae,
 round(mean_error, 4) AS mean_error, round(rmse, 4) AS rmse, round(mean_prediction, 4) AS mean_prediction, round(pct_under, 6) AS pct_under FROM errors""")
def error_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = evaluate.error_table(_banded(spark, sf_dir), "target", MODELS, GROUPS)
    places = ["mean_actual", "mae", "mean_error", "rmse", "mean_prediction"]
    return rounded(rounded(evaluate.order_error_table(errors), 6, ["pct_under"]), 4, places)


@query(f"""WITH {SCORED_SQL} SELECT model, count(*) FILTER (top) AS n_high, round(avg(e) FILTER (top), 4) AS mean_error_high,
 round(100.0 * count(*) FILTER (top AND e > 0) / CAST(count(*) FILTER (top) AS DOUBLE), 6) AS pct_under_high,
 round(avg(abs(e)) FILTER (top), 4) AS mae_high, round(avg(p) FILTER (top) / avg(target) FILTER (top), 6) AS predicted_over_actual,
 round(avg(e) FILTER (NOT top), 4) AS mean_error_rest, round(corr(target, e), 6) AS corr_target_residual,
 avg(e) FILTER (top) > 0 AND 2 * count(*) FILTER (top AND e > 0) > count(*) FILTER (top) AS systematic_under
FROM (SELECT *, target - p AS e, band = '>=P95' AS top FROM long) GROUP BY 1""")
def high_band_diagnosis(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = evaluate.high_band(_banded(spark, sf_dir), "target", MODELS)
    return rounded(rounded(table, 6, ["pct_under_high", "predicted_over_actual", "corr_target_residual"]), 4,
                   ["mean_error_high", "mae_high", "mean_error_rest"])


@query(f"""WITH {SCORED_SQL}, {ERRORS_SQL} SELECT grouping, model, label, round(mae, 4) AS mae FROM
 (SELECT *, row_number() OVER (PARTITION BY grouping, model ORDER BY mae DESC, label) AS k FROM errors WHERE grouping <> 'overall') WHERE k = 1""")
def worst_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    errors = evaluate.error_table(_banded(spark, sf_dir), "target", MODELS, GROUPS)
    return rounded(evaluate.worst_group(errors), 4)


@query(f"""WITH {SCORED_SQL}, {METRICS_SQL}, b AS (SELECT rmse AS v FROM metrics WHERE model = 'baseline')
SELECT model, round(rmse, 4) AS rmse, round(100.0 * (v - rmse) / v, 6) AS rmse_gain_pct FROM metrics, b""")
def improvement(spark: SparkSession, sf_dir: str) -> DataFrame:
    gains = evaluate.improvement(evaluate.metrics(_scored(spark, sf_dir), "target", MODELS), "baseline")
    return gains.select("model", F.round("rmse", 4).alias("rmse"), F.round("rmse_gain_pct", 6).alias("rmse_gain_pct"))


@query(f"WITH {SCORED_SQL}, {METRICS_SQL} SELECT model, round(rmse, 4) AS rmse FROM metrics ORDER BY metrics.rmse LIMIT 1")
def best_by_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = evaluate.metrics(_scored(spark, sf_dir), "target", MODELS)
    return rounded(sampling.best_row(table, F.col("rmse"), F.col("model")).select("model", "rmse"), 4)


@query(f"""WITH {SCORED_SQL}, {METRICS_SQL}, {ERRORS_SQL},
b AS (SELECT rmse AS v FROM metrics WHERE model = 'baseline'),
h AS (SELECT model, count(*) FILTER (top) AS n, avg(target - p) FILTER (top) AS e,
 100.0 * count(*) FILTER (top AND target > p) / CAST(count(*) FILTER (top) AS DOUBLE) AS u FROM (SELECT *, band = '>=P95' AS top FROM long) GROUP BY 1),
w AS (SELECT *, row_number() OVER (PARTITION BY grouping, model ORDER BY mae DESC, label) AS k FROM errors WHERE grouping <> 'overall')
SELECT model, 'all' AS subject, format('{{:,.2f}} MAE, {{:,.2f}} RMSE, {{:,.4f}} R2, {{:,.2f}} mean error, {{:,.1f}} % less RMSE than the baseline',
 mae, rmse, r2, mean_error, 100.0 * (v - rmse) / v) AS statement FROM metrics, b
UNION ALL SELECT model, 'top band', CASE WHEN e > 0 AND u > 50 THEN 'systematically too low: ' ELSE 'no systematic side: ' END ||
 format('{{:,}} rows, {{:,.2f}} mean error, {{:,.1f}} % estimated too low', n, e, u) FROM h
UNION ALL SELECT model, 'worst ' || grouping, label || ': ' || format('{{:,.2f}} MAE', mae) FROM w WHERE k = 1""")
def conclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _banded(spark, sf_dir)
    gains = evaluate.improvement(evaluate.metrics(scored, "target", MODELS), "baseline")
    worst = evaluate.worst_group(evaluate.error_table(scored, "target", MODELS, GROUPS))
    return evaluate.conclusions(gains, evaluate.high_band(scored, "target", MODELS), worst)


@query(f"WITH {SCORED_SQL} SELECT a.id, round(a.pred_baseline, 4) AS pred_baseline, round(b.pred_line, 4) AS pred_line FROM scored a JOIN scored b ON a.id = b.id")
def join_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _sides(spark, sf_dir)
    rows = test.select("id", "target", "qty")
    baseline = evaluate.predict_mean(train, rows, "target").select("id", "pred_baseline")
    line = evaluate.predict_line(train, rows, "target", "qty").select("id", "pred_line")
    return rounded(compare.join_on_id([baseline, line], "id"), 4)


@query(f"""WITH {SCORED_SQL} SELECT count(*) FILTER (year < 2000) AS train_rows, count(*) FILTER (year >= 2000) AS test_rows FROM obs""")
def temporal_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _sides(spark, sf_dir)
    sides = train.select(F.lit(1).alias("a")).unionAll(test.select(F.lit(0).alias("a")))
    return sides.agg(F.count_if(F.col("a") == 1).alias("train_rows"), F.count_if(F.col("a") == 0).alias("test_rows"))


@query(f"""WITH {OBS_SQL} SELECT id, round((target - avg(target) OVER ()) / stddev_samp(target) OVER (), 6) AS z_target,
 round((acctbal - avg(acctbal) OVER ()) / stddev_samp(acctbal) OVER (), 6) AS z_acctbal FROM obs""")
def standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(segments.standardize(obs(spark, sf_dir).select("id", "target", "acctbal"), ["target", "acctbal"]).select(
        "id", "z_target", "z_acctbal"), 6)


@query(f"""WITH {OBS_SQL} SELECT id, round((target - avg(target) OVER ()) / stddev_samp(target) OVER (), 6) AS z_target,
 round((acctbal - avg(acctbal) OVER ()) / stddev_samp(acctbal) OVER (), 6) AS z_acctbal FROM obs""")
def standard_scaler(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = obs(spark, sf_dir).select("id", "target", "acctbal")
    z = vector_to_array(F.col("features"))
    scaled = segments.fit_standardizer(panel, ["target", "acctbal"]).transform(panel)
    return rounded(scaled.select("id", z[0].alias("z_target"), z[1].alias("z_acctbal")), 6)


@query(f"""WITH {OBS_SQL}, i AS (SELECT id, segment, CAST(dense_rank() OVER (ORDER BY segment) - 1 AS INTEGER) AS idx FROM obs)
SELECT id, segment, idx, {', '.join(f"CAST(segment = '{s}' AS INTEGER) AS segment_{s}" for s in ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD'))},
 CAST(segment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD') AS INTEGER) AS segment___unknown FROM i""")
def index_onehot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alphabetical index, and one-hot for four known levels with a slot for the rest."""
    panel = obs(spark, sf_dir).select("id", "segment")
    indexed = panel.join(models.index_codes(panel, "segment"), "segment").select("id", "segment", "idx")
    levels = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]
    features = models.feature_pipeline([], ["segment"], scale=False).fit(panel.where(F.col("segment").isin(levels)))
    slots = vector_to_array(F.col("features_raw"))
    named = [slots[i].cast("int").alias(f"segment_{level}") for i, level in enumerate([*levels, "__unknown"])]
    return features.transform(indexed).select("id", "segment", "idx", *named)


@query(f"""WITH {OBS_SQL} SELECT 'skip' AS invalid, count(*) AS rows FROM obs WHERE qty IS NOT NULL
UNION ALL SELECT 'keep', count(*) FROM obs""")
def assemble_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = obs(spark, sf_dir).select("target", "qty")
    parts = [
        segments.assemble(panel, ["target", "qty"], invalid=mode).agg(F.count("features").alias("rows")).select(
            F.lit(mode).alias("invalid"), "rows") for mode in ("skip", "keep")
    ]
    return parts[0].unionByName(parts[1])


def _assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = obs(spark, sf_dir).select("id", "target", "acctbal", F.col("person").cast("double").alias("person"), "segment", "status")
    z = segments.standardize(panel, ["target", "acctbal", "person"])
    return segments.nearest_center(z, FEATURES, CENTERS)


def _distance_sql(center: tuple[float, ...]) -> str:
    return " + ".join(f"({c} - ({x})) * ({c} - ({x}))" for c, x in zip(FEATURES, center))


ASSIGNED_SQL = f"""{OBS_SQL},
z AS (SELECT id, target, acctbal, CAST(person AS DOUBLE) AS person, segment, status,
 (target - avg(target) OVER ()) / stddev_samp(target) OVER () AS z_target,
 (acctbal - avg(acctbal) OVER ()) / stddev_samp(acctbal) OVER () AS z_acctbal,
 (person - avg(person) OVER ()) / stddev_samp(CAST(person AS DOUBLE)) OVER () AS z_person FROM obs),
d AS (SELECT *, {', '.join(f'{_distance_sql(c)} AS d{i}' for i, c in enumerate(CENTERS))} FROM z),
assigned AS (SELECT *, least(d0, d1, d2) AS cost,
 CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS cluster FROM d)"""


@query(f"WITH {ASSIGNED_SQL} SELECT id, cluster, round(cost, 6) AS cost FROM assigned")
def nearest_center(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_assigned(spark, sf_dir).select("id", "cluster", "cost"), 6)


@query(f"WITH {ASSIGNED_SQL} SELECT cluster, count(*) AS n, round(sum(cost), 4) AS wssse FROM assigned GROUP BY 1")
def wssse_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(segments.cluster_sizes(_assigned(spark, sf_dir)), 4)


@query(f"""WITH {ASSIGNED_SQL},
k AS (SELECT cluster AS k, count(*) AS n, sum(z_target) AS s1, sum(z_acctbal) AS s2, sum(z_person) AS s3,
 sum(z_target * z_target + z_acctbal * z_acctbal + z_person * z_person) AS q FROM assigned GROUP BY 1),
x AS (SELECT id, cluster, k, n, z_target * z_target + z_acctbal * z_acctbal + z_person * z_person + q / n
 - 2 * (z_target * s1 + z_acctbal * s2 + z_person * s3) / n AS md FROM assigned, k),
ab AS (SELECT id, max(md * n / (n - 1)) FILTER (k = cluster) AS a, min(md) FILTER (k <> cluster) AS b FROM x GROUP BY 1)
SELECT round(avg(CASE WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END), 6) AS silhouette FROM ab""")
def silhouette_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(segments.silhouette(_assigned(spark, sf_dir), FEATURES), 6)


@query(f"""WITH {ASSIGNED_SQL}, o AS (SELECT count(*) AS c FROM assigned)
SELECT cluster, 'target' AS variable, count(*) AS n, round(avg(target), 4) AS mean, round(stddev_samp(target), 4) AS sd,
 min(target) AS min, max(target) AS max, round(quantile_cont(target, 0.25), 4) AS p25, round(quantile_cont(target, 0.5), 4) AS p50,
 round(quantile_cont(target, 0.75), 4) AS p75, count(*) AS size, round(100.0 * count(*) / any_value(c), 4) AS size_pct FROM assigned, o GROUP BY 1
UNION ALL SELECT cluster, 'acctbal', count(*), round(avg(acctbal), 4), round(stddev_samp(acctbal), 4),
 min(acctbal), max(acctbal), round(quantile_cont(acctbal, 0.25), 4), round(quantile_cont(acctbal, 0.5), 4),
 round(quantile_cont(acctbal, 0.75), 4), count(*), round(100.0 * count(*) / any_value(c), 4) FROM assigned, o GROUP BY 1""")
def cluster_profile_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = segments.cluster_profile(_assigned(spark, sf_dir), ["target", "acctbal"])
    return rounded(table.drop("p95", "skewness", "kurtosis"), 4)


@query(f"""WITH {ASSIGNED_SQL} SELECT cluster, segment, count(*) AS n,
 round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY cluster), 6) AS pct, round(avg(target), 4) AS mean,
 round(quantile_cont(target, 0.5), 4) AS median FROM assigned GROUP BY 1, 2""")
def cluster_composition_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = segments.cluster_composition(_assigned(spark, sf_dir), "segment", "target")
    return rounded(rounded(table, 6, ["pct"]), 4, ["mean", "median"])


def _cluster_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders; an order without lines has quantity and lines 0, as in the models."""
    lines = [F.coalesce(c, F.lit(0.0)).alias(c) for c in ("qty", "lines")]
    return obs(spark, sf_dir).select(
        "id", "target", *lines, "acctbal", F.col("priority").cast("double").alias("level"), "segment", "status"
    )


CLUSTER_COLUMNS = ["qty", "lines", "acctbal", "level"]


@query()
def kmeans_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.kmeans_grid(_cluster_input(spark, sf_dir), "id", CLUSTER_COLUMNS).results


@query()
def kmeans_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.choose_k(segments.kmeans_grid(_cluster_input(spark, sf_dir), "id", CLUSTER_COLUMNS).results)


@query()
def cluster_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size, statistics, centre, composition and description of every cluster, by the median of the target."""
    panel = _cluster_input(spark, sf_dir)
    grid = segments.kmeans_grid(panel, "id", CLUSTER_COLUMNS)
    assigned = sinks.write_stage(segments.assign(panel, grid.standardizer, grid.models[grid.chosen]), scratch_dir(spark, "clusters"))
    centers = segments.centroids(spark, grid.standardizer, grid.models[grid.chosen], CLUSTER_COLUMNS)
    return segments.cluster_report(assigned, CLUSTER_COLUMNS, {"segment": {}, "status": {}}, "target", centers)


@query()
def centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = segments.kmeans_grid(_cluster_input(spark, sf_dir), "id", CLUSTER_COLUMNS)
    return segments.centroids(spark, grid.standardizer, grid.models[grid.chosen], CLUSTER_COLUMNS)


def _model_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both sides of the split, from rows stored once: layout, baselines and scores read them again."""
    panel = obs(spark, sf_dir).select("id", "year", "target", *CATEGORIES, "acctbal",
                                      *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("qty", "lines")])
    panel = sinks.write_stage(panel, scratch_dir(spark, "panel"))
    return models.split_by_period(panel, "year", TRAIN_YEARS, TEST_YEARS)


def _configs(algorithm: str) -> list[models.Config]:
    return [c for c in models.default_configs() if c.algorithm == algorithm]


def _grid(spark: SparkSession, sf_dir: str, configs: list[models.Config]) -> models.Grid:
    train, valid = _model_sides(spark, sf_dir)
    return models.fit_grid(train, valid, "id", "target", NUMERIC, CATEGORIES, configs)


@query()
def lr_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grid(spark, sf_dir, _configs("linear")).results


@query()
def rf_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grid(spark, sf_dir, _configs("forest")).results


@query()
def model_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = _grid(spark, sf_dir, _configs("linear")[:1] + _configs("forest")[:1])
    return models.model_details(grid.features, grid.models, NUMERIC)


@query("""SELECT count(*) AS compared_keys, CAST(0 AS BIGINT) AS changed_keys, CAST(0 AS BIGINT) AS beyond_tolerance,
 CAST(0 AS DOUBLE) AS max_abs_diff FROM orders WHERE year(o_orderdate) >= 2000""")
def model_reload_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored and reloaded model predicts what the fitted one predicts."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.regression import LinearRegressionModel

    grid = _grid(spark, sf_dir, _configs("linear")[:1])
    _, valid = _model_sides(spark, sf_dir)
    path = scratch_dir(spark, "models")
    name, model = next(iter(grid.models.items()))
    features = PipelineModel.load(sinks.save_model(grid.features, f"{path}/features"))
    again = LinearRegressionModel.load(sinks.save_model(model, f"{path}/linear"))
    column = models.prediction_column(name)
    first = models.score(valid, grid.features, {name: model}).select("id", column)
    second = models.score(valid, features, {name: again}).select("id", column)
    return compare.numeric_difference(first, second, "id", column)


@query()
def frozen_refit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The configurations selected on the last of the earlier years, refitted on all of them, scored once on the rest."""
    train, test = _model_sides(spark, sf_dir)
    earlier, last = models.split_by_period(train, "year", TRAIN_YEARS[:-1], TRAIN_YEARS[-1:])
    frozen = models.fit_grid(earlier, last, "id", "target", NUMERIC, CATEGORIES).frozen()
    features, fitted = models.refit(train, "id", "target", NUMERIC, CATEGORIES, frozen)
    scored = evaluate.predict_mean(train, models.score(test, features, fitted), "target")
    names = {"baseline": "pred_baseline", **{n: models.prediction_column(n) for n in fitted}}
    return evaluate.metrics(scored, "target", names)


@query(f"""WITH {OBS_SQL} SELECT suite, CAST(count(*) AS BIGINT) AS passed, CAST(0 AS BIGINT) AS failures, CAST(0 AS BIGINT) AS warnings, true AS ok
FROM (SELECT 'eda' AS suite, unnest(range(0, 16 + 3 + (SELECT count(DISTINCT period) FROM obs)))
 UNION ALL SELECT 'final', unnest(range(0, 4 + 5))) GROUP BY 1""")
def check_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sanity of the descriptive tables and of the split and the predictions."""
    from panelwave.operators import association

    panel = obs(spark, sf_dir).dropna(subset=["target"])
    measures = ["target", "person", "nation", "acctbal"]
    summary = profile.numeric_summary(panel, measures)
    rows = panel.agg(F.count(F.lit(1))).scalar()
    train, test = _sides(spark, sf_dir)
    scored = evaluate.with_residuals(_scored(spark, sf_dir), "target", MODELS)
    checks = (
        ck.summary_checks("eda", summary, rows)
        .unionByName(ck.correlation_checks("eda", association.pearson(panel, measures)))
        .unionByName(ck.share_checks("eda", profile.composition_by_period(panel, "period", "segment", "target"), ["period"]))
        .unionByName(ck.partition_checks("final", train, test, "id", ["target", "segment", "qty"]))
        .unionByName(ck.prediction_checks("final", scored.withColumn("side", F.lit("test")), "target", MODELS, "side", "test"))
    )
    return ck.summary(checks)


@query(f"""WITH {SCORED_SQL}, {METRICS_SQL} SELECT model, metric, round(v, 4) AS stored, round(v, 4) AS recomputed, true AS passed FROM
 (SELECT model, 'mae' AS metric, mae AS v FROM metrics UNION ALL SELECT model, 'rmse', rmse FROM metrics UNION ALL SELECT model, 'mean_error', mean_error FROM metrics)""")
def metrics_recomputed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of stored predictions against those computed before storing them."""
    scored = _scored(spark, sf_dir)
    path = scratch_dir(spark, "predictions")
    scored.write.mode("overwrite").parquet(path)
    first = evaluate.metrics(scored, "target", MODELS)
    again = evaluate.metrics(spark.read.parquet(path), "target", MODELS)
    return rounded(compare.stored_against_recomputed(first, again, ["model"], ["mae", "rmse", "mean_error"]), 4)


@query()
def selection_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ck.selection_checks("selection", _grid(spark, sf_dir, _configs("linear")).results)


@query()
def clustering_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = _cluster_input(spark, sf_dir)
    grid = segments.kmeans_grid(panel, "id", CLUSTER_COLUMNS)
    return ck.cluster_checks("clusters", grid.results, segments.KS, panel.count())

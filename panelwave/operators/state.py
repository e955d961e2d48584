"""Statistics as states that add up: one small row per period, group and variable, merged without the data.

A state holds counts, means and sums of powers (or products) of deviations from
the mean of its own rows. Merging moves every sum to the common mean, which
loses no digits the way raw power sums do. A new period costs a scan of that
period alone; everything before it comes from stored states.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwave.functions.numeric import finite_or_null, percent, ratio
from panelwave.operators.evaluate import residual
from panelwave.operators.quantiles import quantile_name
from panelwave.operators.shape import null_safe_join, rows_from, struct
from panelwave.sources.sinks import read_stage

#: Size of a quantile sketch.
SKETCH_K = 400


def moment_state(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(by, variable, n, mean, m2, m3, m4, min, max)`` of the finite values, in one aggregate."""
    wide = df.groupBy(*by).agg(
        *[
            fn(finite_or_null(F.col(c))).alias(f"_{name}_{c}")
            for c in columns
            for name, fn in (
                ("n", F.count), ("mean", F.avg), ("var", F.var_pop), ("skew", F.skewness), ("kurt", F.kurtosis),
                ("min", F.min), ("max", F.max),
            )
        ]
    )

    def state(c: str) -> Column:
        n, var = F.col(f"_n_{c}"), F.col(f"_var_{c}")
        skew, kurt = (F.coalesce(finite_or_null(F.col(f"_{k}_{c}")), F.lit(0.0)) for k in ("skew", "kurt"))
        fourth = F.when(var > 0, (kurt + 3.0) * n * var * var).otherwise(F.lit(0.0))
        ends = {k: F.col(f"_{k}_{c}").cast("double") for k in ("mean", "min", "max")}
        return struct(variable=c, n=n, m2=var * n, m3=skew * n * F.pow(var, F.lit(1.5)), m4=fourth, **ends)

    return rows_from(wide, by, [state(c) for c in columns])


def merge_moments(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Moment states of the same variables, over periods or finer groups, as one per group of ``by``."""
    keys = [*by, "variable"]
    held = states.where("n > 0")
    mean, away = _common(keys, "mean")
    d, d2 = F.col("_d"), F.col("_d") * F.col("_d")
    n, m2, m3 = F.col("n"), F.col("m2"), F.col("m3")
    merged = (
        held.withColumn("_mean", mean)
        .withColumn("_d", away)
        .groupBy(*keys)
        .agg(
            F.sum("n").alias("n"), F.first("_mean").alias("mean"), F.sum(m2 + n * d2).alias("m2"),
            F.sum(m3 + 3 * d * m2 + n * d2 * d).alias("m3"),
            F.sum(F.col("m4") + 4 * d * m3 + 6 * d2 * m2 + n * d2 * d2).alias("m4"),
            F.min("min").alias("min"), F.max("max").alias("max"),
        )
    )
    # A variable without any finite value keeps a row.
    return null_safe_join(states.select(*keys).distinct(), merged, keys, "left").na.fill(0, ["n"])


def _common(keys: Sequence[str], name: str) -> tuple[Column, Column]:
    """The mean over all states of a key, and how far a state's own mean lies from it."""
    whole = Window.partitionBy(*keys)
    mean = F.sum(F.col(name) * F.col("n")).over(whole) / F.sum("n").over(whole)
    return mean, F.col(name) - F.col(f"_{name}")


def moments_of(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """What ``profile.moments`` gives over the rows: mean, sample sd, ends, population skewness, excess kurtosis."""
    n, m2 = F.col("n").cast("double"), F.col("m2")
    spread = F.when(m2 > 0, m2)
    return states.select(
        *by, "variable", "n", "mean", F.sqrt(m2 / F.when(n > 1, n - 1)).alias("sd"), "min", "max",
        (F.sqrt(n) * F.col("m3") / F.pow(spread, F.lit(1.5))).alias("skewness"),
        (n * F.col("m4") / (spread * spread) - 3.0).alias("kurtosis"),
    )


def product_state(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(by, var_x, var_y, n, mean_x, mean_y, product)`` of all pairs x <= y in the order of ``columns``, over rows without
    a NULL or infinite value in any of them; ``product`` is the sum of products of deviations, for x = y the squares.
    """
    complete = df.select(*by, *[finite_or_null(F.col(c).cast("double")).alias(c) for c in columns]).dropna(subset=list(columns))
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    wide = complete.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.avg(c).alias(f"_{c}") for c in columns],
        *[F.covar_pop(a, b).alias(f"_{a}_{b}") for a, b in pairs],
    )
    n = F.col("_n")
    return rows_from(
        wide, by, [struct(var_x=a, var_y=b, n=n, mean_x=F.col(f"_{a}"), mean_y=F.col(f"_{b}"), product=F.col(f"_{a}_{b}") * n) for a, b in pairs]
    )


def merge_products(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Product states of the same columns as one per group of ``by``."""
    keys = [*by, "var_x", "var_y"]
    (mean_x, away_x), (mean_y, away_y) = _common(keys, "mean_x"), _common(keys, "mean_y")
    held = states.where("n > 0").withColumn("_mean_x", mean_x).withColumn("_mean_y", mean_y)
    return (
        held.withColumn("_p", F.col("product") + F.col("n") * away_x * away_y)
        .groupBy(*keys)
        .agg(F.sum("n").alias("n"), F.first("_mean_x").alias("mean_x"), F.first("_mean_y").alias("mean_y"), F.sum("_p").alias("product"))
    )


def pearson_of(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by, var_x, var_y, n, r)`` for all ordered pairs, as ``association.pearson``; NULL with a constant column."""
    own = states.where("var_x = var_y").select(*by, F.col("var_x").alias("variable"), F.col("product").alias("spread"))
    x, y = (own.withColumnsRenamed({"variable": v, "spread": f"_{v}"}) for v in ("var_x", "var_y"))
    spread = F.when((F.col("_var_x") > 0) & (F.col("_var_y") > 0), F.sqrt("_var_x") * F.sqrt("_var_y"))
    half = null_safe_join(null_safe_join(states, x, [*by, "var_x"]), y, [*by, "var_y"])
    half = half.select(*by, "var_x", "var_y", "n", (F.col("product") / spread).alias("r"))
    mirror = half.where("var_x <> var_y").select(*by, F.col("var_y").alias("var_x"), F.col("var_x").alias("var_y"), "n", "r")
    return half.unionByName(mirror)


def error_state(df: DataFrame, target: str, models: Mapping[str, str], by: Sequence[str] = ()) -> DataFrame:
    """``(by, variable, n, abs_sum, square_sum, error_sum, under, mean, m2)``: errors of each model (``variable``), and
    the target's mean and squared deviations over the rows that the model predicts.
    """
    sums = []
    for m, p in models.items():
        e = residual(target, p)
        actual = F.when(e.isNotNull(), F.col(target))
        parts = {
            "n": F.count(e), "abs_sum": F.sum(F.abs(e)), "square_sum": F.sum(e * e), "error_sum": F.sum(e),
            "under": F.count_if(e > 0), "mean": F.avg(actual), "m2": F.var_pop(actual) * F.count(e),
        }
        sums += [c.alias(f"_{name}_{m}") for name, c in parts.items()]
    names = ("n", "abs_sum", "square_sum", "error_sum", "under", "mean", "m2")
    return rows_from(df.groupBy(*by).agg(*sums), by, [struct(variable=m, **{k: F.col(f"_{k}_{m}") for k in names}) for m in models])


def merge_errors(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Error states of the same models as one per group of ``by``."""
    keys = [*by, "variable"]
    mean, away = _common(keys, "mean")
    held = states.where("n > 0").withColumn("_mean", mean)
    sums = [F.sum(c).alias(c) for c in ("n", "abs_sum", "square_sum", "error_sum", "under")]
    return held.withColumn("_m2", F.col("m2") + F.col("n") * away * away).groupBy(*keys).agg(
        *sums, F.first("_mean").alias("mean"), F.sum("_m2").alias("m2")
    )


def metrics_of(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """What ``evaluate.metrics`` gives over the rows."""
    n = F.col("n")
    return states.select(
        *by, F.col("variable").alias("model"), "n", ratio(F.col("abs_sum"), n).alias("mae"),
        F.sqrt(ratio(F.col("square_sum"), n)).alias("rmse"), (F.lit(1.0) - ratio(F.col("square_sum"), F.col("m2"))).alias("r2"),
        ratio(F.col("error_sum"), n).alias("mean_error"), percent(F.col("under"), n).alias("pct_under"),
    )


def metric_change(states: DataFrame, period: str, validation: Sequence[str], test: Sequence[str]) -> DataFrame:
    """Metrics over the test periods and the change of MAE and RMSE against the validation periods, from states alone."""
    later, earlier = (metrics_of(merge_errors(states.where(F.col(period).isin(*p)))) for p in (test, validation))
    before = earlier.select("model", F.col("mae").alias("_mae"), F.col("rmse").alias("_rmse"))
    changes = [(F.col(m) - F.col(f"_{m}")).alias(f"{m}_change") for m in ("mae", "rmse")]
    return later.join(before, "model", "left").select(*later.columns, *changes)


def ridge(states: DataFrame, features: Sequence[str], target: str, penalties: Sequence[float]) -> DataFrame:
    """``(penalty, feature, coefficient)`` of the linear models that minimise half the mean squared error plus ``penalty``
    times half the sum of squared coefficients; feature ``(intercept)`` is not penalised.

    The rows enter through one merged product state of the features and the
    target, as many numbers as pairs of columns; the equations of that size are
    solved on the driver. A singular system without a penalty has the solution
    of least norm.
    """
    n, mean, product = _square(states, [*features, target])
    k = len(features)
    x, xy = product[:k, :k] / n, product[:k, k] / n
    rows = []
    for penalty in penalties:
        beta = np.linalg.lstsq(x + penalty * np.eye(k), xy, rcond=None)[0]
        rows.append((float(penalty), "(intercept)", float(mean[k] - beta @ mean[:k])))
        rows += [(float(penalty), f, float(b)) for f, b in zip(features, beta, strict=True)]
    return states.sparkSession.createDataFrame(rows, "penalty double, feature string, coefficient double")


def linear_errors(states: DataFrame, features: Sequence[str], target: str, solutions: DataFrame) -> DataFrame:
    """``(penalty, n, mean_error, rmse, r2)`` of the solutions on the rows of a merged product state, without those rows."""
    n, mean, product = _square(states, [*features, target])
    k = len(features)
    found: dict[float, dict[str, float]] = {}
    for row in solutions.collect():
        found.setdefault(row.penalty, {})[row.feature] = row.coefficient
    rows = []
    for penalty, of in sorted(found.items()):
        w = np.array([-of[f] for f in features] + [1.0])
        error = float(w @ mean) - of["(intercept)"]
        squares = float(w @ product @ w) + n * error * error
        rows.append((penalty, int(n), error, float(np.sqrt(squares / n)), float(1 - squares / product[k, k]) if product[k, k] else None))
    return states.sparkSession.createDataFrame(rows, "penalty double, n long, mean_error double, rmse double, r2 double")


def _square(states: DataFrame, columns: Sequence[str]) -> tuple[float, np.ndarray, np.ndarray]:
    """Rows, means and the full matrix of products, of one product state per pair."""
    at = {c: i for i, c in enumerate(columns)}
    mean, product = np.zeros(len(columns)), np.zeros((len(columns), len(columns)))
    n = 0.0
    for row in states.where(F.col("var_x").isin(*columns) & F.col("var_y").isin(*columns)).collect():
        i, j = at[row.var_x], at[row.var_y]
        product[i, j] = product[j, i] = row["product"]
        mean[i], mean[j], n = row.mean_x, row.mean_y, float(row.n)
    if not n:
        raise ValueError("no complete rows")
    return n, mean, product


def quantile_sketch(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """``(by, variable, n, sketch)``: a sketch of bounded size per group and variable, to be stored as a column."""
    values = {c: finite_or_null(F.col(c).cast("double")) for c in columns}
    wide = df.groupBy(*by).agg(
        *[F.count(v).alias(f"_n_{c}") for c, v in values.items()], *[F.kll_sketch_agg_double(v, k).alias(f"_s_{c}") for c, v in values.items()]
    )
    return rows_from(wide, by, [struct(variable=c, n=F.col(f"_n_{c}"), sketch=F.col(f"_s_{c}")) for c in columns]).where("n > 0")


def merge_sketches(states: DataFrame, by: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    return states.groupBy(*by, "variable").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", k).alias("sketch"))


def rank_error(k: int = SKETCH_K) -> float:
    """How far, as a share of n, the rank of an answer may lie from the level asked for: five standard deviations of a
    sketch of size ``k``, twice the figure that its publication gives at 99 percent.
    """
    return 2 * 2.296 / k**0.9021


def sketch_quantiles(states: DataFrame, levels: Sequence[float], by: Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """``(by, variable, n, p25, ..., rank_error)`` of merged sketches; the answers are values of the data."""
    picked = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))).alias(quantile_name(q)) for q in levels]
    return states.select(*by, "variable", "n", *picked, F.lit(rank_error(k)).alias("rank_error"))


def add_period(
    panel: DataFrame, path: str, period: str, added: Sequence[str], state: Callable[[DataFrame, Sequence[str]], DataFrame], by: Sequence[str] = ()
) -> DataFrame:
    """Computes the states of the added periods from their rows alone, replaces them in the store and returns all states.

    ``state`` takes rows and grouping columns. The filter on the period reaches a
    panel that is partitioned by it, so no other period is read.
    """
    rows = panel.where(F.col(period).isin(*added))
    new = state(rows, [period, *by])
    new.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(period).parquet(path)
    return read_stage(panel.sparkSession, path).withColumn(period, F.col(period).cast("string"))

"""Model metrics and error diagnosis over scored rows.

``models`` maps a model name to its prediction column; the residual is actual
minus predicted, so a positive one means an under-estimate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwave.functions.codes import band, band_names, code_order
from panelwave.functions.text import stated
from panelwave.functions.numeric import correlation, percent, ratio
from panelwave.operators.quantiles import exact_thresholds
from panelwave.operators.shape import one_row, rows_from, struct
from panelwave.spec import UNKNOWN

# Thresholds of the target bands.
BAND_LEVELS = {"P25": 0.25, "P50": 0.5, "P75": 0.75, "P90": 0.9, "P95": 0.95}


def mean_of(df: DataFrame, column: str) -> Column:
    return one_row(df, m=F.avg(column))["m"]


def predict_mean(train: DataFrame, test: DataFrame, target: str, name: str = "pred_baseline") -> DataFrame:
    """The mean of the training target as the prediction of every test row."""
    return test.withColumn(name, mean_of(train, target))


def predict_line(
    train: DataFrame, test: DataFrame, target: str, feature: str, name: str = "pred_line"
) -> DataFrame:
    """Least squares line of one feature, fitted on train and applied to test."""
    fit = one_row(train, a=F.regr_intercept(target, feature), b=F.regr_slope(target, feature))
    return test.withColumn(name, fit["a"] + fit["b"] * F.col(feature))


def residual(target: str, prediction: str) -> Column:
    return F.col(target) - F.col(prediction)


def with_residuals(df: DataFrame, target: str, models: Mapping[str, str]) -> DataFrame:
    return df.select("*", *[residual(target, p).alias(f"residual_{m}") for m, p in models.items()])


def metrics(df: DataFrame, target: str, models: Mapping[str, str], by: Sequence[str] = ()) -> DataFrame:
    """n, MAE, RMSE, R2, mean error and percent under-estimated per model, in one pass."""
    sums: list[Column] = []
    for i, p in enumerate(models.values()):
        e = residual(target, p)
        sums += [
            F.count(e).alias(f"_n_{i}"),
            F.avg(F.abs(e)).alias(f"_a_{i}"),
            F.avg(e * e).alias(f"_s_{i}"),
            F.avg(e).alias(f"_e_{i}"),
            F.count_if(e > 0).alias(f"_u_{i}"),
            F.var_pop(F.when(e.isNotNull(), F.col(target))).alias(f"_v_{i}"),
        ]
    wide = df.groupBy(*by).agg(*sums)
    structs = [
        struct(
            model=m,
            n=F.col(f"_n_{i}"),
            mae=F.col(f"_a_{i}"),
            rmse=F.sqrt(F.col(f"_s_{i}")),
            r2=F.lit(1.0) - ratio(F.col(f"_s_{i}"), F.col(f"_v_{i}")),
            mean_error=F.col(f"_e_{i}"),
            pct_under=percent(F.col(f"_u_{i}"), F.col(f"_n_{i}")),
        )
        for i, m in enumerate(models)
    ]
    return rows_from(wide, by, structs)


def thresholds(df: DataFrame, target: str, levels: Mapping[str, float] = BAND_LEVELS) -> DataFrame:
    """One row per threshold name."""
    cut = exact_thresholds(df, target, list(levels.values()))
    known = df.sparkSession.range(1).select(cut.alias("_cut"))
    rows = [struct(band=n, level=q, threshold=F.col("_cut")[i]) for i, (n, q) in enumerate(levels.items())]
    return rows_from(known, [], rows)


def with_band(
    df: DataFrame, target: str, levels: Mapping[str, float] = BAND_LEVELS, name: str = "band"
) -> DataFrame:
    """Band of the actual target by exact quantiles of the same rows."""
    cut = exact_thresholds(df, target, list(levels.values()))
    return df.withColumn("_cut", cut).withColumn(name, band(F.col(target), F.col("_cut"), list(levels))).drop("_cut")


def error_table(df: DataFrame, target: str, models: Mapping[str, str], groups: Sequence[str]) -> DataFrame:
    """Errors by each grouping column and overall: ``(grouping, label, model, ...)``.

    All measures are sums, so the rows are first reduced to one per combination
    of the grouping columns; only that small table is expanded to the groupings.
    A model's measures cover the rows that have both its prediction and the
    target, the mean of the target the rows that have one. A NULL group counts
    as the unknown one.
    """
    df = df.withColumns({g: F.coalesce(F.col(g).cast("string"), F.lit(UNKNOWN)) for g in groups})
    sums: dict[str, Column] = {"n": F.count(F.lit(1)), "known": F.count(target), "y": F.sum(target)}
    for i, p in enumerate(models.values()):
        e = residual(target, p)
        sums |= {
            f"abs_{i}": F.sum(F.abs(e)),
            f"err_{i}": F.sum(e),
            f"sq_{i}": F.sum(e * e),
            f"pred_{i}": F.sum(F.when(e.isNotNull(), F.col(p))),
            f"m_{i}": F.count(e),
            f"under_{i}": F.count_if(e > 0),
        }
    base = df.groupBy(*groups).agg(*[c.alias(n) for n, c in sums.items()])
    columns = [F.col(g) for g in groups]
    sets = [[c] for c in columns] + [[]]
    rolled = base.groupingSets(sets, *columns).agg(
        F.grouping_id(*groups).alias("_id"), *[F.sum(n).alias(n) for n in sums]
    )
    full = 2 ** len(groups) - 1
    which = F.when(F.col("_id") == full, F.lit("overall"))
    label = F.when(F.col("_id") == full, F.lit("all"))
    for at, g in enumerate(groups):
        own = F.col("_id") == full - 2 ** (len(groups) - 1 - at)
        which = which.when(own, F.lit(g))
        label = label.when(own, F.coalesce(F.col(g).cast("string"), F.lit(UNKNOWN)))
    n = F.col("n")
    structs = [
        struct(
            model=m,
            mae=ratio(F.col(f"abs_{i}"), F.col(f"m_{i}")),
            mean_error=ratio(F.col(f"err_{i}"), F.col(f"m_{i}")),
            rmse=F.sqrt(ratio(F.col(f"sq_{i}"), F.col(f"m_{i}"))),
            mean_prediction=ratio(F.col(f"pred_{i}"), F.col(f"m_{i}")),
            pct_under=percent(F.col(f"under_{i}"), F.col(f"m_{i}")),
        )
        for i, m in enumerate(models)
    ]
    named = rolled.select(
        which.alias("grouping"), label.alias("label"), n, ratio(F.col("y"), F.col("known")).alias("mean_actual"), "*"
    )
    return rows_from(
        named.select("grouping", "label", named["n"].alias("rows"), "mean_actual", *list(sums)),
        ["grouping", "label", "rows", "mean_actual"],
        structs,
    )


def order_error_table(table: DataFrame) -> DataFrame:
    return table.orderBy("grouping", code_order(F.col("label")), "label", "model")


def high_band(
    df: DataFrame, target: str, models: Mapping[str, str], band_column: str = "band",
    levels: Mapping[str, float] = BAND_LEVELS,
) -> DataFrame:
    """Per model: errors in the top band against the rest, and systematic under-estimation.

    Systematic means a positive mean error and more than half of the residuals
    positive within the top band.
    """
    top = F.col(band_column) == band_names(list(levels))[-1]
    rest = F.col(band_column) != band_names(list(levels))[-1]
    sums: list[Column] = [F.count_if(top).alias("_n"), F.avg(F.when(top, F.col(target))).alias("_y")]
    for i, p in enumerate(models.values()):
        e = residual(target, p)
        sums += [
            F.avg(F.when(top, e)).alias(f"_e_{i}"),
            F.avg(F.when(top, F.abs(e))).alias(f"_a_{i}"),
            F.avg(F.when(top, F.col(p))).alias(f"_p_{i}"),
            F.count_if(top & (e > 0)).alias(f"_u_{i}"),
            F.avg(F.when(rest, e)).alias(f"_r_{i}"),
            correlation(F.col(target), e).alias(f"_c_{i}"),
        ]
    structs = []
    for i, m in enumerate(models):
        under = percent(F.col(f"_u_{i}"), F.col("_n"))
        structs.append(
            struct(
                model=m,
                n_high=F.col("_n"),
                mean_error_high=F.col(f"_e_{i}"),
                pct_under_high=under,
                mae_high=F.col(f"_a_{i}"),
                predicted_over_actual=ratio(F.col(f"_p_{i}"), F.col("_y")),
                mean_error_rest=F.col(f"_r_{i}"),
                corr_target_residual=F.col(f"_c_{i}"),
                systematic_under=(F.col(f"_e_{i}") > 0) & (under > 50.0),
            )
        )
    return rows_from(df.agg(*sums), [], structs)


def worst_group(table: DataFrame) -> DataFrame:
    """Group with the largest MAE per grouping and model; the smaller label wins a tie."""
    best = F.min_by(F.struct("label", "mae"), F.struct((-F.col("mae")).alias("a"), F.col("label").alias("b")))
    return (
        table.where(F.col("grouping") != "overall")
        .groupBy("grouping", "model")
        .agg(best.alias("_b"))
        .select("grouping", "model", F.col("_b")["label"].alias("label"), F.col("_b")["mae"].alias("mae"))
    )


def improvement(test: DataFrame, baseline: str, validation: DataFrame | None = None) -> DataFrame:
    """RMSE gain over the baseline in percent and, if given, change against validation."""
    base = one_row(test.where(F.col("model") == baseline), v=F.max("rmse"))["v"]
    out = test.withColumn("rmse_gain_pct", percent(base - F.col("rmse"), base))
    if validation is None:
        return out
    earlier = validation.select("model", F.col("rmse").alias("_v"))
    return out.join(earlier, "model", "left").withColumn("rmse_change", F.col("rmse") - F.col("_v")).drop("_v")


def conclusions(final: DataFrame, bands: DataFrame, worst: DataFrame) -> DataFrame:
    """``(model, subject, statement)``: a row for the whole test, the top band and the worst group of each grouping."""
    overall = stated(
        ("MAE", F.col("mae"), 2), ("RMSE", F.col("rmse"), 2), ("R2", F.col("r2"), 4), ("mean error", F.col("mean_error"), 2),
        ("% less RMSE than the baseline", F.col("rmse_gain_pct"), 1),
    )
    top = stated(
        ("rows", F.col("n_high"), 0), ("mean error", F.col("mean_error_high"), 2), ("% estimated too low", F.col("pct_under_high"), 1)
    )
    side = F.when(F.col("systematic_under"), "systematically too low: ").otherwise("no systematic side: ")
    group = F.concat(F.col("label"), F.lit(": "), stated(("MAE", F.col("mae"), 2)))
    return (
        final.select("model", F.lit("all").alias("subject"), overall.alias("statement"))
        .union(bands.select("model", F.lit("top band"), F.concat(side, top)))
        .union(worst.select("model", F.concat(F.lit("worst "), "grouping"), group))
    )

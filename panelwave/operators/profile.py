"""Descriptive statistics in long form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwave.functions.codes import code_order
from panelwave.functions.numeric import finite_or_null, percent, positive_log, ratio, relative_change
from panelwave.operators.quantiles import approx_quantiles, exact_quantiles, exact_thresholds
from panelwave.operators.shape import null_safe_join, one_row, rows_from, struct

# The reported quantiles and histogram sizes.
LEVELS = (0.25, 0.5, 0.75, 0.95)
TAIL_LEVEL = 0.95
LINEAR_BINS = 40
LOG_BINS = 50


def moments(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """n, mean, sample sd, min, max, population skewness, excess kurtosis per variable.

    The variables stay side by side in one aggregate, rows are not multiplied.
    Only finite values count, as in the quantiles.
    """
    stats = {
        "n": F.count,
        "mean": F.avg,
        "sd": F.stddev_samp,
        "min": F.min,
        "max": F.max,
        "skewness": F.skewness,
        "kurtosis": F.kurtosis,
    }
    wide = df.groupBy(*by).agg(
        *[fn(finite_or_null(F.col(c))).alias(f"_{name}_{c}") for c in columns for name, fn in stats.items()]
    )

    def cell(name: str, c: str) -> Column:
        value = F.col(f"_{name}_{c}")
        return value if name == "n" else finite_or_null(value.cast("double"))

    return rows_from(
        wide, by, [struct(variable=c, **{name: cell(name, c) for name in stats}) for c in columns]
    )


def numeric_summary(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (),
    levels: Sequence[float] = LEVELS,
    exact: bool = True,
) -> DataFrame:
    """Moments joined with quantiles: one row per group and variable."""
    quantiles = (exact_quantiles if exact else approx_quantiles)(df, columns, levels, by)
    return null_safe_join(moments(df, columns, by), quantiles, [*by, "variable"], "left")


def category_table(df: DataFrame, category: str, target: str, by: Sequence[str] = ()) -> DataFrame:
    """Per category: n, percent of its group, mean and exact median of the target."""
    keys = [*by, category]
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg(target).alias("mean"))
    medians = exact_quantiles(df, [target], [0.5], keys).drop("variable").withColumnRenamed("p50", "median")
    if by:
        whole = F.sum("n").over(Window.partitionBy(*by))
    else:
        whole = one_row(df, n=F.count(F.lit(1)))["n"]
    shared = counted.withColumn("pct", percent(F.col("n"), whole))
    return null_safe_join(shared, medians, keys, "left").select(*keys, "n", "pct", "mean", "median")


def order_by_code(table: DataFrame, category: str, by: Sequence[str] = ()) -> DataFrame:
    return table.orderBy(*by, code_order(F.col(category)), category)


def order_by_size(table: DataFrame, category: str, by: Sequence[str] = ()) -> DataFrame:
    return table.orderBy(*by, F.col("n").desc(), code_order(F.col(category)), category)


def composition_by_period(df: DataFrame, period: str, category: str, target: str) -> DataFrame:
    return category_table(df, category, target, [period]).drop("mean")


def tail_concentration(df: DataFrame, target: str, level: float = TAIL_LEVEL) -> DataFrame:
    """How much of the target's mass lies at or above a high quantile."""
    value, cut = F.col(target), F.col("_cut")
    known = df.select(
        target,
        exact_thresholds(df, target, [0.5, level]).alias("_cut"),
        one_row(df, m=F.avg(target))["m"].alias("_centre"),
    )
    high = value >= cut[1]
    return known.agg(
        F.count(target).alias("n"),
        finite_or_null(F.skewness(target)).alias("skewness"),
        finite_or_null(F.kurtosis(target)).alias("kurtosis"),
        finite_or_null(F.skewness(positive_log(value))).alias("log_skewness"),
        F.avg(target).alias("_mean"),
        F.sum(target).alias("_mass"),
        F.sum(F.when(high, value)).alias("_high_mass"),
        F.count_if(high).alias("n_high"),
        F.count_if(value > F.col("_centre")).alias("_above"),
        F.first("_cut").alias("_cut"),
    ).select(
        "n",
        "skewness",
        "kurtosis",
        "log_skewness",
        ratio(F.col("_mean"), cut[0]).alias("mean_median_ratio"),
        cut[1].alias("threshold"),
        "n_high",
        percent(F.col("_high_mass"), F.col("_mass")).alias("high_mass_pct"),
        percent(F.col("_above"), F.col("n")).alias("above_mean_pct"),
    )


def histogram(df: DataFrame, column: str, bins: int = LINEAR_BINS, log: bool = False) -> DataFrame:
    """All rows in equal-width bins of the value, or of its log10; empty bins included."""
    raw = F.col(column).cast("double")
    scaled = F.when(raw > 0, F.log10(raw)) if log else raw
    values = df.select(finite_or_null(scaled).alias("_x")).where(F.col("_x").isNotNull())
    found = one_row(values, lo=F.min("_x"), hi=F.max("_x")).alias("_ends")
    ends = F.col("_ends")
    width = (ends["hi"] - ends["lo"]) / F.lit(float(bins))
    place = F.floor(F.try_divide(F.col("_x") - ends["lo"], width)) + 1
    counted = (
        values.select("_x", found)
        .select(F.least(F.coalesce(place, F.lit(1)), F.lit(bins)).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    grid = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"), found)
    edge = ends["lo"] + (F.col("bin") - 1) * width
    lower, upper = (F.pow(F.lit(10.0), e) if log else e for e in (edge, edge + width))
    return grid.join(counted, "bin", "left").select(
        "bin", lower.alias("lower"), upper.alias("upper"), F.coalesce("n", F.lit(0)).alias("n")
    )


def pivot_table(
    df: DataFrame, index: str, column: str, values: Sequence[str], cell: Column, fill: float | None = None
) -> DataFrame:
    """Pivot with its value list given, so no extra job finds the values."""
    wide = df.groupBy(index).pivot(column, list(values)).agg(cell)
    return wide if fill is None else wide.na.fill(fill, list(values))


def period_change(summary: DataFrame, period: str, columns: Sequence[str]) -> DataFrame:
    """Difference to the previous period; the input has one row per period."""
    order = Window.orderBy(period)
    return summary.select(
        period,
        *columns,
        *[(F.col(c) - F.lag(c).over(order)).alias(f"{c}_change") for c in columns],
    )


def step_reduction(table: DataFrame, order: str, column: str) -> DataFrame:
    """Reduction to the previous row in percent, and whether the column never rises."""
    previous = F.lag(column).over(Window.orderBy(order))
    return table.withColumn("reduction_pct", relative_change(previous, F.col(column))).withColumn(
        "not_rising", F.coalesce(F.col(column) <= previous, F.lit(True))
    )


def modal_category(df: DataFrame, category: str, by: Sequence[str] = ()) -> DataFrame:
    """Most frequent category with its percentage; the smallest code wins a tie."""
    counted = df.groupBy(*by, category).agg(F.count(F.lit(1)).alias("n"))
    best = F.min_by(
        F.struct(F.col(category).alias("c"), F.col("n").alias("n")),
        F.struct((-F.col("n")).alias("a"), code_order(F.col(category)).alias("b"), F.col(category).alias("c")),
    )
    return counted.groupBy(*by).agg(best.alias("_b"), F.sum("n").alias("_all")).select(
        *by,
        F.col("_b")["c"].alias(category),
        F.col("_b")["n"].alias("n"),
        percent(F.col("_b")["n"], F.col("_all")).alias("pct"),
    )


def group_deviation(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """Group means minus the size-weighted overall mean, in long form."""
    whole = one_row(df, **{c: F.avg(c) for c in columns})
    wide = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"_{c}") for c in columns]
    )
    return rows_from(
        wide,
        [group, "n"],
        [struct(variable=c, mean=F.col(f"_{c}"), deviation=F.col(f"_{c}") - whole[c]) for c in columns],
    )

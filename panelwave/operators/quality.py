"""Audits of raw and typed tables, each in one pass over its input."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwave.functions.codes import code_label
from panelwave.functions.numeric import percent, typed
from panelwave.operators.shape import predicates, rows_from, struct
from panelwave.spec import UNKNOWN

NULL_BUCKET = "NULO"


def type_columns(df: DataFrame, types: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Explicit typed projection of text columns; nothing is inferred.

    The typed columns leave through a one-element generator. A filter on them
    stays above it, so no predicate repeats the cleaning and casting of a cell.
    """
    cells = F.struct(*[typed(F.col(c), t).alias(c) for c, t in types.items()])
    return df.select(*keep, F.inline(F.array(cells)))


def missing_invalid(df: DataFrame, types: Mapping[str, str], by: Sequence[str] = ()) -> DataFrame:
    """NULL texts and non-NULL texts without a typed value, per column."""
    counters = [F.count(F.lit(1)).alias("_rows")]
    for c, t in types.items():
        empty = F.col(c).isNull()
        counters.append(F.count_if(empty).alias(f"_m_{c}"))
        counters.append(F.count_if(~empty & typed(F.col(c), t).isNull()).alias(f"_i_{c}"))
    structs = [
        struct(
            column=c,
            rows=F.col("_rows"),
            missing=F.col(f"_m_{c}"),
            invalid=F.col(f"_i_{c}"),
            missing_pct=percent(F.col(f"_m_{c}"), F.col("_rows")),
        )
        for c in types
    ]
    return rows_from(df.groupBy(*by).agg(*counters), by, structs)


def missing_table(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """NULLs per column of any type, with their percentage of the rows."""
    counters = [F.count_if(F.col(c).isNull()).alias(f"_m_{c}") for c in columns]
    wide = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"), *counters)
    structs = [
        struct(
            column=c,
            rows=F.col("_rows"),
            missing=F.col(f"_m_{c}"),
            missing_pct=percent(F.col(f"_m_{c}"), F.col("_rows")),
        )
        for c in columns
    ]
    return rows_from(wide, by, structs)


def value_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows per value of several columns at once, NULL as its own bucket."""
    cells = [
        struct(column=c, value=F.coalesce(F.col(c).cast("string"), F.lit(NULL_BUCKET))) for c in columns
    ]
    return rows_from(df, by, cells).groupBy(*by, "column", "value").agg(F.count(F.lit(1)).alias("n"))


def order_value_counts(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return counts.orderBy(*by, "column", F.col("value") == NULL_BUCKET, "value")


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def key_versions(df: DataFrame, keys: Sequence[str], over: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(by, keys, rows, versions)``: rows of each key and its distinct contents.

    Exact copies collapse in the first aggregate, so the second one sees one row
    per content and a key that holds most rows is never gathered in one task.
    """
    content = list(dict.fromkeys([*by, *keys, *over]))
    return (
        df.groupBy(*content)
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy(*by, *keys)
        .agg(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("versions"))
    )


def key_audit(df: DataFrame, keys: Sequence[str], over: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Key quality; a NULL key part counts as a value of its own.

    ``surplus_keys`` is rows minus distinct keys, ``repeated_keys`` the number of
    keys with more than one row.
    """
    return key_versions(df, keys, over, by).groupBy(*by).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(_any_null(keys), F.col("rows"))), F.lit(0)).alias("null_keys"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("surplus_keys"),
        F.count_if(F.col("rows") > 1).alias("repeated_keys"),
        F.coalesce(F.sum(F.col("rows") - F.col("versions")), F.lit(0)).alias("exact_duplicates"),
    )


def duplicate_versions(df: DataFrame, keys: Sequence[str], over: Sequence[str]) -> DataFrame:
    """Repeated keys split into exact repeats and conflicting contents."""
    repeated = F.col("rows") > 1
    return key_versions(df, keys, over).agg(
        F.count_if(repeated).alias("repeated_keys"),
        F.count_if(repeated & (F.col("versions") == 1)).alias("exact_repeats"),
        F.count_if(repeated & (F.col("versions") > 1)).alias("conflicting_keys"),
    )


def cross_period_keys(df: DataFrame, keys: Sequence[str], period: str) -> DataFrame:
    """Keys over all periods; the same key in several periods is legitimate."""
    per_key = (
        df.groupBy(*keys, period)
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy(*keys)
        .agg(F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_periods"))
    )
    return per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("_periods"), F.lit(0)).alias("distinct_period_keys"),
        F.coalesce(F.sum(F.col("_rows") - F.col("_periods")), F.lit(0)).alias("surplus_period_keys"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("_periods") > 1).alias("keys_in_many_periods"),
    )


def domain_audit(df: DataFrame, domains: Mapping[str, Sequence[int]], by: Sequence[str] = ()) -> DataFrame:
    """Per code column: NULLs, codes outside the domain, rows labelled unknown."""
    counters = []
    for c, codes in domains.items():
        counters += [
            F.count_if(F.col(c).isNull()).alias(f"_m_{c}"),
            F.count_if(~F.col(c).isin(*codes)).alias(f"_o_{c}"),
            F.count_if(code_label(F.col(c), codes) == UNKNOWN).alias(f"_u_{c}"),
        ]
    structs = [
        struct(
            column=c,
            missing=F.col(f"_m_{c}"),
            out_of_domain=F.col(f"_o_{c}"),
            unknown=F.col(f"_u_{c}"),
        )
        for c in domains
    ]
    return rows_from(df.groupBy(*by).agg(*counters), by, structs)


def violation_counts(df: DataFrame, named: Mapping[str, str], by: Sequence[str] = ()) -> DataFrame:
    """Rows that fulfil each named predicate, all predicates in one aggregate."""
    wide = df.groupBy(*by).agg(*[F.count_if(p).alias(f"_{n}") for n, p in predicates(named).items()])
    return rows_from(wide, by, [struct(violation=n, rows=F.col(f"_{n}")) for n in named])


def allowed_values(df: DataFrame, period: str, value: str, allowed: DataFrame) -> DataFrame:
    """Rows per period whose value the control table ``(period, value)`` does not allow.

    Only the distinct ``(period, value)`` pairs meet the control table.
    """
    control = allowed.select(F.col("period").alias("_p"), F.col("value").alias("_v")).distinct()
    pairs = df.groupBy(period, value).agg(F.count(F.lit(1)).alias("_n"))
    same = F.col(period).eqNullSafe(F.col("_p")) & F.col(value).eqNullSafe(F.col("_v"))
    return (
        pairs.join(control, same, "left")
        .groupBy(period)
        .agg(
            F.sum("_n").alias("rows"),
            F.coalesce(F.sum(F.when(F.col("_p").isNull(), F.col("_n"))), F.lit(0)).alias("outside"),
        )
    )


def control_totals(df: DataFrame, period: str, controls: DataFrame) -> DataFrame:
    """Row counts over the named period sets ``(name, period, expected)``."""
    counts = df.groupBy(period).agg(F.count(F.lit(1)).alias("_n")).withColumnRenamed(period, "period")
    return (
        controls.join(counts, "period", "left")
        .groupBy("name")
        .agg(
            F.max("expected").alias("expected"),
            F.coalesce(F.sum("_n"), F.lit(0)).alias("observed"),
        )
        .withColumn("passed", F.col("expected") == F.col("observed"))
    )


def constant_column(df: DataFrame, column: str, expected: Column) -> DataFrame:
    """Whether a column holds one value, and that it is the expected one."""
    low, high = F.min(column), F.max(column)
    return df.agg(
        low.alias("low"), high.alias("high"), F.coalesce((low == high) & (low == expected), F.lit(False)).alias("constant")
    )

"""Expectations as tables: ``(suite, check, severity, observed, expected, passed)``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwave.functions.numeric import close_to
from panelwave.operators.shape import rows_from, struct
from panelwave.sources.controls import small_table
from panelwave.sources.keyed import KeyedStage, difference, group_sizes

CHECK_SCHEMA = "suite string, check string, severity string, observed double, expected double, passed boolean"


@dataclass(frozen=True)
class Check:
    """An aggregate over the table and the value it must have.

    ``observed`` is a Spark SQL aggregate expression. ``how`` is one of
    ``=``, ``<=``, ``>=`` and ``~`` (equal within a relative tolerance).
    """

    name: str
    observed: str
    expected: float = 0.0
    how: str = "="
    severity: str = "error"


def _verdict(how: str, observed: Column, expected: Column) -> Column:
    test = {
        "=": observed == expected,
        "<=": observed <= expected,
        ">=": observed >= expected,
        "~": close_to(observed, expected),
    }[how]
    return F.coalesce(test, F.lit(False))


def run_checks(suite: str, df: DataFrame, checks: Sequence[Check], by: Sequence[str] = ()) -> DataFrame:
    """All checks of a table in one aggregate; with ``by``, once per group."""
    wide = df.groupBy(*by).agg(*[F.expr(c.observed).cast("double").alias(f"_{i}") for i, c in enumerate(checks)])
    prefix = F.concat_ws(" ", *[F.col(b).cast("string") for b in by])
    structs = []
    for i, c in enumerate(checks):
        observed, expected = F.col(f"_{i}"), F.lit(float(c.expected))
        structs.append(
            struct(
                suite=suite,
                check=F.concat_ws(": ", prefix, F.lit(c.name)) if by else F.lit(c.name),
                severity=c.severity,
                observed=observed,
                expected=expected,
                passed=_verdict(c.how, observed, expected),
            )
        )
    return rows_from(wide, [], structs)


def check_rows(suite: str, table: DataFrame, name: Column, passed: Column, severity: str = "error",
               observed: Column | None = None, expected: Column | None = None) -> DataFrame:
    """One check per row of a report table."""
    return table.select(
        F.lit(suite).alias("suite"),
        name.alias("check"),
        F.lit(severity).alias("severity"),
        (F.lit(None) if observed is None else observed).cast("double").alias("observed"),
        (F.lit(None) if expected is None else expected).cast("double").alias("expected"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
    )


def schema_check(suite: str, df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """Exact names, order and types; the schema is known without reading data."""
    found = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    same = found == list(expected.items())
    row = (suite, "schema", "error", float(len(found)), float(len(expected)), same)
    return small_table(df.sparkSession, [row], CHECK_SCHEMA)


def summary(checks: DataFrame) -> DataFrame:
    """Per suite: passed checks, failures, warnings, and whether it is clean of failures."""
    failed = ~F.col("passed")
    failures = F.count_if(failed & (F.col("severity") == "error"))
    return checks.groupBy("suite").agg(
        F.count_if("passed").alias("passed"),
        failures.alias("failures"),
        F.count_if(failed & (F.col("severity") == "warn")).alias("warnings"),
        (failures == 0).alias("ok"),
    )


def summary_checks(suite: str, table: DataFrame, rows: Column | int) -> DataFrame:
    """Sanity of a numeric summary: full counts, ordered percentiles, mean in range."""
    ordered = (
        (F.col("min") <= F.col("p25"))
        & (F.col("p25") <= F.col("p50"))
        & (F.col("p50") <= F.col("p75"))
        & (F.col("p75") <= F.col("p95"))
        & (F.col("p95") <= F.col("max"))
    )
    in_range = (F.col("min") <= F.col("mean")) & (F.col("mean") <= F.col("max"))
    whole = rows if isinstance(rows, Column) else F.lit(rows)
    name = F.col("variable")
    return (
        check_rows(suite, table, F.concat(name, F.lit(": count")), F.col("n") == whole, observed=F.col("n"), expected=whole)
        .unionByName(check_rows(suite, table, F.concat(name, F.lit(": ordered percentiles")), ordered))
        .unionByName(check_rows(suite, table, F.concat(name, F.lit(": mean in range")), in_range))
        .unionByName(check_rows(suite, table, F.concat(name, F.lit(": sd not negative")), F.col("sd") >= 0))
    )


def share_checks(suite: str, table: DataFrame, by: Sequence[str], share: str = "pct") -> DataFrame:
    """Shares of every group sum to 100."""
    total = table.groupBy(*by).agg(F.sum(share).alias("_s"))
    name = F.concat_ws(" ", F.lit("shares of"), *[F.col(b).cast("string") for b in by])
    return check_rows(
        suite, total, name, close_to(F.col("_s"), F.lit(100.0)), observed=F.col("_s"), expected=F.lit(100.0)
    )


def correlation_checks(suite: str, matrix: DataFrame) -> DataFrame:
    """Unit diagonal, symmetry and range of a long correlation matrix."""
    mirror = matrix.select(
        F.col("var_x").alias("var_y"), F.col("var_y").alias("var_x"), F.col("r").alias("_m")
    )
    both = matrix.join(mirror, ["var_x", "var_y"])
    one = F.lit(1.0)
    return run_checks(
        suite,
        both.select(
            ((F.col("var_x") == F.col("var_y")) & ~close_to(F.col("r"), one)).alias("bad_diagonal"),
            (~close_to(F.col("r"), F.col("_m"))).alias("asymmetric"),
            (F.abs("r") > 1.0 + 1e-9).alias("out_of_range"),
        ),
        [Check(c, f"count_if({c})") for c in ("bad_diagonal", "asymmetric", "out_of_range")],
    )


def cluster_checks(suite: str, results: DataFrame, ks: Sequence[int], rows: int) -> DataFrame:
    """Sanity of a K comparison ``(k, silhouette, wssse, sizes, ...)``."""
    per_k = results.select(
        "k",
        (F.abs("silhouette") <= 1.0).alias("range"),
        (F.col("wssse") > 0).alias("positive"),
        (F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x) == rows).alias("complete"),
        (F.array_min("sizes") > 0).alias("no_empty"),
        (F.size("sizes") == F.col("k")).alias("as_many"),
    )
    return run_checks(
        suite,
        per_k,
        [
            Check("K evaluated", "count(*)", len(ks)),
            *[Check(c, f"count_if(not {c})") for c in ("range", "positive", "complete", "no_empty", "as_many")],
        ],
    )


def assignment_checks(suite: str, assigned: KeyedStage, panel: KeyedStage, group: str, sizes: DataFrame) -> DataFrame:
    """A stored assignment against its panel, in place: one row per key, no key too many or too few, sizes ``(group, rows)`` as reported."""
    against = run_checks(
        suite,
        difference(assigned, panel),
        [Check(f"assigned {c}", f"max({c})") for c in ("repeated", "orphans", "missing", "keyless")],
    )
    found = group_sizes(assigned, group).select(F.col(group).alias("_group"), F.col("rows").alias("_found"))
    both = found.join(sizes, F.col("_group").eqNullSafe(F.col(group)), "full_outer")
    named = F.concat(F.lit("size of "), F.coalesce(F.col("_group"), F.col(group)).cast("string"))
    whole = [F.coalesce(c, F.lit(0)) for c in ("_found", "rows")]
    return against.unionByName(check_rows(suite, both, F.coalesce(named, F.lit("size of no group")), whole[0] == whole[1], "error", *whole))


def selection_checks(suite: str, results: DataFrame) -> DataFrame:
    """Per algorithm: MAE and RMSE coherent, one selection, and it has the least RMSE."""
    per_algorithm = results.groupBy("algorithm").agg(
        F.count_if((F.col("rmse") < F.col("mae")) | (F.col("mae") < 0)).alias("incoherent"),
        F.count_if("selected").alias("selected"),
        (F.min(F.when(F.col("selected"), F.col("rmse"))) == F.min("rmse")).alias("least"),
    )
    name = F.col("algorithm")
    return (
        check_rows(suite, per_algorithm, F.concat(name, F.lit(": coherent")), F.col("incoherent") == 0)
        .unionByName(check_rows(suite, per_algorithm, F.concat(name, F.lit(": one selected")), F.col("selected") == 1))
        .unionByName(check_rows(suite, per_algorithm, F.concat(name, F.lit(": least RMSE")), F.col("least")))
    )


def partition_checks(suite: str, train: DataFrame, test: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Unique ids on both sides, no shared id, no NULL in the model columns.

    One aggregate per id over the stacked sides answers all of it.
    """
    nulls = F.greatest(*[F.col(c).isNull() for c in columns], F.lit(False))
    sides = [
        df.select(F.col(key), F.lit(side).alias("_side"), nulls.alias("_null")) for side, df in ((0, train), (1, test))
    ]
    per_id = (
        sides[0]
        .unionAll(sides[1])
        .groupBy(key)
        .agg(
            F.count_if(F.col("_side") == 0).alias("a"),
            F.count_if(F.col("_side") == 1).alias("b"),
            F.count_if("_null").alias("nulls"),
        )
    )
    return run_checks(
        suite,
        per_id,
        [
            Check("train ids unique", "count_if(a > 1)"),
            Check("test ids unique", "count_if(b > 1)"),
            Check("no shared ids", "count_if(a > 0 and b > 0)"),
            Check("no NULL in model columns", "coalesce(sum(nulls), 0)"),
        ],
    )


def prediction_checks(
    suite: str, scored: DataFrame, target: str, models: Mapping[str, str], period: str, expected_period: str
) -> DataFrame:
    """Residual identity, finite predictions and the right period, in one aggregate."""
    checks = [Check("rows of another period", f"count_if({period} <> '{expected_period}')")]
    for m, p in models.items():
        checks += [
            Check(f"{m}: finite", f"count_if({p} is null or isnan({p}) or abs({p}) = double('infinity'))"),
            Check(f"{m}: residual identity", f"count_if(not residual_{m} <=> ({target} - {p}))"),
        ]
    return run_checks(suite, scored, checks)

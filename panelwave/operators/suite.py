"""All checks of a typed stage from two scans: one aggregate over its rows, one over its keys.

Both aggregates become long rows ``(scope, measure, observed)``. Period controls are rows of the same form, and one small
aggregate by scope and measure sets them side by side, so a period that is missing on either side shows up as a failure.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwave.functions.codes import code_label
from panelwave.functions.numeric import typed
from panelwave.operators.population import first_failure
from panelwave.operators.quality import key_versions
from panelwave.operators.shape import rows_from, struct
from panelwave.spec import UNKNOWN, PanelSpec

UNCONVERTIBLE = "_unconvertible"
#: Measures that are compared with a control; all others must be 0. "missing" only warns.
CONTROLLED = ("rows", "eligible")
CONTROL_SCHEMA = "scope string, measure string, expected long"


def type_with_marks(normalized: DataFrame, types: Mapping[str, str], keep: Sequence[str]) -> DataFrame:
    """Typed cells, and the positions of the columns whose text has no typed value.

    A stage that keeps the marks answers how many cells were missing and how many did not fit, without the raw text.
    """
    cells = [typed(F.col(c), t) for c, t in types.items()]
    marks = [F.when(F.col(c).isNotNull() & cell.isNull(), F.lit(i)) for i, (c, cell) in enumerate(zip(types, cells, strict=True))]
    out = [cell.alias(c) for c, cell in zip(types, cells, strict=True)]
    row = F.struct(*out, F.array_compact(F.array(*marks)).alias(UNCONVERTIBLE))
    return normalized.select(*keep, F.inline(F.array(row)))


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def _row_measures(spec: PanelSpec) -> dict[str, Column]:
    """Aggregates over the rows of a group, by the name of what they measure."""
    ok = F.col("_fail").isNull()
    found = {"rows": F.count(F.lit(1)), "eligible": F.count_if("_eligible")}
    found["funnel"] = F.abs(F.count_if(ok) - F.count_if("_eligible"))
    for i, c in enumerate(spec.columns):
        marked = F.array_contains(f"_own.{UNCONVERTIBLE}", i)
        found[f"missing {c}"] = F.count_if(F.col(f"_own.{c}").isNull() & ~marked)
        found[f"unconvertible {c}"] = F.count_if(marked)
    for c, codes in spec.audited_codes.items():
        found[f"out of domain {c}"] = F.count_if(~F.col(f"_own.{c}").isin(*codes))
    inside = F.col("_eligible")
    for c in spec.categories:
        found[f"unknown {c}"] = F.count_if(inside & (F.col(c) == UNKNOWN))
    for c in spec.model_columns:
        found[f"NULL {c}"] = F.count_if(inside & F.col(c).isNull())
    for name, text in spec.violations.items():
        found[name] = F.count_if(inside & F.expr(text))
    return found


def row_counts(stage: DataFrame, spec: PanelSpec, quarter: str | None = None) -> DataFrame:
    """``(scope, measure, observed)`` of every period from one scan.

    ``quarter`` names a column whose values are counted too, as ``quarter <value>``.
    """
    analytic = [
        *[F.col(c) for c in spec.carried],
        *[F.expr(text).alias(n) for n, text in spec.measures.items()],
        *[code_label(F.col(source), codes).alias(n) for n, (source, codes) in spec.categories.items()],
        *[F.col(source).alias(n) for n, source in spec.code_columns.items()],
    ]
    passes = _all([F.coalesce(F.expr(r.condition), F.lit(False)) for r in spec.rules])
    # The stage's own columns stay apart: an analytic name may differ from one of theirs in case only.
    own = F.struct(*[F.col(c) for c in dict.fromkeys([spec.period, *spec.columns, UNCONVERTIBLE])])
    rows = stage.select(own.alias("_own"), first_failure(spec.rules).alias("_fail"), passes.alias("_eligible"), *analytic)
    value = F.lit(None).cast("string") if quarter is None else F.coalesce(F.col(f"_own.{quarter}").cast("string"), F.lit("NULL"))
    measures = _row_measures(spec)
    aggregates = [m.cast("long").alias(f"_{i}") for i, m in enumerate(measures.values())]
    wide = rows.groupBy(F.col(f"_own.{spec.period}").alias("scope"), value.alias("_value")).agg(*aggregates)
    cells = [struct(measure=name, observed=F.col(f"_{i}")) for i, name in enumerate(measures)]
    cells.append(struct(measure=F.concat(F.lit("quarter "), F.col("_value")), observed=F.col("_0")))
    return rows_from(wide, ["scope"], cells).where("measure is not null")


def key_counts(stage: DataFrame, spec: PanelSpec) -> DataFrame:
    """``(scope, measure, observed)``: NULL and repeated keys, exact copies; one scan.

    A record id is made of the period and the key, so unique keys make unique ids.
    """
    per_key = key_versions(stage, spec.keys, spec.columns, [spec.period])
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in spec.keys])
    wide = per_key.groupBy(F.col(spec.period).alias("scope")).agg(
        F.sum(F.when(null_key, F.col("rows")).otherwise(0)).alias("null keys"),
        F.sum(F.col("rows") - 1).alias("surplus keys"),
        F.sum(F.col("rows") - F.col("versions")).alias("exact copies"),
    )
    return rows_from(wide, ["scope"], [struct(measure=c, observed=F.col(c)) for c in wide.columns[1:]])


def suite(
    stage: DataFrame,
    spec: PanelSpec,
    controls: DataFrame | None = None,
    sets: Mapping[str, Sequence[str]] | None = None,
    quarter: str | None = None,
) -> DataFrame:
    """``(scope, measure, severity, observed, expected, passed)`` of every check.

    ``controls`` holds rows ``(scope, measure, expected)``; a scope is a period or a name in ``sets``, whose rows and
    eligible rows are added up over its periods. With controls, rows of every period must have one, and every quarter
    that occurs or is expected is checked. Eligible and missing counts are checked where a control names them. All other
    measures must be 0; cells that do not fit, foreign codes and missing counts only warn. NULL is a period of its own.
    """
    spark = stage.sparkSession
    if controls is None:
        controls = spark.createDataFrame([], CONTROL_SCHEMA)
        kept = ~F.col("measure").isin(*CONTROLLED) & ~F.col("measure").startswith("quarter ")
    else:
        kept = F.col("measure").startswith("quarter ") | (F.col("measure") == "rows") | ~F.col("measure").isin(*CONTROLLED)
    observed = row_counts(stage, spec, quarter).unionByName(key_counts(stage, spec))
    scopes = F.array("scope")
    for name, periods in (sets or {}).items():
        member = F.col("measure").isin(*CONTROLLED) & F.col("scope").isin(*periods)
        scopes = F.concat(scopes, F.when(member, F.array(F.lit(name))).otherwise(F.array()))
    observed = observed.select(F.explode(scopes).alias("scope"), "measure", "observed", F.lit(None).cast("long").alias("expected"))
    wanted = controls.select("scope", "measure", F.lit(None).cast("long").alias("observed"), F.col("expected").cast("long"))
    both = observed.unionByName(wanted).groupBy("scope", "measure").agg(
        F.coalesce(F.sum("observed"), F.lit(0)).alias("observed"), F.max("expected").alias("expected")
    )
    missing = F.col("measure").startswith("missing ")
    a_set = F.coalesce(F.col("scope").isin(*(sets or {})), F.lit(False)) if sets else F.lit(False)
    both = both.where(F.col("expected").isNotNull() | (kept & ~missing & ~a_set))
    must_be = F.when(F.col("measure") != "rows", F.coalesce("expected", F.lit(0))).otherwise(F.col("expected"))
    warns = missing | F.col("measure").startswith("unconvertible ") | F.col("measure").startswith("out of domain ")
    return both.select(
        "scope", "measure", F.when(warns, "warn").otherwise("error").alias("severity"), "observed", must_be.alias("expected"),
        F.col("observed").eqNullSafe(must_be).alias("passed"),
    )

"""From raw text to the eligible panel, with every audit along the way.

All periods go through one plan; each audit is one aggregate grouped by period.
Nothing runs until a caller writes or collects a frame.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwave.functions.codes import code_label, record_id
from panelwave.functions.text import normalize_cell
from panelwave.operators import checks as ck
from panelwave.operators import population, quality
from panelwave.operators.suite import type_with_marks
from panelwave.sources.sinks import read_stage, write_periods
from panelwave.spec import PanelSpec


def normalize(raw: DataFrame, spec: PanelSpec, keep: tuple[str, ...]) -> DataFrame:
    """Raw cells with sentinels, thousands marks and trailing zeros resolved."""
    return raw.select(*keep, *[normalize_cell(F.col(c)).alias(c) for c in spec.columns])


def eligible_projection(spec: PanelSpec) -> list[Column]:
    """Analytic names and labels of the eligible table."""
    return [
        record_id(F.col(spec.period), *[F.col(k) for k in spec.keys]).alias(spec.record_id),
        *[F.col(c) for c in spec.carried],
        *[F.expr(text).alias(name) for name, text in spec.measures.items()],
        *[code_label(F.col(source), codes).alias(name) for name, (source, codes) in spec.categories.items()],
        *[F.col(source).alias(name) for name, source in spec.code_columns.items()],
    ]


@dataclass(frozen=True)
class Foundation:
    """Lazy frames of the first phase; column lists are those of the spec."""

    spec: PanelSpec
    normalized: DataFrame
    typed: DataFrame

    @property
    def eligible(self) -> DataFrame:
        return population.eligible(self.typed, self.spec.rules).select(*eligible_projection(self.spec))

    def stored(self, path: str, row: str) -> Foundation:
        """The typed stage written by period; later audits read it and parse no text again."""
        spark = self.typed.sparkSession
        write_periods(self.typed, path, self.spec.period, row)
        stage = read_stage(spark, path, *self.typed.columns)
        return Foundation(self.spec, self.normalized, stage)

    def stored_eligible(self, path: str, row: str) -> DataFrame:
        """The eligible panel written by period: what every later phase reads."""
        eligible = self.eligible
        write_periods(eligible, path, self.spec.period, row)
        return read_stage(eligible.sparkSession, path, *eligible.columns)

    def missing(self) -> DataFrame:
        return quality.missing_invalid(self.normalized, self.spec.types, [self.spec.period])

    def funnel(self) -> DataFrame:
        return population.funnel(self.typed, self.spec.rules, [self.spec.period])

    def keys(self) -> DataFrame:
        return quality.key_audit(self.typed, self.spec.keys, self.spec.columns, [self.spec.period])

    def keys_across_periods(self) -> DataFrame:
        return quality.cross_period_keys(self.typed, self.spec.keys, self.spec.period)

    def codes(self) -> DataFrame:
        return quality.domain_audit(self.typed, self.spec.audited_codes, [self.spec.period])

    def values(self, columns: tuple[str, ...]) -> DataFrame:
        return quality.value_counts(self.typed, columns, [self.spec.period])

    def unknown_labels(self) -> DataFrame:
        wanted = {c: f"{c} = 'DESCONOCIDO'" for c in self.spec.categories}
        return quality.violation_counts(self.eligible, wanted, [self.spec.period])

    def checks(self) -> DataFrame:
        """Keys complete and unique, typing clean, funnel consistent, eligible rows valid."""
        spec = self.spec
        period = F.col(spec.period)
        keys = self.keys()
        steps = population.chain_check(self.funnel(), [spec.period])
        found = [
            ck.check_rows(
                "foundation", keys, F.concat(period, F.lit(f": {c}")), F.col(c) == 0, observed=F.col(c), expected=F.lit(0)
            )
            for c in ("null_keys", "surplus_keys", "exact_duplicates")
        ]
        invalid = self.missing()
        found.append(
            ck.check_rows(
                "foundation",
                invalid,
                F.concat(period, F.lit(": unconvertible "), F.col("column")),
                F.col("invalid") == 0,
                "warn",
                F.col("invalid"),
                F.lit(0),
            )
        )
        codes = self.codes()
        found.append(
            ck.check_rows(
                "foundation",
                codes,
                F.concat(period, F.lit(": out of domain "), F.col("column")),
                F.col("out_of_domain") == 0,
                "warn",
                F.col("out_of_domain"),
                F.lit(0),
            )
        )
        found.append(
            ck.check_rows(
                "foundation",
                steps,
                F.concat(period, F.lit(": funnel "), F.col("rule")),
                F.col("arithmetic_ok") & F.col("chain_ok"),
            )
        )
        found.append(eligible_checks(self.eligible, spec))
        out = found[0]
        for frame in found[1:]:
            out = out.unionByName(frame)
        return out


def eligible_checks(eligible: DataFrame, spec: PanelSpec) -> DataFrame:
    """No NULL in a model column, no violated condition (one aggregate), ids unique."""
    listed = [ck.Check(f"NULL in {c}", f"count_if({c} is null)") for c in spec.model_columns]
    listed += [ck.Check(name, f"count_if({text})") for name, text in spec.violations.items()]
    per_id = eligible.groupBy(spec.record_id).agg(F.count(F.lit(1)).alias("n"))
    return ck.run_checks("eligible", eligible, listed).unionByName(
        ck.run_checks("eligible", per_id, [ck.Check("repeated record ids", "count_if(n > 1)")])
    )


def foundation(raw: DataFrame, spec: PanelSpec, provenance: tuple[str, ...]) -> Foundation:
    normalized = normalize(raw, spec, provenance)
    return Foundation(spec, normalized, quality.type_columns(normalized, spec.types, provenance))


def marked_stage(raw: DataFrame, spec: PanelSpec, provenance: tuple[str, ...], path: str, row: str) -> DataFrame:
    """The typed stage with marks of cells that did not fit, written by period and read back: input of the check suite."""
    typed = type_with_marks(normalize(raw, spec, provenance), spec.types, provenance)
    write_periods(typed, path, spec.period, row)
    return read_stage(raw.sparkSession, path, *typed.columns)

"""Descriptive phase over the eligible panel."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwave.functions.codes import ordinal
from panelwave.operators import association, profile, segments
from panelwave.operators import checks as ck
from panelwave.operators.shape import one_row
from panelwave.sources.controls import with_label
from panelwave.spec import PanelSpec


@dataclass(frozen=True)
class Description:
    spec: PanelSpec
    eligible: DataFrame

    @property
    def measures(self) -> list[str]:
        return [self.spec.target, *self.spec.predictors]

    def summary(self) -> DataFrame:
        return profile.numeric_summary(self.eligible, self.measures)

    def summary_by_period(self) -> DataFrame:
        return profile.numeric_summary(self.eligible, self.measures, [self.spec.period])

    def categories(self, category: str) -> DataFrame:
        table = profile.category_table(self.eligible, category, self.spec.target)
        return with_label(table, category, self.spec.labels.get(category, {}))

    def composition(self, category: str) -> DataFrame:
        return profile.composition_by_period(self.eligible, self.spec.period, category, self.spec.target)

    def tail(self) -> DataFrame:
        return profile.tail_concentration(self.eligible, self.spec.target)

    def correlation(self) -> DataFrame:
        return association.pearson(self.eligible, self.measures)

    def checks(self) -> DataFrame:
        rows = one_row(self.eligible, n=F.count(F.lit(1)))["n"]
        found = ck.summary_checks("describe", self.summary(), rows).unionByName(
            ck.correlation_checks("describe", self.correlation())
        )
        for category in self.spec.categories:
            found = found.unionByName(ck.share_checks("describe", self.composition(category), [self.spec.period]))
        return found

    def clustering_input(self, source: str = "nivel_educativo", name: str = "nivel_educativo_ordinal") -> DataFrame:
        """Adds the ordinal code; a row whose code is unknown has none and cannot be clustered."""
        return self.eligible.withColumn(name, ordinal(F.col(source)))

    def clustering_gaps(self, columns: tuple[str, ...]) -> DataFrame:
        """One row: eligible rows, and those that cannot be clustered for want of a measure."""
        gap = F.exists(F.array(*[F.col(c).isNull() for c in columns]), lambda x: x)
        return self.clustering_input().agg(F.count(F.lit(1)).alias("rows"), F.count_if(gap).alias("excluded"))

    def clusters(self, columns: tuple[str, ...]) -> segments.KMeansGrid:
        """K-means over the rows that have all measures; ``clustering_gaps`` counts the others."""
        return segments.kmeans_grid(
            self.clustering_input().dropna(subset=list(columns)), self.spec.record_id, columns
        )

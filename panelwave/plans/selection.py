"""Model phases: select on earlier periods, refit once, test once on the next period."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwave.operators import checks as ck
from panelwave.operators import evaluate, models
from panelwave.sources.sinks import write_stage
from panelwave.spec import PanelSpec


def select_models(
    panel: DataFrame,
    spec: PanelSpec,
    train: Sequence[str],
    valid: Sequence[str],
    configs: Sequence[models.Config] | None = None,
) -> models.Grid:
    """Every configuration fitted on the train periods, scored on the validation ones."""
    fit_rows, valid_rows = models.split_by_period(panel, spec.period, train, valid)
    return models.fit_grid(
        fit_rows, valid_rows, spec.record_id, spec.target, spec.predictors, list(spec.categories), configs
    )


@dataclass
class FinalTest:
    """Scored test rows with bands, and the reports over them (all lazy)."""

    spec: PanelSpec
    scored: DataFrame
    models: dict[str, str]
    fitted: dict[str, Model]
    features: PipelineModel

    def stored(self, path: str) -> FinalTest:
        """The scored rows written once; every report then reads them and no model runs again."""
        return replace(self, scored=write_stage(self.scored, path))

    def metrics(self) -> DataFrame:
        return evaluate.metrics(self.scored, self.spec.target, self.models)

    def errors(self) -> DataFrame:
        return evaluate.error_table(
            self.scored, self.spec.target, self.models, [*list(self.spec.categories), "band"]
        )

    def high_band(self) -> DataFrame:
        return evaluate.high_band(self.scored, self.spec.target, self.models)

    def compared(self, grid: models.Grid, baseline: str = "baseline") -> DataFrame:
        """Metrics next to the gain over the baseline and the change of the RMSE against the validation."""
        kept = grid.candidates().where(F.col("selected") | (F.col("algorithm") == baseline))
        return evaluate.improvement(self.metrics(), baseline, kept.select(F.col("algorithm").alias("model"), "rmse"))

    def conclusions(self, baseline: str = "baseline") -> DataFrame:
        gains = evaluate.improvement(self.metrics(), baseline)
        return evaluate.conclusions(gains, self.high_band(), evaluate.worst_group(self.errors()))

    def checks(self, train: DataFrame, period: str) -> DataFrame:
        spec = self.spec
        with_residuals = evaluate.with_residuals(self.scored, spec.target, self.models)
        return ck.partition_checks(
            "final", train, self.scored, spec.record_id, spec.model_columns
        ).unionByName(
            ck.prediction_checks("final", with_residuals, spec.target, self.models, spec.period, period)
        )


def final_test(
    panel: DataFrame,
    spec: PanelSpec,
    train: Sequence[str],
    test: Sequence[str],
    frozen: dict[str, models.Config],
) -> FinalTest:
    """Frozen configurations refitted on all train periods and applied to the test periods."""
    fit_rows, test_rows = models.split_by_period(panel, spec.period, train, test)
    features, fitted = models.refit(
        fit_rows, spec.record_id, spec.target, spec.predictors, list(spec.categories), frozen
    )
    columns = [spec.record_id, spec.period, spec.target, *spec.predictors, *spec.categories]
    scored = models.score(test_rows.select(*columns), features, fitted)
    scored = evaluate.with_band(evaluate.predict_mean(fit_rows, scored, spec.target), spec.target)
    names = {"baseline": "pred_baseline", **{n: models.prediction_column(n) for n in fitted}}
    return FinalTest(spec, scored, names, fitted, features)


def evaluate_once(
    panel: DataFrame,
    spec: PanelSpec,
    train: Sequence[str],
    valid: Sequence[str],
    test: Sequence[str],
    path: str,
    force: bool = False,
) -> tuple[models.Grid, FinalTest]:
    """Select, freeze, refit, and test once.

    A result below ``path`` is an error unless forced, and is looked for before anything is fitted. The frozen
    configurations are stored there with the fingerprint of the selection rows before the refit, the scored test rows
    after it.
    """
    models.assert_unused(panel.sparkSession, f"{path}/scored", force)
    grid = select_models(panel, spec, train, valid)
    selection_rows = panel.where(F.col(spec.period).isin(*train, *valid)).select(spec.record_id, *spec.model_columns)
    write_stage(models.frozen_configs(grid, selection_rows), f"{path}/frozen")
    tested = final_test(panel, spec, (*train, *valid), test, grid.frozen())
    return grid, tested.stored(f"{path}/scored")

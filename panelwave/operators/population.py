"""The eligibility funnel: ordered rules, counted in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwave.operators.shape import rows_from, struct
from panelwave.spec import Rule


def first_failure(rules: Sequence[Rule]) -> Column:
    """Number of the first rule a row fails; NULL if it passes them all."""
    chain = None
    for step, rule in enumerate(rules, start=1):
        failed = ~F.coalesce(F.expr(rule.condition), F.lit(False))
        chain = F.when(failed, step) if chain is None else chain.when(failed, step)
    return chain


def funnel(df: DataFrame, rules: Sequence[Rule], by: Sequence[str] = ()) -> DataFrame:
    """``(by, step, rule, before, excluded, after)`` as if the rules were applied in turn.

    Each row is counted at the first rule it fails, so a single partial aggregate
    replaces one filtered count per rule.
    """
    steps = range(1, len(rules) + 1)
    wide = (
        df.select(*by, first_failure(rules).alias("_fail"))
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("_0"),
            *[F.count_if(F.col("_fail") == i).alias(f"_{i}") for i in steps],
        )
    )
    structs = []
    before = F.col("_0")
    for i, rule in zip(steps, rules):
        after = before - F.col(f"_{i}")
        structs.append(
            struct(step=i, rule=rule.name, before=before, excluded=F.col(f"_{i}"), after=after)
        )
        before = after
    return rows_from(wide, by, structs)


def eligible(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that pass every rule. Plain predicates, so the scan can use them."""
    for rule in rules:
        df = df.where(rule.condition)
    return df


def chain_check(steps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per funnel row: is the step's arithmetic right and does it start where the last ended."""
    order = Window.partitionBy(*by).orderBy("step") if by else Window.orderBy("step")
    previous = F.lag("after").over(order)
    return steps.withColumn(
        "arithmetic_ok", F.col("before") - F.col("excluded") == F.col("after")
    ).withColumn("chain_ok", F.coalesce(previous == F.col("before"), F.lit(True)))

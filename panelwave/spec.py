"""Declarative description of a panel: what to read, how to type it, who is in.

Every rule and predicate is a Spark SQL expression string, so a spec can be
written, stored and compared without a running session.
"""

from __future__ import annotations

from dataclasses import dataclass, field

UNKNOWN = "DESCONOCIDO"


@dataclass(frozen=True)
class Rule:
    """One step of the eligibility funnel; NULL counts as not fulfilled."""

    name: str
    condition: str


@dataclass(frozen=True)
class Control:
    """Expected row count over a named set of periods."""

    name: str
    periods: tuple[str, ...]
    expected: int


@dataclass(frozen=True)
class PanelSpec:
    types: dict[str, str]
    keys: tuple[str, ...]
    rules: tuple[Rule, ...]
    audited_codes: dict[str, tuple[int, ...]]
    measures: dict[str, str]
    categories: dict[str, tuple[str, tuple[int, ...]]]
    target: str
    predictors: tuple[str, ...]
    labels: dict[str, dict[str, str]] = field(default_factory=dict)
    violations: dict[str, str] = field(default_factory=dict)
    period: str = "period"
    record_id: str = "record_id"
    carried: tuple[str, ...] = ()
    code_columns: dict[str, str] = field(default_factory=dict)

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(self.types)

    @property
    def model_columns(self) -> tuple[str, ...]:
        return (self.target, *self.predictors, *self.categories)

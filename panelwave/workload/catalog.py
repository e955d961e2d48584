"""All registered queries; importing the modules fills the registry."""

from panelwave.workload import audits, household, ingest, keyed, modelling, profiles, states  # noqa: F401
from panelwave.workload.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]

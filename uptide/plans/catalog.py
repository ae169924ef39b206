"""Imports every query module, which fills the registry."""

from uptide.plans import cleaning, feature_tables, files, history, maintenance, modelling, profiling, reporting, streams  # noqa: F401
from uptide.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]

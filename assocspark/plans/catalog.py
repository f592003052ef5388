"""All registered queries."""

from assocspark.plans import linking, loads, prepared, profiles, projections, questions  # noqa: F401
from assocspark.plans.registry import QUERIES

__all__ = ["QUERIES"]

"""Imports every plan module, so that all queries are registered."""

from zonewise.plans import (  # noqa: F401
    delivery,
    detection,
    evaluation,
    monitoring,
    quality,
    triage,
    zones,
)
from zonewise.plans.registry import PLANS, SQL

__all__ = ["PLANS", "SQL"]

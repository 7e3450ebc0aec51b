"""Queries by name, and the SQL that gives the same rows."""

from __future__ import annotations

from .plans import checks, delivery, people, speech, text  # noqa: F401  they register their queries
from .plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

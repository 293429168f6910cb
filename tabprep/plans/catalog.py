"""All registered queries."""

from __future__ import annotations

from tabprep.plans import files, functions, operations, reporting, tables  # noqa: F401
from tabprep.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

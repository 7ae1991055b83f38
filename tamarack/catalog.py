"""All queries of the engine and the SQL that gives the same rows."""

from __future__ import annotations

from .plans import accounting, discovery, running, signals, streams  # noqa: F401
from .plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

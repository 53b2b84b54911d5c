"""All queries of the library."""

from __future__ import annotations

from rostra.plans import domain, more, orchestrated, readers, scalar, storage  # noqa: F401
from rostra.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]

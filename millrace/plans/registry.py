"""All queries over the driver's tables, with the SQL that must give the same rows."""

from __future__ import annotations

from millrace.plans import documents, records, scoring, semantics, stores, tables  # noqa: F401
from millrace.plans.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]

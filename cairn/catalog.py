"""Every query of the engine by name, with its DuckDB SQL."""

from __future__ import annotations

from cairn.plans import report_queries  # noqa: F401  registers its queries
from cairn.plans.queries import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]

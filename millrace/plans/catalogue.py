"""Every query of the engine by name, with its DuckDB oracle."""

from __future__ import annotations

from millrace.plans import q_aggregates, q_delivery, q_grades, q_graph_text_space, q_joins, q_scalars, q_streams  # noqa: F401
from millrace.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]

"""All queries of the snapshot operators and their oracle SQL."""

from __future__ import annotations

from sedimenta.plans import cell_queries, diff_queries, profile_queries, scalar_queries, window_queries
from sedimenta.plans.cell_queries import flagship
from sedimenta.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "cell_queries", "diff_queries", "flagship", "profile_queries", "scalar_queries", "window_queries"]

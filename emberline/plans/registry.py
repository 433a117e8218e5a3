"""All queries of the reference's operators and their SQL."""

from __future__ import annotations

from . import cluster_queries, day_queries, kernel_queries, learning_queries, profile_queries, scalar_queries, streak_queries  # noqa: F401
from .common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

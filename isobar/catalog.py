"""All queries of the library by name, with their SQL."""

from __future__ import annotations

from isobar.plans import calibration_queries, feature_queries, forecast_queries, grid_queries, issue_queries, model_queries, observation_queries, source_queries, star_queries, stream_queries, support_queries  # noqa: F401  they register their queries
from isobar.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

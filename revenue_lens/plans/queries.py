"""Importing this module registers every query."""

from revenue_lens.plans import customer_queries, forecast_queries, model_queries, monitoring_queries  # noqa: F401
from revenue_lens.plans.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

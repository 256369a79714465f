"""Registered queries over the data folder, and the runs that a user starts."""

from ladderworks.plans import event_queries, file_queries, function_queries, meta_queries, publish_queries, state_queries  # noqa: F401  each module registers its queries
from ladderworks.plans.standins import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

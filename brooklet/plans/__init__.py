"""Queries over the test tables, by name."""

from brooklet.plans import (  # noqa: F401
    aggregate_queries,
    join_queries,
    pattern_queries,
    scalar_queries,
    source_queries,
    state_queries,
    udf_queries,
    window_queries,
)
from brooklet.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

"""All registered queries."""

from . import (  # noqa: F401
    asof_queries,
    market_queries,
    model_queries,
    quality_queries,
    relational_queries,
    source_queries,
    state_queries,
)
from .registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]

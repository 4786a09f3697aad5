"""Named queries over the star schema; importing them registers them."""

from . import asof_queries, cross_queries, indicator_queries, layer_queries, universe_queries  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]

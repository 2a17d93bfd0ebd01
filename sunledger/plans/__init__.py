"""All registered queries."""

from sunledger.plans import grid_queries, model_queries, quality_queries, score_queries, source_queries, stream_queries, timing_queries  # noqa: F401
from sunledger.plans.registry import CATALOG, Query, runner

__all__ = ["CATALOG", "Query", "runner"]

"""All registered queries; importing this module fills the registry."""

from scorespark.plans import (  # noqa: F401
    flow_queries,
    model_queries,
    monitor_queries,
    prep_queries,
    score_queries,
)
from scorespark.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]

"""All registered queries."""

from ludolytics.workloads import (  # noqa: F401
    explore_queries,
    feature_queries,
    ingest_queries,
    recommend_queries,
    retrieval_queries,
    warehouse_queries,
)
from ludolytics.workloads.registry import WORKLOADS

__all__ = ["WORKLOADS"]

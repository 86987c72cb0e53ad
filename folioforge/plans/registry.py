"""Registry of the core queries and their oracle SQL."""

from __future__ import annotations

from . import allocation_queries, cluster_queries, flow_queries, page_queries, review_queries, similarity_queries, tier_queries

MODULES = (similarity_queries, tier_queries, cluster_queries, allocation_queries, flow_queries, page_queries, review_queries)


def queries() -> dict:
    """Query name -> callable (spark, sf_dir) -> DataFrame."""
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    """Query name -> DuckDB SQL with the same rows and columns, where SQL can state them."""
    return {k: s for m in MODULES for k, s in m.ORACLES.items()}

"""Queries of the training-data operators and their oracle SQL.

Each module of :data:`MODULES` lists its queries in ``QUERIES`` and, where SQL
can state the result, the SQL in ``ORACLES``.
"""

from __future__ import annotations

from importlib import import_module

#: Modules with queries, by problem.
MODULES = ("token_queries", "consensus_queries", "quota_queries", "cluster_queries", "mojibake_queries", "truncation_queries", "lookalike_queries", "packing_queries", "subset_queries")


def _gather(what: str) -> dict:
    found: dict = {}
    for name in MODULES:
        found |= getattr(import_module(f"{__package__}.{name}"), what, {})
    return found


def queries() -> dict:
    return _gather("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _gather("ORACLES")

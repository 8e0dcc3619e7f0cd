"""All registered queries with their oracle SQL."""

from __future__ import annotations

from casemill.plans import queries_core, queries_decide, queries_enrich, queries_models, queries_retrieval, queries_text

MODULES = [queries_core, queries_decide, queries_enrich, queries_models, queries_retrieval, queries_text]


def all_queries() -> dict:
    return {name: fn for module in MODULES for name, fn in module.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLE.items()}

"""All registered queries with their SQL counterparts."""

from __future__ import annotations

from workload import checks, live, market, messages, search, streams

MODULES = (market, checks, search, messages, live, streams)


def queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for module in MODULES for name, text in module.ORACLE.items()}

"""All named queries of the engine with their SQL oracles."""

from __future__ import annotations

from civitas.plans import analyses, functions_queries, merge_queries, page_queries, response_queries  # noqa: F401  they register themselves


def queries():
    return dict(analyses.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(analyses.SQL)

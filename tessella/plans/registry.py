"""All registered queries over the derived tables, and their SQL."""

from __future__ import annotations

from tessella.plans import catalog, decode_queries, log_queries, space_queries, voxel_queries  # noqa: F401


def queries() -> dict:
    return dict(catalog.QUERIES)


def oracle_sql() -> dict:
    return dict(catalog.SQL)

"""Registered queries over the fixture tables, with their SQL."""

from __future__ import annotations

from . import archives, catalog, curate, entities, evidence, folds, functions, intake, lineage, records, rules, serve, summary, views  # noqa: F401  (each registers its queries)
from .base import QUERIES, SQL, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)

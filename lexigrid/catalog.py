"""Every query of the library on the driver's tables, with the SQL that another engine runs for it."""

from __future__ import annotations

from lexigrid.queries import entries, folds, language, lookups, merges, policies, quality, texts  # noqa: F401
from lexigrid.queries.registry import QUERIES, SQL, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)

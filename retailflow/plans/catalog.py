"""All registered queries."""

from __future__ import annotations

from . import catalog_prices, core, planning, sales, supply  # noqa: F401  (register on import)
from .registry import QUERIES, run


def queries() -> dict:
    return {name: run(q) for name, q in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.sql for name, q in QUERIES.items() if q.sql}

"""All queries of the library proper and their SQL."""

from __future__ import annotations

from . import jobs, tables  # noqa: F401  (add their queries)
from .parity import QUERIES, SQL


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)

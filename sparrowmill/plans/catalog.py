"""All queries of the engine and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from . import corpora, models, notices, relational, rows, stream, structures

FLAGSHIP = "keyword_search"
MODULES = (rows, relational, models, corpora, notices, structures, stream)


def queries() -> dict[str, Callable]:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}

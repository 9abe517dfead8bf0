"""Registration of queries together with the SQL that checks them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
_CTES: dict[str, str] = {}


def cte(name: str, body: str) -> str:
    """A named part of the checking SQL. Parts may use those registered before them."""
    if name in _CTES and _CTES[name] != body:
        raise ValueError(f"{name} is registered twice")
    _CTES[name] = body
    return name


def _needed(sql: str, upto: int) -> set[str]:
    out: set[str] = set()
    names = list(_CTES)[:upto]
    words = set(re.findall(r"[a-z_0-9]+", sql))
    for i, name in enumerate(names):
        if name in words:
            out |= {name} | _needed(_CTES[name], i)
    return out


def with_ctes(sql: str) -> str:
    needed = _needed(sql, len(_CTES))
    if not needed:
        return sql
    parts = [f"{n} AS ({b.strip()})" for n, b in _CTES.items() if n in needed]
    named, sql = "WITH " + ",\n".join(parts), sql.strip()
    # A query with parts of its own continues the list.
    return f"{named},\n{sql[5:]}" if sql.startswith("WITH ") else f"{named}\n{sql}"


def query(name: str, sql: str | None = None):
    """Register a query; `sql` is a SELECT over the tables and the named parts."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_ctes(sql)
        return fn

    return register

"""Registration of queries with their equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlake.catalog.roles import ROLE_SQL

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Both engines add this before rounding so that exact halves round the same way.
_NUDGE = 3e-9


def r6(col: Column | str) -> Column:
    """Six decimals, so that the last bits of a sum do not count in a comparison."""
    return F.round((F.col(col) if isinstance(col, str) else col).cast("double") + _NUDGE, 6)


def R(expr: str) -> str:
    """``r6`` in SQL."""
    return f"round(CAST({expr} AS DOUBLE) + {_NUDGE}, 6)"


def query(name: str, sql: str | None = None, roles: tuple[str, ...] = ("laps",)):
    """Register a query; ``sql`` is a SELECT, or CTEs and a SELECT, over ``roles``."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_roles(sql, roles)
        return fn

    return register


def with_roles(sql: str, roles: tuple[str, ...]) -> str:
    wanted: list[str] = []

    def need(role: str) -> None:
        deps, _ = ROLE_SQL[role]
        for d in deps:
            need(d)
        if role not in wanted:
            wanted.append(role)

    for r in roles:
        need(r)
    ctes = [f"{r} AS MATERIALIZED ({ROLE_SQL[r][1]})" for r in wanted]
    body = sql.strip()
    if not ctes:
        return body if body.upper().startswith("SELECT") else f"WITH {body}"
    sep = " " if body.upper().startswith("SELECT") else ", "
    return "WITH " + ", ".join(ctes) + sep + body

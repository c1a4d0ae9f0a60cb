"""Registry of runnable queries and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidegate.plans.inputs import INPUTS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, inputs: tuple[str, ...] = (), recursive: bool = False):
    """Register a query; `inputs` names derived inputs that the SQL text uses as leading CTEs."""

    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = _with_inputs(sql, inputs, recursive)
        return function

    return add


def _with_inputs(sql: str, inputs: tuple[str, ...], recursive: bool) -> str:
    wanted: list[str] = []

    def need(name: str) -> None:
        for other in INPUTS[name].uses:
            if other in INPUTS:
                need(other)
        if name not in wanted:
            wanted.append(name)

    for name in inputs:
        need(name)
    ctes = [f"{n} AS ({INPUTS[n].sql.format(**{u: u for u in INPUTS[n].uses})})" for n in wanted]
    if not ctes:
        return sql
    body = sql.strip()
    head = "WITH RECURSIVE " if recursive else "WITH "
    for start in ("WITH RECURSIVE ", "WITH "):
        if body.upper().startswith(start):
            return head + ", ".join(ctes) + ", " + body[len(start):]
    return head + ", ".join(ctes) + " " + body

"""Builds the DuckDB check queries: entity CTEs in front of a query body."""

from __future__ import annotations

import re

from tidefunnel.sources.mapping import ENTITIES
from tidefunnel.sources.warehouse import FIXTURE_AS_OF

AS_OF = f"DATE '{FIXTURE_AS_OF.isoformat()}'"


def rnd(expr: str, scale: int) -> str:
    """Half-up rounding that matches ``functions.exprs.rounded``."""
    return f"round(({expr}) + 1e-9 * sign({expr}), {scale})"


def div(a: str, b: str, scale: int, times: str = "") -> str:
    """``a / b`` in double at a scale, NULL on a zero divisor."""
    expr = f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)"
    return rnd(f"{expr} * {times}" if times else expr, scale)


def div0(a: str, b: str, scale: int, times: str = "") -> str:
    return f"coalesce({div(a, b, scale, times)}, 0)"


def money(expr: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 2)"


def avg(expr: str, cond: str = "") -> str:
    where = f" FILTER (WHERE {cond})" if cond else ""
    return f"CAST(sum({expr}){where} AS DOUBLE) / nullif(count({expr}){where}, 0)"


def entity_cte(name: str) -> str:
    entity = ENTITIES[name]
    cols = ", ".join(f"{expr} AS {col}" for col, expr in entity.columns)
    where = f" WHERE {entity.where}" if entity.where else ""
    return f"{name} AS (SELECT {cols} FROM {entity.base}{where})"


def check_query(body: str) -> str:
    """Prefix ``body`` with the CTEs of all entities it mentions."""
    body = body.strip().replace(":as_of", AS_OF)
    wanted: list[str] = []

    def need(name: str) -> None:
        for dep in ENTITIES[name].needs:
            need(dep)
        if name not in wanted:
            wanted.append(name)

    for name in ENTITIES:
        if re.search(rf"\b{name}\b", body):
            need(name)
    ctes = [entity_cte(name) for name in wanted]
    if not ctes:
        return body
    head = "WITH " + ",\n".join(ctes)
    if re.match(r"(?i)with\b", body):
        return head + ",\n" + body[4:].lstrip()
    return head + "\n" + body

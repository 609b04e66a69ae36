"""Named CTE fragments with dependencies, assembled into one statement."""

from __future__ import annotations

import re

CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    CTES[name] = sql.strip()


def _deps(sql: str) -> list[str]:
    words = set(re.findall(r"\b[a-z_][a-z0-9_]*\b", sql))
    return [n for n in CTES if n in words]


def with_ctes(body: str) -> str:
    """Prefix ``body`` with every CTE it (transitively) references, in
    dependency order."""
    order: list[str] = []
    seen: set[str] = set()

    def visit(name: str, stack: tuple = ()) -> None:
        if name in seen:
            return
        for d in _deps(CTES[name]):
            if d != name and d not in stack:
                visit(d, stack + (name,))
        seen.add(name)
        order.append(name)

    for d in _deps(body):
        visit(d)
    if not order:
        return body.strip()
    parts = ",\n".join(f"{n} AS (\n{CTES[n]}\n)" for n in order)
    return f"WITH {parts}\n{body.strip()}"

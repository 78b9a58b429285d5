"""Registration of queries and assembly of their comparison SQL."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from estrato.catalog.data import Data
from estrato.catalog.views import VIEWS

REGISTRY: dict[str, "Query"] = {}


@dataclass(frozen=True)
class Query:
    run: Callable[[Data], DataFrame]
    sql: str | None


def query(name: str, sql: str | None = None):
    """Register a function of the test data under `name`."""

    def register(fn: Callable[[Data], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(fn, with_views(sql) if sql else None)
        return fn

    return register


def with_views(sql: str) -> str:
    """Prefix the SQL with the shared views it mentions, in dependency order."""
    wanted = _closure(sql)
    views = [f"{name} AS ({VIEWS[name].strip()})" for name in VIEWS if name in wanted]
    body = sql.strip()
    if not views:
        return body
    if re.match(r"with\b", body, re.I):
        return "WITH " + ",\n".join(views) + ",\n" + body[4:].strip()
    return "WITH " + ",\n".join(views) + "\n" + body


def _closure(sql: str) -> set[str]:
    found: set[str] = set()
    todo = [sql]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in (words & VIEWS.keys()) - found:
            found.add(name)
            todo.append(VIEWS[name])
    return found

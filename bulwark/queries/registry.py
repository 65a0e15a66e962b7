"""Query registry."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from bulwark.queries import views


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def with_views(sql: str) -> str:
    """Prefix the SQL with the fixture views it names, directly or through other views."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bv_\w+", text):
            if name in views.SQL and name not in needed:
                visit(views.SQL[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql.strip()
    body = sql.strip()
    ctes = ",\n".join(f"{n} AS ({views.SQL[n].strip()})" for n in needed)
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {ctes},\n{body[len('WITH RECURSIVE'):].strip()}"
    if body.upper().startswith("WITH"):
        return f"WITH {ctes},\n{body[len('WITH'):].strip()}"
    return f"WITH {ctes}\n{body}"


def query(name: str, sql: str | None = None):
    """Register `fn(spark, sf_dir) -> DataFrame`, with DuckDB SQL giving the same rows if there is some."""

    def register(fn):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(name, fn, with_views(sql) if sql else None)
        return fn

    return register

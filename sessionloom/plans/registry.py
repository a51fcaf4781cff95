"""Queries by name, each with the SQL that must give the same rows, and the common table expressions they share."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
VIEWS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of (spark, sf_dir); views named in the SQL are put before it."""

    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return f

    return add


def view(name: str, sql: str) -> None:
    VIEWS[name] = sql.strip()


def with_views(sql: str) -> str:
    needed: list[str] = []

    def visit(text: str) -> None:
        for word in re.findall(r"[a-z_0-9]+", text):
            if word in VIEWS and word not in needed:
                visit(VIEWS[word])
                if word not in needed:
                    needed.append(word)

    visit(sql)
    heads = ", ".join(f"{n} as (\n{VIEWS[n]})" for n in needed)
    return (f"with {heads}\n" if heads else "") + sql.strip()


def r(x: str, digits: int = 6) -> str:
    return f"(round({x}, {digits}) + 0)"

"""Named query registry: each entry pairs a Spark plan with its DuckDB oracle text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from turnstone.sources.tables import EMPLOYEES_SQL


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None  # None → rows-only check (fitted / iterative operators)
    ops: tuple[str, ...] = ()


REGISTRY: dict[str, Query] = {}


def register(name: str, oracle: str | None = None, ops: tuple[str, ...] = ()):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, oracle, ops)
        return fn
    return deco


def with_ctes(*ctes: str, body: str) -> str:
    """``WITH employees AS (...), other AS (...) <body>``."""
    return "WITH " + ",\n".join(ctes) + "\n" + body


def on_employees(body: str, *more_ctes: str) -> str:
    return with_ctes(EMPLOYEES_SQL, *more_ctes, body=body)

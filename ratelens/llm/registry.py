"""Registry of the subpackage's queries: Spark builder plus DuckDB SQL where SQL can express the operator."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

BUILDERS: dict[str, Builder] = {}
SQL: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if key in BUILDERS:
            raise KeyError(f"duplicate query key {key}")
        BUILDERS[key] = fn
        if sql:
            SQL[key] = sql
        return fn
    return deco


def load_all() -> tuple[dict[str, Builder], dict[str, str]]:
    from . import queries, queries_repair  # noqa: F401  (register)
    return BUILDERS, SQL

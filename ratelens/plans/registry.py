"""Registry of named queries: Spark builder + optional DuckDB oracle SQL."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    key: str
    build: Builder
    sql: str | None
    check: str  # X exact, R rounded 6 dp, P rows-only


QUERIES: dict[str, Entry] = {}


def query(key: str, sql: str | None = None, check: str = "X"):
    def deco(fn: Builder) -> Builder:
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = Entry(key, fn, sql, check if sql else "P")
        return fn
    return deco


def round_doubles(df: DataFrame, dp: int = 6) -> DataFrame:
    """Round every floating column so engines' float noise cannot differ."""
    cols = []
    for name, t in df.dtypes:
        if t in ("double", "float"):
            cols.append(F.round(F.col(name).cast("double"), dp).alias(name))
        else:
            cols.append(F.col(name))
    return df.select(*cols)


def load_all() -> dict[str, Entry]:
    # import for side effects: each module registers its queries
    from . import (  # noqa: F401
        churn_queries,
        source_queries,
        eda_queries,
        rfm_queries,
        recommend_queries,
        cluster_queries,
        ml_queries,
    )
    return QUERIES

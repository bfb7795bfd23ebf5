"""Descriptive summaries of a table."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import CUSTOMER, DATE, MOVIE, RATING
from .rank import exact_percentiles

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def shape(df: DataFrame) -> DataFrame:
    """A1: (n_rows, n_columns)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("int").alias("n_columns"))


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in NUMERIC or t.startswith("decimal")]


def describe_long(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A2: pandas ``describe`` in long form, one row per column:
    column, count, mean, std (sample), min, p25, p50, p75, max.

    Count, mean, deviation and extremes come from one plain aggregation whose
    single row is unpivoted; the quartiles are exact with linear interpolation
    (``summary()`` would approximate), from value counts in long form.
    """
    cols = list(cols or numeric_columns(df))
    v = {c: F.col(c).cast("double") for c in cols}
    one = df.agg(*[F.struct(F.lit(c).alias("column"), F.count(x).alias("count"), F.avg(x).alias("mean"),
                            F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max")).alias(f"_{i}")
                   for i, (c, x) in enumerate(v.items())])
    basic = one.select(F.inline(F.array(*[f"_{i}" for i in range(len(cols))])))
    counts = None
    for c in cols:
        own = df.groupBy(F.col(c).cast("double").alias("value")).agg(F.count(F.lit(1)).alias("_n")) \
            .select(F.lit(c).alias("column"), "value", "_n")
        counts = own if counts is None else counts.unionByName(own)
    q = exact_percentiles(counts, "value", [0.25, 0.5, 0.75], by=["column"], weight="_n")
    return basic.join(F.broadcast(q), "column", "left").select(  # one row per column
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def date_range(df: DataFrame, col: str = DATE) -> DataFrame:
    """A3."""
    return df.agg(F.min(col).alias("min_date"), F.max(col).alias("max_date"))


def value_counts(df: DataFrame, col: str = RATING, n: int = 10) -> DataFrame:
    """A4: most frequent values (ties by value), top n."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc(col)).limit(n))


def head(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """L1: first n rows in a deterministic order (top-n, not a full sort)."""
    return df.orderBy(*order).limit(n)


def corpus_totals(ratings: DataFrame) -> DataFrame:
    """Ratings, distinct users, distinct items."""
    return ratings.agg(
        F.count(F.lit(1)).alias("n_ratings"),
        F.count_distinct(CUSTOMER).alias("n_users"),
        F.count_distinct(MOVIE).alias("n_items"),
    )

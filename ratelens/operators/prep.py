"""Projection / filter operators on the ratings log."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import calendar_columns
from ..schemas import CUSTOMER, DATE, MOVIE, RATING, RATING_KEYS


def require_columns(df: DataFrame, cols) -> DataFrame:
    """Schema-only check (no job); ValueError lists what is missing."""
    missing = sorted(set(cols) - set(df.columns))
    if missing:
        raise ValueError(f"ratings need the missing columns {missing}")
    return df


def normalise(df: DataFrame) -> DataFrame:
    """P3 + P4: DATE-typed date, truncated int rating, no null keys."""
    require_columns(df, RATING_KEYS)
    d = F.col(DATE)
    if dict(df.dtypes)[DATE] not in ("date",):
        d = F.to_date(d)
    return (
        df.withColumn(DATE, d)
        .withColumn(RATING, F.col(RATING).cast("double").cast("int"))
        .dropna(subset=RATING_KEYS)
    )


def add_calendar(df: DataFrame, date_col: str = DATE) -> DataFrame:
    """Year, month, day_of_week (Monday = 0)."""
    return df.withColumns(calendar_columns(date_col))


def enrich(ratings: DataFrame, titles: DataFrame) -> DataFrame:
    """J1 + P1: ratings left-joined to the catalogue, then calendar columns.

    No broadcast hint: the catalogue is one row per item, and adaptive
    execution turns the join into a broadcast only when the measured size of
    that side is under the threshold; otherwise it stays a sort-merge join.
    """
    return add_calendar(ratings.join(titles, MOVIE, "left"))


def resolve_reference_date(df: DataFrame, raw=None) -> Column:
    """Explicit date, or the max rating date when null/''/'null'/'none'.

    The max is a scalar subquery, evaluated once, not a driver round-trip.
    """
    if raw is None or (isinstance(raw, str) and raw.strip().lower() in {"", "null", "none"}):
        return df.select(F.max(DATE)).scalar()
    if isinstance(raw, (_dt.date, _dt.datetime)):
        raw = raw.isoformat()[:10]
    return F.lit(str(raw)).cast("date")


def label_window(df: DataFrame, feat_end: Column, reference: Column) -> DataFrame:
    """Rows in [feat_end, reference], both ends included."""
    return df.filter((F.col(DATE) >= feat_end) & (F.col(DATE) <= reference))


def select_features(df: DataFrame, cols, keys=(CUSTOMER, "churned")) -> DataFrame:
    """Pick and order feature columns; unknown names raise."""
    unknown = sorted(set(cols) - set(df.columns))
    if unknown:
        raise ValueError(f"no features are called {unknown}")
    return df.select(*keys, *cols)

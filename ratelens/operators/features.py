"""Per-user and per-item feature tables (C1, C2, A8-A14) and scaling.

Each table is ONE ``groupBy`` with conditional aggregates: a single shuffle
on the entity key, with partial (map-side) aggregation, so a hot user or item
costs one partial row per map task, never a hot reducer holding raw rows.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import safe_div
from ..schemas import CUSTOMER, DATE, MOVIE, RATING


def _keep(cond: Column | None, c: Column) -> Column:
    return c if cond is None else F.when(cond, c)


def user_feature_aggs(cond: Column | None = None) -> list[Column]:
    """Aggregates of C1 over rows where ``cond`` holds (all rows if None).

    rating_std: sample std, 0 for a single rating (N3).
    most_common_rating: mode, lowest rating on ties (N7); -1 when no rows.
    date_range_days: whole days between first and last rating.
    """
    r = _keep(cond, F.col(RATING))
    d = _keep(cond, F.col(DATE))
    n = F.count(r)
    return [
        n.alias("rating_count"),
        F.avg(r).alias("rating_mean"),
        F.coalesce(F.stddev_samp(r), F.lit(0.0)).alias("rating_std"),
        F.coalesce(F.mode(r, True), F.lit(-1)).cast("int").alias("most_common_rating"),
        safe_div(F.count(_keep(cond, F.when(F.col(RATING) == 5, F.lit(1)))), n).alias("five_star_pct"),
        F.coalesce(F.datediff(F.max(d), F.min(d)), F.lit(0)).cast("int").alias("date_range_days"),
    ]


def user_features(ratings: DataFrame) -> DataFrame:
    """customer_id, rating_count, rating_mean, rating_std,
    most_common_rating, five_star_pct, date_range_days."""
    return ratings.groupBy(CUSTOMER).agg(*user_feature_aggs())


def mode_per_group(df: DataFrame, key: str, col: str, out: str = "most_common") -> DataFrame:
    """Most frequent value per group, lowest on ties.

    ``mode`` keeps a value->count map per group (bounded by the value domain,
    five ratings here) and combines map-side.
    """
    return df.groupBy(key).agg(F.mode(col, True).alias(out))


def g1_skewness(c: Column, n: Column) -> Column:
    """Bias-corrected sample skewness (pandas ``skew``) from the
    population g1 that Spark's ``skewness`` returns; 0 for n < 3 or constant."""
    nd = n.cast("double")
    g = F.skewness(c) * F.sqrt(nd * (nd - 1)) / (nd - 2)
    return F.when((n >= 3) & (F.stddev_pop(c) > 0), F.coalesce(g, F.lit(0.0))).otherwise(F.lit(0.0))


def movie_features(ratings: DataFrame, year_col: str = "year_of_release",
                   default_year: float = 2000.0) -> DataFrame:
    """movie_id, rating_count, rating_mean, rating_std, rating_skewness,
    year_of_release (per-item attribute, null filled with the median over
    items; 2000.0 when the log has no year column)."""
    r = F.col(RATING)
    n = F.count(r)
    aggs = [
        n.alias("rating_count"),
        F.avg(r).alias("rating_mean"),
        F.coalesce(F.stddev_samp(r), F.lit(0.0)).alias("rating_std"),
        g1_skewness(r, n).alias("rating_skewness"),
    ]
    has_year = year_col in ratings.columns
    if has_year:
        # constant per item: max == first non-null, and deterministic
        aggs.append(F.max(year_col).cast("double").alias("year_of_release"))
    items = ratings.groupBy(MOVIE).agg(*aggs)
    if not has_year:
        return items.withColumn("year_of_release", F.lit(default_year))
    return median_impute(items, "year_of_release")


def median_impute(df: DataFrame, col: str) -> DataFrame:
    """Fill nulls with the median of the column over this table's rows.

    ``median`` keeps a value->count map (distinct years: a few hundred), so
    the one-row result is a scalar subquery.
    """
    med = df.select(F.median(col)).scalar()
    return df.withColumn(col, F.coalesce(F.col(col), med))


def standardise(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(x - mean) / population std per column; constant column -> 0.

    The means and stds are one scalar subquery (a single struct), not a join.
    """
    st = df.select(F.struct(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                            *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)])).scalar()
    out = [F.col(k) for k in keep]
    for i, c in enumerate(cols):
        m, s = st.getField(f"m{i}"), st.getField(f"s{i}")
        z = F.try_divide(F.col(c) - m, s)
        out.append(F.when(s == 0, F.lit(0.0)).otherwise(F.coalesce(z, F.lit(0.0))).alias(c))
    return df.select(*out)

"""Registered queries: EDA and corpus tables."""

from __future__ import annotations

from ..fixtures import views
from ..operators.eda import corpus_totals, date_range, describe_long, head, shape, value_counts
from ..operators.prep import enrich
from ..schemas import CUSTOMER, DATE, MOVIE, RATING
from .registry import query, round_doubles
from .sqlviews import with_views

_ENRICHED = ("enriched", """SELECT r.movie_id, r.customer_id, r.rating, r.rating_date, t.year_of_release, t.title,
       CAST(year(r.rating_date) AS INTEGER) AS year, CAST(month(r.rating_date) AS INTEGER) AS month,
       CAST(isodow(r.rating_date) - 1 AS INTEGER) AS day_of_week
FROM ratings r LEFT JOIN movie_titles t ON r.movie_id = t.movie_id""")

DESCRIBE_COLS = ["movie_id", "customer_id", "rating", "year_of_release", "year", "month", "day_of_week"]


def describe_sql(src: str, cols) -> str:
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 6) AS std, round(CAST(min({c}) AS DOUBLE), 6) AS min,
       round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
       round(quantile_cont({c}, 0.75), 6) AS p75, round(CAST(max({c}) AS DOUBLE), 6) AS max FROM {src}""")
    return "\nUNION ALL\n".join(parts)


def _enriched(spark, sf_dir):
    v = views(spark, sf_dir)
    return enrich(v.ratings, v.movie_titles)


@query("eda_shape", with_views("SELECT count(*) AS n_rows, CAST(9 AS INTEGER) AS n_columns FROM enriched", _ENRICHED))
def q_eda_shape(spark, sf_dir):
    return shape(_enriched(spark, sf_dir))


@query("eda_describe", with_views(describe_sql("enriched", DESCRIBE_COLS), _ENRICHED), check="R")
def q_eda_describe(spark, sf_dir):
    return round_doubles(describe_long(_enriched(spark, sf_dir), DESCRIBE_COLS))


@query("date_range", with_views("SELECT min(rating_date) AS min_date, max(rating_date) AS max_date FROM ratings"))
def q_date_range(spark, sf_dir):
    return date_range(views(spark, sf_dir).ratings)


@query("rating_value_counts", with_views(
    "SELECT rating, count(*) AS count FROM ratings GROUP BY rating ORDER BY count DESC, rating LIMIT 10"))
def q_rating_value_counts(spark, sf_dir):
    return value_counts(views(spark, sf_dir).ratings, RATING, 10)


@query("eda_head", with_views(
    """SELECT * FROM enriched ORDER BY movie_id, customer_id, rating_date, rating LIMIT 5""", _ENRICHED))
def q_eda_head(spark, sf_dir):
    return head(_enriched(spark, sf_dir), 5, [MOVIE, CUSTOMER, DATE, RATING])


@query("corpus_totals", with_views(
    "SELECT count(*) AS n_ratings, count(DISTINCT customer_id) AS n_users, count(DISTINCT movie_id) AS n_items FROM ratings"))
def q_corpus_totals(spark, sf_dir):
    return corpus_totals(views(spark, sf_dir).ratings)

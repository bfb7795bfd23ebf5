"""Registered queries: preprocessing, churn features/labels, user features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import views
from ..operators.churn import active_users, churn_dataset, churn_rate, churn_window
from ..operators.features import mode_per_group, user_features
from ..operators.prep import normalise
from ..schemas import CUSTOMER, RATING
from .params import HORIZON_DAYS, MIN_PRIOR
from .registry import query, round_doubles
from .sqlviews import with_views

_PARAMS_CTE = ("params", f"""SELECT max(rating_date) AS ref,
       CAST(max(rating_date) - INTERVAL {HORIZON_DAYS} DAY AS DATE) AS feat_end FROM ratings""")
_FEATS_CTE = ("feats", "SELECT r.* FROM ratings r, params p WHERE r.rating_date < p.feat_end")
_LBL_CTE = ("lbl", """SELECT DISTINCT r.customer_id FROM ratings r, params p
WHERE r.rating_date >= p.feat_end AND r.rating_date <= p.ref""")


def _user_agg_ctes(src: str):
    modes = ("modes", f"""SELECT customer_id, CAST(rating AS INTEGER) AS most_common_rating FROM (
  SELECT customer_id, rating, row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, rating) AS rn
  FROM {src} GROUP BY customer_id, rating) t WHERE rn = 1""")
    uf = ("uf", f"""SELECT customer_id, count(*) AS rating_count, avg(rating) AS rating_mean,
       coalesce(stddev_samp(rating), 0) AS rating_std,
       CAST(count(*) FILTER (WHERE rating = 5) AS DOUBLE) / count(*) AS five_star_pct,
       CAST(date_diff('day', min(rating_date), max(rating_date)) AS INTEGER) AS date_range_days
FROM {src} GROUP BY customer_id""")
    return modes, uf


def _churn_pop_sql(select: str) -> str:
    modes, uf = _user_agg_ctes("feats")
    pop = ("pop", f"""SELECT uf.*, m.most_common_rating,
       CAST(CASE WHEN l.customer_id IS NULL THEN 1 ELSE 0 END AS INTEGER) AS churned
FROM uf JOIN modes m ON m.customer_id = uf.customer_id
LEFT JOIN lbl l ON l.customer_id = uf.customer_id
WHERE uf.rating_count >= {MIN_PRIOR}""")
    return with_views(select, _PARAMS_CTE, _FEATS_CTE, _LBL_CTE, modes, uf, pop)


@query("preprocess", with_views(
    "SELECT customer_id, movie_id, rating, rating_date FROM ratings "
    "WHERE customer_id IS NOT NULL AND movie_id IS NOT NULL AND rating IS NOT NULL AND rating_date IS NOT NULL"))
def q_preprocess(spark, sf_dir):
    return normalise(views(spark, sf_dir).ratings)


@query("reference_window", with_views("SELECT ref AS reference_date, feat_end AS feature_end FROM params",
                                      _PARAMS_CTE))
def q_reference_window(spark, sf_dir):
    r = views(spark, sf_dir).ratings
    ref, feat_end = churn_window(r, None, HORIZON_DAYS)
    return spark.range(1).select(ref.alias("reference_date"), feat_end.alias("feature_end"))


@query("churn_dataset", _churn_pop_sql(
    """SELECT customer_id, churned, rating_count, round(rating_mean, 6) AS rating_mean,
       round(rating_std, 6) AS rating_std, round(five_star_pct, 6) AS five_star_pct,
       date_range_days, most_common_rating FROM pop"""), check="R")
def q_churn_dataset(spark, sf_dir):
    r = normalise(views(spark, sf_dir).ratings)
    return round_doubles(churn_dataset(r, None, HORIZON_DAYS, MIN_PRIOR))


@query("churn_labels", _churn_pop_sql("SELECT customer_id, churned FROM pop"))
def q_churn_labels(spark, sf_dir):
    r = normalise(views(spark, sf_dir).ratings)
    return churn_dataset(r, None, HORIZON_DAYS, MIN_PRIOR, feature_columns=[]).select(CUSTOMER, "churned")


@query("horizon_active_users", with_views("SELECT customer_id FROM lbl", _PARAMS_CTE, _LBL_CTE))
def q_horizon_active_users(spark, sf_dir):
    return active_users(views(spark, sf_dir).ratings, None, HORIZON_DAYS)


@query("churn_rate", _churn_pop_sql(
    "SELECT round(avg(churned), 6) AS churn_rate, count(*) AS n_users FROM pop"), check="R")
def q_churn_rate(spark, sf_dir):
    r = normalise(views(spark, sf_dir).ratings)
    return round_doubles(churn_rate(churn_dataset(r, None, HORIZON_DAYS, MIN_PRIOR)))


def _all_user_sql(select: str) -> str:
    modes, uf = _user_agg_ctes("ratings")
    return with_views(select, modes, uf)


@query("user_features", _all_user_sql(
    """SELECT uf.customer_id, rating_count, round(rating_mean, 6) AS rating_mean, round(rating_std, 6) AS rating_std,
       m.most_common_rating, round(five_star_pct, 6) AS five_star_pct, date_range_days
FROM uf JOIN modes m ON m.customer_id = uf.customer_id"""), check="R")
def q_user_features(spark, sf_dir):
    return round_doubles(user_features(views(spark, sf_dir).ratings))


@query("user_mode_rating", _all_user_sql("SELECT customer_id, most_common_rating FROM modes"))
def q_user_mode_rating(spark, sf_dir):
    return mode_per_group(views(spark, sf_dir).ratings, CUSTOMER, RATING, "most_common_rating") \
        .withColumn("most_common_rating", F.col("most_common_rating").cast("int"))

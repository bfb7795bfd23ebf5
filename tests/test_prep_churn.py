"""Preprocessing and churn features (the reference's data-work unit tests)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import ratings_df
from ratelens.errors import FeatureBuildError
from ratelens.operators.churn import churn_dataset
from ratelens.operators.prep import normalise, require_columns
from ratelens.plans.jobs import ChurnParams, run_churn


def test_normalise_clean_rows(spark):
    df = spark.createDataFrame(
        [(1, 10, 4.0, "2005-01-01"), (2, 11, 5.0, "2005-02-03")],
        "customer_id long, movie_id long, rating double, rating_date string")
    out = normalise(df)
    assert out.count() == 2
    assert dict(out.dtypes)["rating_date"] == "date"
    assert dict(out.dtypes)["rating"] == "int"


def test_normalise_drops_null_keys(spark):
    df = spark.createDataFrame([(1, 10, 4, "2005-01-01"), (None, 11, 5, "2005-02-03")],
                               "customer_id long, movie_id long, rating int, rating_date string")
    assert normalise(df).count() == 1


def test_missing_columns_raise(spark):
    df = spark.createDataFrame([(1,)], "customer_id long")
    with pytest.raises(ValueError, match="missing"):
        require_columns(df, ["customer_id", "movie_id", "rating", "rating_date"])
    with pytest.raises(ValueError):
        normalise(df)


def test_churn_known_labels(spark):
    r = ratings_df(spark, [(1, 1, 4, "2006-03-01"), (1, 2, 5, "2006-04-01"),
                           (2, 3, 3, "2006-03-01"), (2, 4, 2, "2006-05-15")])
    out = {row["customer_id"]: row["churned"]
           for row in churn_dataset(r, "2006-06-01", 30, 1).collect()}
    assert out == {1: 1, 2: 0}


def test_label_window_edges(spark):
    # cutoff = 2006-05-02; a rating on the cutoff and on the reference is in
    # the label window, the day after the reference is ignored
    rows = [(u, 1, 3, "2006-01-01") for u in (1, 2, 3)]
    rows += [(1, 2, 3, "2006-05-02"), (2, 2, 3, "2006-06-01"), (3, 2, 3, "2006-06-02")]
    out = {row["customer_id"]: row["churned"]
           for row in churn_dataset(ratings_df(spark, rows), "2006-06-01", 30, 1).collect()}
    assert out == {1: 0, 2: 0, 3: 1}


def test_single_rating_user_std_and_span(spark):
    r = ratings_df(spark, [(7, 1, 4, "2006-01-01"), (8, 1, 2, "2006-01-01"), (8, 2, 4, "2006-01-11")])
    ds = churn_dataset(r, "2006-06-01", 30, 1).orderBy("customer_id").collect()
    assert ds[0]["rating_std"] == 0.0 and ds[0]["date_range_days"] == 0
    assert ds[1]["date_range_days"] == 10
    # mode tie (2 and 4) resolves to the lowest rating
    assert ds[1]["most_common_rating"] == 2


def test_reference_date_defaults_to_max(spark):
    r = ratings_df(spark, [(1, 1, 4, "2006-01-01"), (1, 2, 4, "2006-01-02"), (2, 1, 4, "2006-06-01")])
    ds = {x["customer_id"]: x["churned"] for x in churn_dataset(r, None, 30, 1).collect()}
    assert ds == {1: 1}
    ds2 = {x["customer_id"] for x in churn_dataset(r, "none", 30, 1).collect()}
    assert ds2 == {1}


def test_unknown_feature_column(spark):
    r = ratings_df(spark, [(1, 1, 4, "2006-01-01")])
    with pytest.raises(ValueError, match="no features"):
        churn_dataset(r, "2006-06-01", 30, 1, ["nope"])


def test_churn_job_empty_raises(spark):
    empty = ratings_df(spark, [])
    with pytest.raises(FeatureBuildError):
        run_churn(spark, empty, ChurnParams())


def test_churn_job_no_eligible_users_raises(spark):
    r = ratings_df(spark, [(1, 1, 4, "2006-01-01")])
    with pytest.raises(FeatureBuildError):
        run_churn(spark, r, ChurnParams(min_prior_ratings=5))

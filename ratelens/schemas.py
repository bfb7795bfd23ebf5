"""Column names and table schemas (snake_case throughout)."""

from pyspark.sql import types as T

CUSTOMER = "customer_id"
MOVIE = "movie_id"
RATING = "rating"
DATE = "rating_date"

RATING_KEYS = [CUSTOMER, MOVIE, RATING, DATE]

RATINGS = T.StructType([
    T.StructField(CUSTOMER, T.LongType()),
    T.StructField(MOVIE, T.LongType()),
    T.StructField(RATING, T.IntegerType()),
    T.StructField(DATE, T.DateType()),
])


# Engineered churn / clustering feature names, in the order the reference
# configuration lists them (fixed values).
USER_FEATURES = [
    "rating_count",
    "rating_mean",
    "rating_std",
    "five_star_pct",
    "date_range_days",
    "most_common_rating",
]

MOVIE_FEATURES = [
    "rating_count",
    "rating_mean",
    "rating_std",
    "rating_skewness",
    "year_of_release",
]

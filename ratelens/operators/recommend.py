"""Probe split, bias baseline, popularity and RMSE (J2-J5, A5-A7, A26-A27,
A31, M1, U3, W3)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import CUSTOMER, MOVIE, RATING
from ..session import store

PAIR = [CUSTOMER, MOVIE]


def probe_with_ratings(ratings: DataFrame, probe: DataFrame) -> DataFrame:
    """Ratings whose (user, item) pair is in the probe set (semi join:
    duplicate probe pairs never multiply rows)."""
    return ratings.join(probe.select(*PAIR), PAIR, "left_semi")


def train_split(ratings: DataFrame, probe: DataFrame) -> DataFrame:
    """Everything else (anti join)."""
    return ratings.join(probe.select(*PAIR), PAIR, "left_anti")


def split_by_probe(ratings: DataFrame, probe: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(J2, J3) of one pass: the ratings meet the probe once, and both parts read the marked rows that were written."""
    pairs = probe.select(*PAIR).distinct().withColumn("_probe", F.lit(1))
    marked = store(ratings.join(pairs, PAIR, "left").withColumn("_probe", F.coalesce("_probe", F.lit(0))), "_probe")
    return marked.filter("_probe = 1").select(*ratings.columns), marked.filter("_probe = 0").select(*ratings.columns)


def global_mean(train: DataFrame) -> Column:
    """A5 as a scalar subquery (evaluated once, broadcast as a literal)."""
    return train.select(F.avg(RATING)).scalar()


def entity_bias(train: DataFrame, key: str, mu: Column, out: str) -> DataFrame:
    """Per-entity mean minus the global mean."""
    return train.groupBy(key).agg((F.avg(RATING) - mu).alias(out))


@dataclass
class BiasModel:
    """M1: prediction = mu + b_u + b_i, unseen user or item -> 0 bias."""
    mu: Column
    user_bias: DataFrame
    item_bias: DataFrame

    def predict(self, pairs: DataFrame, out: str = "prediction") -> DataFrame:
        # Lookups with default; the join strategy is left to AQE (sizes).
        return (pairs.join(self.user_bias, CUSTOMER, "left").join(self.item_bias, MOVIE, "left")
                .withColumn(out, self.mu + F.coalesce(F.col("b_u"), F.lit(0.0))
                            + F.coalesce(F.col("b_i"), F.lit(0.0)))
                .drop("b_u", "b_i"))

    def written(self, spark) -> BiasModel:
        """The same model with its mean and offsets computed once, for callers that predict more than once."""
        mu = spark.range(1).select(self.mu).first()[0]
        return BiasModel(F.lit(mu).cast("double"), store(self.user_bias), store(self.item_bias))


def fit_bias(train: DataFrame) -> BiasModel:
    mu = global_mean(train)
    return BiasModel(mu, entity_bias(train, CUSTOMER, mu, "b_u"), entity_bias(train, MOVIE, mu, "b_i"))


def rmse(df: DataFrame, y: str = RATING, pred: str = "prediction", out: str = "rmse") -> DataFrame:
    """A27."""
    return df.agg(F.sqrt(F.avg((F.col(y) - F.col(pred)) ** 2)).alias(out))


def item_popularity(train: DataFrame) -> DataFrame:
    """Ratings per item."""
    return train.groupBy(MOVIE).agg(F.count(F.lit(1)).alias("n"))


def top_items(train: DataFrame, n: int = 1000) -> DataFrame:
    """The n most rated items, ties by item id (top-n, not a full sort)."""
    return item_popularity(train).orderBy(F.desc("n"), F.asc(MOVIE)).limit(n)


BROADCAST_MAX_ROWS = 100_000


def popular_item_ratings(train: DataFrame, n: int = 1000) -> DataFrame:
    """Ratings of the top-n items.  The item list is at most n rows
    (a proven bound), so it is broadcast when n <= BROADCAST_MAX_ROWS; a
    larger n leaves the strategy to the planner."""
    ids = top_items(train, n).select(MOVIE)
    return train.join(F.broadcast(ids) if n <= BROADCAST_MAX_ROWS else ids, MOVIE, "left_semi")


def rating_scale(train: DataFrame) -> DataFrame:
    """(min, max) rating: bounds for clipping latent-model output."""
    return train.agg(F.min(RATING).alias("min_rating"), F.max(RATING).alias("max_rating"))


def residuals(rows: DataFrame, predicted: DataFrame, pred: str = "prediction") -> DataFrame:
    """M5 + A32 (N11): rating - prediction, duplicate (user, item) rows summed
    (as a sparse-matrix build does)."""
    return (predicted.withColumn("residual", F.col(RATING) - F.col(pred))
            .groupBy(*PAIR).agg(F.sum("residual").alias("residual")))


def blend(base: DataFrame, knn: DataFrame, weight: float = 0.3, clip: tuple | None = None,
          base_col: str = "base", out: str = "prediction") -> DataFrame:
    """M8: base + w * knn (knn 0 when absent); optional clip."""
    j = base.join(knn, PAIR, "left").withColumn("knn", F.coalesce(F.col("knn"), F.lit(0.0)))
    p = F.col(base_col) + F.lit(weight) * F.col("knn")
    if clip:
        p = F.least(F.greatest(p, F.lit(float(clip[0]))), F.lit(float(clip[1])))
    return j.withColumn(out, p)

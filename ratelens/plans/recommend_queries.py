"""Registered queries: probe split, bias baseline, residual KNN, hybrid."""

from __future__ import annotations

from functools import cached_property
from types import SimpleNamespace

from pyspark.sql import functions as F

from ..fixtures import views
from ..operators.recommend import (blend, fit_bias, popular_item_ratings, probe_with_ratings, rating_scale,
                                   residuals, rmse, split_by_probe, top_items, train_split)
from ..operators.similarity import item_codes, item_cosine, knn_predict, residual_stats, topk_neighbours
from ..schemas import CUSTOMER, DATE, MOVIE, RATING
from ..session import cut_lineage
from .params import K_NEIGHBOURS, KNN_WEIGHT, TOP_ITEMS
from .registry import query, round_doubles
from .sqlviews import with_views

CTES = [
    ("probe_rows", """SELECT r.* FROM ratings r SEMI JOIN probe p
  ON r.customer_id = p.customer_id AND r.movie_id = p.movie_id"""),
    ("train", """SELECT r.* FROM ratings r ANTI JOIN probe p
  ON r.customer_id = p.customer_id AND r.movie_id = p.movie_id"""),
    ("mu", "SELECT avg(rating) AS mu FROM train"),
    ("ub", "SELECT customer_id, avg(rating) - (SELECT mu FROM mu) AS b_u FROM train GROUP BY customer_id"),
    ("ib", "SELECT movie_id, avg(rating) - (SELECT mu FROM mu) AS b_i FROM train GROUP BY movie_id"),
    ("bias_pred", """SELECT p.customer_id, p.movie_id, p.rating, p.rating_date,
       (SELECT mu FROM mu) + coalesce(ub.b_u, 0) + coalesce(ib.b_i, 0) AS prediction
FROM probe_rows p LEFT JOIN ub ON ub.customer_id = p.customer_id LEFT JOIN ib ON ib.movie_id = p.movie_id"""),
    ("top", f"SELECT movie_id, count(*) AS n FROM train GROUP BY movie_id ORDER BY n DESC, movie_id LIMIT {TOP_ITEMS}"),
    ("pop", "SELECT t.* FROM train t SEMI JOIN top ON t.movie_id = top.movie_id"),
    ("res", """SELECT t.customer_id, t.movie_id,
       sum(t.rating - ((SELECT mu FROM mu) + coalesce(ub.b_u, 0) + coalesce(ib.b_i, 0))) AS residual
FROM pop t LEFT JOIN ub ON ub.customer_id = t.customer_id LEFT JOIN ib ON ib.movie_id = t.movie_id
GROUP BY t.customer_id, t.movie_id"""),
    ("dots", """SELECT a.movie_id, b.movie_id AS neighbour_id, sum(a.residual * b.residual) AS dot
FROM res a JOIN res b ON a.customer_id = b.customer_id GROUP BY a.movie_id, b.movie_id"""),
    ("norms", "SELECT movie_id, sqrt(dot) AS nrm FROM dots WHERE movie_id = neighbour_id"),
    ("sim", """SELECT d.movie_id, d.neighbour_id,
       CASE WHEN n1.nrm = 0 OR n2.nrm = 0 THEN 0.0 ELSE d.dot / (n1.nrm * n2.nrm) END AS sim
FROM dots d JOIN norms n1 ON n1.movie_id = d.movie_id JOIN norms n2 ON n2.movie_id = d.neighbour_id"""),
    ("nitems", "SELECT count(DISTINCT movie_id) AS n FROM res"),
    ("slots", """SELECT movie_id, neighbour_id, sim,
       CAST(row_number() OVER (PARTITION BY movie_id ORDER BY round(sim, 9) DESC, neighbour_id) AS INTEGER) AS slot
FROM sim WHERE round(sim, 9) > 0
UNION ALL
SELECT movie_id, neighbour_id, sim,
       CAST((SELECT n FROM nitems) - count(*) OVER (PARTITION BY movie_id)
            + row_number() OVER (PARTITION BY movie_id ORDER BY round(sim, 9) DESC, neighbour_id) AS INTEGER)
FROM sim WHERE round(sim, 9) < 0"""),
    ("topk", f"SELECT * FROM slots WHERE slot <= {K_NEIGHBOURS}"),
    ("pp", "SELECT DISTINCT customer_id, movie_id FROM probe_rows"),
    ("knn_hit", """SELECT pp.customer_id, pp.movie_id,
       coalesce(sum(t.sim * r.residual) / nullif(sum(abs(t.sim)), 0), 0.0) AS knn
FROM pp JOIN topk t ON t.movie_id = pp.movie_id
JOIN res r ON r.customer_id = pp.customer_id AND r.movie_id = t.neighbour_id AND r.residual <> 0
GROUP BY pp.customer_id, pp.movie_id"""),
    ("knn", """SELECT pp.customer_id, pp.movie_id, coalesce(k.knn, 0.0) AS knn FROM pp
LEFT JOIN knn_hit k ON k.customer_id = pp.customer_id AND k.movie_id = pp.movie_id"""),
    ("hybrid", f"""SELECT b.customer_id, b.movie_id, b.rating, b.prediction AS base, k.knn,
       b.prediction + {KNN_WEIGHT} * k.knn AS prediction
FROM bias_pred b JOIN knn k ON k.customer_id = b.customer_id AND k.movie_id = b.movie_id"""),
]


def rsql(select: str) -> str:
    return with_views(select, *CTES)


class _Pipeline(SimpleNamespace):
    @cached_property
    def res(self):
        # read by the cosine self-join (twice), the item count and the KNN join
        return cut_lineage(residuals(self.pop, self.model.predict(self.pop)))


def pipeline(spark, sf_dir, method: str = "auto") -> SimpleNamespace:
    """The recommendation job's DataFrames, lazily (bias base, exact)."""
    v = views(spark, sf_dir)
    ns = _Pipeline()
    # the split is written once and read by every later stage (as the job does)
    ns.probe_rows, ns.train = split_by_probe(v.ratings, v.probe)
    ns.model = fit_bias(ns.train)
    ns.bias_pred = ns.model.predict(ns.probe_rows)
    ns.top = top_items(ns.train, TOP_ITEMS)
    ns.pop = popular_item_ratings(ns.train, TOP_ITEMS)

    def _sim(stats=None):
        return item_cosine(ns.res, method, stats)

    def _topk():
        stats = residual_stats(ns.res)
        return topk_neighbours(_sim(stats), stats[1], K_NEIGHBOURS)

    def _knn():
        return knn_predict(ns.res, _topk(), ns.probe_rows)

    def _hybrid():
        base = ns.bias_pred.select(CUSTOMER, MOVIE, RATING, F.col("prediction").alias("base"))
        return blend(base, _knn(), KNN_WEIGHT)

    ns.sim, ns.topk, ns.knn, ns.hybrid = _sim, _topk, _knn, _hybrid
    return ns


@query("probe_with_ratings", rsql("SELECT customer_id, movie_id, rating, rating_date FROM probe_rows"))
def q_probe_with_ratings(spark, sf_dir):
    v = views(spark, sf_dir)
    return probe_with_ratings(v.ratings, v.probe)


@query("train_split", rsql("SELECT customer_id, movie_id, rating, rating_date FROM train"))
def q_train_split(spark, sf_dir):
    v = views(spark, sf_dir)
    return train_split(v.ratings, v.probe)


@query("split_counts", rsql("""SELECT (SELECT count(*) FROM ratings) AS n_ratings,
       (SELECT count(*) FROM train) AS n_train, (SELECT count(*) FROM probe_rows) AS n_probe"""))
def q_split_counts(spark, sf_dir):
    p = pipeline(spark, sf_dir)
    v = views(spark, sf_dir)
    return spark.range(1).select(
        v.ratings.select(F.count(F.lit(1))).scalar().alias("n_ratings"),
        p.train.select(F.count(F.lit(1))).scalar().alias("n_train"),
        p.probe_rows.select(F.count(F.lit(1))).scalar().alias("n_probe"))


@query("global_mean_rmse", rsql(
    "SELECT round(sqrt(avg(power(rating - (SELECT mu FROM mu), 2))), 6) AS rmse FROM probe_rows"), check="R")
def q_global_mean_rmse(spark, sf_dir):
    p = pipeline(spark, sf_dir)
    return round_doubles(rmse(p.probe_rows.withColumn("prediction", p.model.mu)))


@query("user_bias", rsql("SELECT customer_id, round(b_u, 6) AS b_u FROM ub"), check="R")
def q_user_bias(spark, sf_dir):
    return round_doubles(pipeline(spark, sf_dir).model.user_bias)


@query("movie_bias", rsql("SELECT movie_id, round(b_i, 6) AS b_i FROM ib"), check="R")
def q_movie_bias(spark, sf_dir):
    return round_doubles(pipeline(spark, sf_dir).model.item_bias)


@query("bias_predictions", rsql(
    "SELECT customer_id, movie_id, rating, rating_date, round(prediction, 6) AS prediction FROM bias_pred"), check="R")
def q_bias_predictions(spark, sf_dir):
    return round_doubles(pipeline(spark, sf_dir).bias_pred.select(CUSTOMER, MOVIE, RATING, DATE, "prediction"))


@query("bias_rmse", rsql("SELECT round(sqrt(avg(power(rating - prediction, 2))), 6) AS rmse FROM bias_pred"),
       check="R")
def q_bias_rmse(spark, sf_dir):
    return round_doubles(rmse(pipeline(spark, sf_dir).bias_pred))


@query("top_items", rsql("SELECT movie_id, n FROM top"))
def q_top_items(spark, sf_dir):
    return pipeline(spark, sf_dir).top


@query("popular_item_ratings", rsql("SELECT customer_id, movie_id, rating, rating_date FROM pop"))
def q_popular_item_ratings(spark, sf_dir):
    return pipeline(spark, sf_dir).pop


@query("rating_scale", rsql("SELECT min(rating) AS min_rating, max(rating) AS max_rating FROM train"))
def q_rating_scale(spark, sf_dir):
    return rating_scale(pipeline(spark, sf_dir).train)


@query("bias_residuals", rsql("SELECT customer_id, movie_id, round(residual, 6) AS residual FROM res"), check="R")
def q_bias_residuals(spark, sf_dir):
    return round_doubles(pipeline(spark, sf_dir).res)


@query("item_codes", rsql(
    "SELECT movie_id, CAST(dense_rank() OVER (ORDER BY movie_id) - 1 AS INTEGER) AS item_code FROM (SELECT DISTINCT movie_id FROM res) t"))
def q_item_codes(spark, sf_dir):
    return item_codes(pipeline(spark, sf_dir).res)


def _sim_sql(where: str = "") -> str:
    return rsql("SELECT movie_id, count(*) AS n_neighbours, CAST(sum(CAST(round(sim, 6) * 1e6 AS BIGINT)) AS BIGINT) AS sim_micro, "
                f"round(min(sim), 6) AS sim_min, round(max(sim), 6) AS sim_max FROM sim {where} GROUP BY movie_id")


def _sim_summary(sim):
    """Per item: co-rated neighbours, sum of the similarities in millionths, extremes."""
    r = F.round(F.col("sim"), 6)
    return sim.groupBy(MOVIE).agg(F.count(F.lit(1)).alias("n_neighbours"),
                                  F.sum(F.round(r * 1e6).cast("bigint")).alias("sim_micro"),
                                  F.min(r).alias("sim_min"), F.max(r).alias("sim_max"))


@query("item_cosine", _sim_sql(), check="R")
def q_item_cosine(spark, sf_dir):
    return _sim_summary(pipeline(spark, sf_dir).sim())


@query("item_cosine_gramian", _sim_sql("WHERE round(sim, 6) <> 0"), check="R")
def q_item_cosine_gramian(spark, sf_dir):
    # the dense path keeps only non-zero cells; compare on those
    return _sim_summary(pipeline(spark, sf_dir, method="gramian").sim().filter(F.round("sim", 6) != 0))


@query("item_cosine_pairs", _sim_sql(), check="R")
def q_item_cosine_pairs(spark, sf_dir):
    """J10 on the self-join path."""
    return _sim_summary(pipeline(spark, sf_dir, method="pairs").sim())


@query("item_topk", rsql("SELECT movie_id, neighbour_id, slot, round(sim, 6) AS sim FROM topk"), check="R")
def q_item_topk(spark, sf_dir):
    return round_doubles(pipeline(spark, sf_dir).topk())


@query("knn_residual", rsql("SELECT customer_id, movie_id, round(knn, 6) AS knn FROM knn"), check="R")
def q_knn_residual(spark, sf_dir):
    return round_doubles(pipeline(spark, sf_dir).knn())


@query("hybrid_predictions", rsql(
    "SELECT customer_id, movie_id, rating, round(base, 6) AS base, round(knn, 6) AS knn, "
    "round(prediction, 6) AS prediction FROM hybrid"), check="R")
def q_hybrid_predictions(spark, sf_dir):
    return round_doubles(pipeline(spark, sf_dir).hybrid())


@query("hybrid_rmse", rsql("SELECT round(sqrt(avg(power(rating - prediction, 2))), 6) AS rmse FROM hybrid"),
       check="R")
def q_hybrid_rmse(spark, sf_dir):
    return round_doubles(rmse(pipeline(spark, sf_dir).hybrid()))


@query("model_ladder", rsql("""SELECT 'Global-mean baseline' AS model,
       round(sqrt(avg(power(rating - (SELECT mu FROM mu), 2))), 6) AS probe_rmse FROM probe_rows
UNION ALL SELECT 'User+Movie bias', round(sqrt(avg(power(rating - prediction, 2))), 6) FROM bias_pred
UNION ALL SELECT 'Bias + Item-CF residual correction', round(sqrt(avg(power(rating - prediction, 2))), 6) FROM hybrid"""),
       check="R")
def q_model_ladder(spark, sf_dir):
    p = pipeline(spark, sf_dir)
    rows = [
        rmse(p.probe_rows.withColumn("prediction", p.model.mu), out="probe_rmse")
        .select(F.lit("Global-mean baseline").alias("model"), "probe_rmse"),
        rmse(p.bias_pred, out="probe_rmse").select(F.lit("User+Movie bias").alias("model"), "probe_rmse"),
        rmse(p.hybrid(), out="probe_rmse").select(
            F.lit("Bias + Item-CF residual correction").alias("model"), "probe_rmse"),
    ]
    out = rows[0].unionByName(rows[1]).unionByName(rows[2])
    return round_doubles(out).orderBy("probe_rmse")

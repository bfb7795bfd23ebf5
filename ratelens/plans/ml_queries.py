"""Registered queries: churn split/scoring/metrics and latent-factor models."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import views
from ..functions.scalar import sigmoid
from ..operators.churn import churn_dataset
from ..operators.classify import fit_classifier, score, stratified_split
from ..operators.factorization import MF_GRID, NMF_GRID, fit_joint, fit_mf, fit_nmf, tune
from ..operators.metrics import classification_metrics, roc_auc, roc_points
from ..operators.prep import normalise
from ..operators.recommend import blend
from ..operators.similarity import item_cosine, knn_predict, residual_stats, topk_neighbours
from ..operators.recommend import popular_item_ratings, residuals
from ..schemas import CUSTOMER, MOVIE, RATING, USER_FEATURES
from ..session import cut_lineage
from .churn_queries import _churn_pop_sql
from .params import HORIZON_DAYS, K_NEIGHBOURS, KNN_WEIGHT, MIN_PRIOR, SEED, TEST_SIZE, TOP_ITEMS
from .recommend_queries import pipeline, rsql
from .registry import query, round_doubles

# Fixed linear score used to check the metric operators against SQL.
Z_SQL = "(1.5 - 0.002 * date_range_days + 0.1 * (rating_mean - 3.0))"


def _z():
    return F.lit(1.5) - F.lit(0.002) * F.col("date_range_days") + F.lit(0.1) * (F.col("rating_mean") - F.lit(3.0))


_SPLIT = f"""SELECT *, CASE WHEN row_number() OVER (PARTITION BY churned
       ORDER BY md5(concat('{SEED}:', CAST(customer_id AS VARCHAR))), customer_id)
       <= floor(count(*) OVER (PARTITION BY churned) * {TEST_SIZE} + 0.5) THEN 'test' ELSE 'train' END AS split
FROM pop"""
_SCORED = f"""SELECT customer_id, churned AS label,
       round(1.0 / (1.0 + exp(-least(greatest({Z_SQL}, -500.0), 500.0))), 9) AS score
FROM split WHERE split = 'test'"""


def _sql(select: str) -> str:
    base = _churn_pop_sql("SELECT 1")
    head, _ = base.rsplit("\nSELECT 1", 1)
    return head + f",\nsplit AS (\n{_SPLIT}\n),\nscored0 AS (\n{_SCORED}\n),\n" \
        "scored AS (SELECT *, CAST(score >= 0.5 AS INTEGER) AS predicted FROM scored0)\n" + select


def _dataset(spark, sf_dir):
    r = normalise(views(spark, sf_dir).ratings)
    return churn_dataset(r, None, HORIZON_DAYS, MIN_PRIOR, USER_FEATURES)


def _split(spark, sf_dir):
    return stratified_split(_dataset(spark, sf_dir), TEST_SIZE, SEED)


def _fixed_scored(spark, sf_dir):
    t = _split(spark, sf_dir).filter(F.col("split") == "test")
    s = t.select(CUSTOMER, F.col("churned").alias("label"), F.round(sigmoid(_z()), 9).alias("score"))
    return s.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query("stratified_split", _sql("SELECT customer_id, churned, split FROM split"))
def q_stratified_split(spark, sf_dir):
    return _split(spark, sf_dir).select(CUSTOMER, "churned", "split")


@query("sigmoid_scores", _sql("SELECT customer_id, label, round(score, 6) AS score, predicted FROM scored"),
       check="R")
def q_sigmoid_scores(spark, sf_dir):
    return round_doubles(_fixed_scored(spark, sf_dir))


@query("classification_metrics", _sql("""SELECT
  round(CAST(count(*) FILTER (WHERE label = predicted) AS DOUBLE) / count(*), 6) AS accuracy,
  round(coalesce(CAST(count(*) FILTER (WHERE label = 1 AND predicted = 1) AS DOUBLE)
        / nullif(count(*) FILTER (WHERE predicted = 1), 0), 0.0), 6) AS precision,
  round(coalesce(CAST(count(*) FILTER (WHERE label = 1 AND predicted = 1) AS DOUBLE)
        / nullif(count(*) FILTER (WHERE label = 1), 0), 0.0), 6) AS recall,
  round(coalesce(2.0 * count(*) FILTER (WHERE label = 1 AND predicted = 1)
        / nullif(count(*) FILTER (WHERE label = 1) + count(*) FILTER (WHERE predicted = 1), 0), 0.0), 6) AS f1
FROM scored"""), check="R")
def q_classification_metrics(spark, sf_dir):
    return round_doubles(classification_metrics(_fixed_scored(spark, sf_dir)))


@query("roc_points", _sql("""SELECT round(threshold, 6) AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
       round(tp / (SELECT count(*) FILTER (WHERE label = 1) FROM scored), 6) AS tpr,
       round(fp / (SELECT count(*) FILTER (WHERE label <> 1) FROM scored), 6) AS fpr
FROM (SELECT threshold, sum(pos) OVER (ORDER BY threshold DESC) AS tp, sum(neg) OVER (ORDER BY threshold DESC) AS fp
      FROM (SELECT score AS threshold, count(*) FILTER (WHERE label = 1) AS pos,
                   count(*) FILTER (WHERE label <> 1) AS neg FROM scored GROUP BY score) c) t"""), check="R")
def q_roc_points(spark, sf_dir):
    return round_doubles(roc_points(_fixed_scored(spark, sf_dir)))


@query("roc_auc", _sql("""SELECT round(1.0 - sum(pos * (cn + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) AS roc_auc
FROM (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY threshold DESC
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cn
      FROM (SELECT score AS threshold, count(*) FILTER (WHERE label = 1) AS pos,
                   count(*) FILTER (WHERE label <> 1) AS neg FROM scored GROUP BY score) c) t"""), check="R")
def q_roc_auc(spark, sf_dir):
    return round_doubles(roc_auc(_fixed_scored(spark, sf_dir)))


def _model_metrics(spark, sf_dir, kind, params):
    sp = cut_lineage(_split(spark, sf_dir))
    model = fit_classifier(sp.filter(F.col("split") == "train"), USER_FEATURES, kind, params)
    scored = cut_lineage(score(model, sp.filter(F.col("split") == "test")))
    m = classification_metrics(scored)
    auc = roc_auc(scored)
    return m.select(F.lit(kind).alias("model"), "*", auc.select("roc_auc").scalar().alias("roc_auc"))


@query("churn_lr")
def q_churn_lr(spark, sf_dir):
    """H3: logistic regression (C = 1, max_iter = 2000) held-out metrics."""
    return _model_metrics(spark, sf_dir, "logistic_regression", {"C": 1.0, "max_iter": 2000})


@query("churn_rf")
def q_churn_rf(spark, sf_dir):
    """H4: random forest (100 trees, the default depth of 30) held-out metrics."""
    return _model_metrics(spark, sf_dir, "random_forest", {"n_estimators": 100, "random_state": SEED})


@query("churn_job")
def q_churn_job(spark, sf_dir):
    """End-to-end churn job on the fixture ratings; one metrics row."""
    from .jobs import ChurnParams, run_churn
    return run_churn(spark, views(spark, sf_dir).ratings, ChurnParams()).metrics


# ---- latent-factor models ---------------------------------------------------

@query("mf_grid_search")
def q_mf_grid_search(spark, sf_dir):
    """M4: CV RMSE per grid point of the joint factor model."""
    p = pipeline(spark, sf_dir)
    return tune(p.train, False, MF_GRID, seed=SEED)[1]


def _mf(spark, sf_dir):
    p = pipeline(spark, sf_dir)
    best, _ = tune(p.train, False, MF_GRID, seed=SEED)
    return p, fit_joint(p.train, int(best["rank"]), float(best["regParam"]), int(best["maxIter"]), SEED)


@query("mf_predictions")
def q_mf_predictions(spark, sf_dir):
    """M2: tuned latent-factor predictions on the probe rows."""
    p, m = _mf(spark, sf_dir)
    return m.predict(p.probe_rows.select(CUSTOMER, MOVIE, RATING))


@query("nmf_predictions")
def q_nmf_predictions(spark, sf_dir):
    """M3: tuned non-negative factorisation predictions on the probe rows."""
    p = pipeline(spark, sf_dir)
    best, _ = tune(p.train, True, NMF_GRID, seed=SEED)
    m = fit_nmf(p.train, int(best["rank"]), float(best["regParam"]), int(best["maxIter"]), SEED)
    return m.predict(p.probe_rows.select(CUSTOMER, MOVIE, RATING))


@query("hybrid_mf_predictions")
def q_hybrid_mf_predictions(spark, sf_dir):
    """M5-M8 on the latent-factor base: residuals of the MF model on the
    popular items, cosine top-k, KNN, blend with w = 0.3."""
    p, m = _mf(spark, sf_dir)
    pop = popular_item_ratings(p.train, TOP_ITEMS)
    res = residuals(pop, m.predict(pop))
    stats = residual_stats(res)
    topk = topk_neighbours(item_cosine(res, "auto", stats), stats[1], K_NEIGHBOURS)
    knn = knn_predict(res, topk, p.probe_rows)
    base = m.predict(p.probe_rows.select(CUSTOMER, MOVIE, RATING), "base")
    return blend(base, knn, KNN_WEIGHT)


@query("model_ladder_full")
def q_model_ladder_full(spark, sf_dir):
    """Probe RMSE of every model, computed (never hard-coded)."""
    from .jobs import RecParams, run_recommendation
    return run_recommendation(spark, views(spark, sf_dir).ratings, views(spark, sf_dir).probe, RecParams()).ladder


# ---- bounds of the fitted models, computed on both sides ---------------------

_BOUNDS_SQL = """SELECT customer_id, movie_id, rating, true AS in_scale FROM probe_rows"""


def _bounded(pred, train):
    lo, hi = train.agg(F.min(RATING), F.max(RATING)).first()
    return pred.select(CUSTOMER, MOVIE, RATING, F.col("prediction").between(lo, hi).alias("in_scale"))


@query("mf_prediction_bounds", rsql(_BOUNDS_SQL))
def q_mf_prediction_bounds(spark, sf_dir):
    """M2: one prediction per probe row, inside the training scale."""
    p = pipeline(spark, sf_dir)
    return _bounded(fit_mf(p.train, seed=SEED).predict(p.probe_rows.select(CUSTOMER, MOVIE, RATING)), p.train)


@query("nmf_prediction_bounds", rsql(_BOUNDS_SQL))
def q_nmf_prediction_bounds(spark, sf_dir):
    """M3: the same for the non-negative model."""
    p = pipeline(spark, sf_dir)
    return _bounded(fit_nmf(p.train, seed=SEED).predict(p.probe_rows.select(CUSTOMER, MOVIE, RATING)), p.train)


_SOLVED_RANK, _SOLVED_REG = 4, 0.1


@query("mf_normal_equations", rsql("SELECT customer_id, count(*) AS n, true AS solved FROM train GROUP BY customer_id"))
def q_mf_normal_equations(spark, sf_dir):
    """M3's solver (unconstrained): every user's factors solve the ridge equations of the final item factors."""
    train = pipeline(spark, sf_dir).train.select(CUSTOMER, MOVIE, RATING)
    model = fit_mf(train, _SOLVED_RANK, _SOLVED_REG, 3, SEED)
    res = model.bias.predict(train, "_base").select(CUSTOMER, MOVIE, (F.col(RATING) - F.col("_base")).alias("r"))
    u = model.als.userFactors.select(F.col("id").cast("bigint").alias(CUSTOMER), F.col("features").alias("u"))
    v = model.als.itemFactors.select(F.col("id").cast("bigint").alias(MOVIE), F.col("features").alias("v"))
    rows = res.join(v, MOVIE).join(u, CUSTOMER)
    dot = sum((F.col("u")[k].cast("double") * F.col("v")[k] for k in range(_SOLVED_RANK)), F.lit(0.0))
    rows = rows.withColumn("e", F.col("r") - dot)
    n = F.count(F.lit(1))
    left = [F.sum(F.col("e") * F.col("v")[k]) - F.lit(_SOLVED_REG) * n * F.first("u")[k] for k in range(_SOLVED_RANK)]
    return rows.groupBy(CUSTOMER).agg(n.alias("n"), (F.greatest(*[F.abs(x) for x in left]) < 1e-3 * n).alias("solved"))

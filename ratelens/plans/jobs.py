"""Job compositions: ingest, EDA, churn, recommendation, clustering, RFM
(operators wired together with typed parameters; every stage is lazy until a sink or a
model fit, and the feature table is materialised once)."""

from __future__ import annotations

from dataclasses import dataclass, field
from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import FeatureBuildError
from ..functions.scalar import MOVIE_CLUSTER_NAMES, USER_CLUSTER_NAMES
from ..operators.churn import churn_dataset, require_rows
from ..operators.classify import fit_classifier, score, stratified_split
from ..operators.cluster import assign, best_k, centroids_of, fit_kmeans, kmeans_sweep, name_clusters, pca
from ..operators.dbscan import dbscan
from ..operators.eda import date_range, describe_long, head, shape, value_counts
from ..operators.factorization import MF_GRID, NMF_GRID, fit_joint, fit_nmf, tune
from ..operators.features import movie_features, standardise, user_features
from ..operators.hierarchy import ward
from ..operators.metrics import classification_metrics, roc_auc, roc_points
from ..operators.prep import enrich, normalise
from ..operators.recommend import (blend, fit_bias, popular_item_ratings, probe_with_ratings, residuals, rmse,
                                   train_split)
from ..operators.rfm import (box_stats, crosstab, crosstab_pct, rf_heatmap, rfm_base, rfm_scores, rfm_segments, rfm_with_cluster,
                             score_histogram, segment_rollup, segment_sizes)
from ..operators.silhouette import silhouette
from ..operators.similarity import item_cosine, knn_predict, residual_stats, topk_neighbours
from ..schemas import CUSTOMER, DATE, MOVIE, MOVIE_FEATURES, RATING, USER_FEATURES
from ..session import cut_lineage, prepare_session
from ..sources import tables
from .params import DBSCAN_WIDE
from ..sources.text import read_movie_titles, read_probe_sections, read_rating_sections


# ---- S11: conditional ingest -----------------------------------------------

def ingest(spark: SparkSession, paths: tables.RunPaths, raw_dir: str | None, enabled: bool = True,
           skip_if_exists: bool = False, existing: str | None = None, mode: str = "failfast",
           sample_fraction: float = 1.0, seed: int = 42) -> str:
    """Reuse an existing table, or parse the raw text (titles, sections,
    probe) into Parquet.  ``sample_fraction`` chooses rating files before any
    is read.  A JSON marker records which happened."""
    prepare_session(spark)
    target = existing or paths.ratings
    if skip_if_exists and tables.path_exists(spark, target):
        how = "reused"
    elif not enabled:
        how = "disabled"
        if not tables.path_exists(spark, target):
            raise FileNotFoundError(target)
    else:
        titles = read_movie_titles(spark, f"{raw_dir}/movie_titles.txt", mode)
        ratings = enrich(read_rating_sections(spark, f"{raw_dir}/training_set/", mode, sample_fraction, seed), titles)
        tables.write_table(ratings, paths.ratings, sort_within=[DATE])
        tables.write_table(read_probe_sections(spark, f"{raw_dir}/probe.txt", mode), paths.probe)
        target, how = paths.ratings, "ingested"
    tables.write_metrics(spark.range(1).select(F.lit(how).alias("ingest"), F.lit(target).alias("ratings")),
                         paths.marker)
    return target


# ---- H10: churn job ----------------------------------------------------------

# The defaults below equal the reference's configuration.
@dataclass
class ChurnParams:
    reference_date: str | None = None
    horizon_days: int = 180
    min_prior_ratings: int = 5
    test_size: float = 0.25
    random_state: int = 42
    feature_columns: list = field(default_factory=lambda: list(USER_FEATURES))
    model_type: str = "logistic_regression"
    model_params: dict = field(default_factory=lambda: {"C": 1.0, "max_iter": 2000})


def run_churn(spark: SparkSession, ratings: DataFrame, p: ChurnParams,
              paths: tables.RunPaths | None = None) -> SimpleNamespace:
    prepare_session(spark)
    r = require_rows(normalise(ratings), "no ratings are left after normalisation")
    ds = churn_dataset(r, p.reference_date, p.horizon_days, p.min_prior_ratings, p.feature_columns)
    ds = cut_lineage(stratified_split(ds, p.test_size, p.random_state))  # read by fit, score, write
    if ds.isEmpty():
        raise FeatureBuildError(f"nobody rated {p.min_prior_ratings} times before the feature window ended")
    model = fit_classifier(ds.filter(F.col("split") == "train"), p.feature_columns, p.model_type, p.model_params)
    scored = score(model, ds.filter(F.col("split") == "test"))
    m = classification_metrics(scored)
    metrics = m.select("*", roc_auc(scored).select("roc_auc").scalar().alias("roc_auc"))
    roc = roc_points(scored)
    if paths is not None:
        tables.write_table(r, paths.preprocessed)
        tables.write_table(ds.drop("split"), paths.dataset)
        tables.save_holdout(ds, paths.holdout)
        tables.save_model(model, paths.model)
        tables.write_metrics(metrics, paths.metrics)
        tables.write_csv(roc, paths.roc, single=False)  # one row per distinct score
    return SimpleNamespace(dataset=ds, model=model, scored=scored, metrics=metrics, roc=roc)


# ---- recommendation job ------------------------------------------------------

# Defaults and the models' display names.
@dataclass
class RecParams:
    tune_sample_n: int | None = None  # all training rows
    run_nmf: bool = True
    run_hybrid: bool = True
    knn_weight: float = 0.3
    top_items: int = 1000
    k: int = 40
    seed: int = 42
    clip_hybrid: bool = False


def run_recommendation(spark: SparkSession, ratings: DataFrame, probe: DataFrame, p: RecParams,
                       paths: tables.RunPaths | None = None) -> SimpleNamespace:
    prepare_session(spark)
    ratings = ratings.select(CUSTOMER, MOVIE, RATING, DATE)
    train = cut_lineage(train_split(ratings, probe))
    probe_rows = probe_with_ratings(ratings, probe).select(CUSTOMER, MOVIE, RATING)
    ns = SimpleNamespace(train=train, probe_rows=probe_rows)
    rows = []
    bias = fit_bias(train)
    rows.append(("Global-mean baseline", rmse(probe_rows.withColumn("prediction", bias.mu))))
    rows.append(("User+Movie bias", rmse(bias.predict(probe_rows))))
    best, ns.mf_grid = tune(train, False, MF_GRID, p.tune_sample_n, seed=p.seed)
    mf = fit_joint(train, int(best["rank"]), float(best["regParam"]), int(best["maxIter"]), p.seed)
    mf_probe = mf.predict(probe_rows)
    rows.append(("MF (biases and factors)", rmse(mf_probe)))
    if p.run_nmf:
        nbest, ns.nmf_grid = tune(train, True, NMF_GRID, p.tune_sample_n, seed=p.seed)
        nmf = fit_nmf(train, int(nbest["rank"]), float(nbest["regParam"]), int(nbest["maxIter"]), p.seed)
        rows.append(("NMF", rmse(nmf.predict(probe_rows))))
    if p.run_hybrid:
        pop = popular_item_ratings(train, p.top_items)
        res = cut_lineage(residuals(pop, mf.predict(pop)))
        stats = residual_stats(res)
        topk = topk_neighbours(item_cosine(res, "auto", stats), stats[1], p.k)
        knn = knn_predict(res, topk, probe_rows)
        base = mf.predict(probe_rows, "base")
        ns.hybrid = blend(base, knn, p.knn_weight, clip=(1.0, 5.0) if p.clip_hybrid else None)
        rows.append(("MF + Item-CF residual correction", rmse(ns.hybrid)))
    ladder = None
    for name, df in rows:
        one = df.select(F.lit(name).alias("model"), F.col("rmse").alias("probe_rmse"))
        ladder = one if ladder is None else ladder.unionByName(one)
    ns.ladder = ladder.orderBy("probe_rmse")
    if paths is not None:
        tables.write_table(train, paths.train)
        tables.write_table(probe_rows, paths.probe_rows)
        tables.save_factors(mf, paths.mf_model)
        if p.run_nmf:
            tables.save_als(nmf.als, paths.nmf_model)
        tables.write_csv(ns.ladder, paths._p("probe_rmse.csv"))
    return ns


# ---- EDA job -----------------------------------------------------------------

def run_eda(ratings: DataFrame, paths: tables.RunPaths | None = None, head_rows: int = 5) -> SimpleNamespace:
    """Shape, numeric summary, date range, rating counts and first rows."""
    prepare_session(ratings.sparkSession)
    ns = SimpleNamespace(shape=shape(ratings), describe=describe_long(ratings), dates=date_range(ratings),
                         counts=value_counts(ratings), head=head(ratings, head_rows, [CUSTOMER, MOVIE, DATE]))
    if paths is not None:
        for name, df in vars(ns).items():
            tables.write_csv(df, paths._p(f"eda_{name}.csv"))
    return ns


# ---- clustering job ------------------------------------------------------------

# The ranges of k and DBSCAN's radius and density.
@dataclass
class ClusterParams:
    user_ks: tuple = tuple(range(2, 10))
    movie_ks: tuple = tuple(range(2, 9))
    movie_eps: float = DBSCAN_WIDE[0]
    movie_min_samples: int = DBSCAN_WIDE[1]
    user_eps: float = 1.5
    user_min_samples: int = 5
    seed: int = 42


def _best_clusters(points: DataFrame, key: str, ks, names: dict, seed: int) -> tuple[DataFrame, DataFrame, int]:
    """(sweep, points with cluster and cluster_name at the best k, best k) on PC coordinates."""
    cols = [c for c in points.columns if c != key]
    sweep = kmeans_sweep(points, cols, ks, seed=seed, id_col=key)
    k = best_k(sweep)
    model, _ = fit_kmeans(points, cols, k, seed)
    return sweep, name_clusters(assign(points, cols, centroids_of(model)), names), k


def run_clustering(ratings: DataFrame, titles: DataFrame, p: ClusterParams,
                   paths: tables.RunPaths | None = None) -> SimpleNamespace:
    """User clusters, item clusters with hierarchy and DBSCAN labels and 2-D
    coordinates, and the comparison of the three item methods."""
    spark = ratings.sparkSession
    prepare_session(spark)
    cols = [c for c in user_features(ratings).columns if c != CUSTOMER]
    us = cut_lineage(standardise(user_features(ratings), cols, keep=[CUSTOMER]))
    up = cut_lineage(pca(us, cols, 3, keep=[CUSTOMER]))
    ns = SimpleNamespace()
    ns.user_sweep, users, _ = _best_clusters(up, CUSTOMER, p.user_ks, USER_CLUSTER_NAMES, p.seed)
    user_db = dbscan(up, CUSTOMER, ["pc1", "pc2", "pc3"], p.user_eps, p.user_min_samples)
    ns.users = cut_lineage(users.join(user_db.select(CUSTOMER, F.col("cluster").alias("cluster_dbscan")), CUSTOMER))

    ms = cut_lineage(standardise(movie_features(enrich(ratings, titles)), MOVIE_FEATURES, keep=[MOVIE]))
    ns.movie_sweep, km, k = _best_clusters(cut_lineage(pca(ms, MOVIE_FEATURES, 3, keep=[MOVIE])), MOVIE, p.movie_ks,
                                           MOVIE_CLUSTER_NAMES, p.seed)
    hier = ward(ms, MOVIE, MOVIE_FEATURES, k).select(MOVIE, "cluster_hierarchical")
    db = dbscan(ms, MOVIE, MOVIE_FEATURES, p.movie_eps, p.movie_min_samples).select(MOVIE, F.col("cluster").alias("cluster_dbscan"))
    flat = pca(ms, MOVIE_FEATURES, 2, keep=[MOVIE]).select(MOVIE, F.col("pc1").alias("x"), F.col("pc2").alias("y"))
    ns.movies = cut_lineage(km.select(MOVIE, "cluster", "cluster_name").join(hier, MOVIE).join(db, MOVIE).join(flat, MOVIE))

    rows = []
    for method, col in (("K-Means", "cluster"), ("Hierarchical", "cluster_hierarchical"), ("DBSCAN", "cluster_dbscan")):
        pts = ms.join(ns.movies.select(MOVIE, F.col(col).alias("_c")).filter("_c <> -1"), MOVIE)
        s = silhouette(pts, MOVIE_FEATURES, "_c", MOVIE)  # None below two clusters
        rows.append((method, pts.select("_c").distinct().count(), None if s is None else round(s, 4)))
    ns.comparison = spark.createDataFrame(rows, "method string, n_clusters bigint, silhouette double")
    if paths is not None:
        tables.write_table(ns.users, paths.user_clusters)
        tables.write_table(ns.movies, paths.movie_clusters)
        tables.write_csv(ns.comparison, paths.comparison)
    return ns


# ---- RFM job -------------------------------------------------------------------

def run_rfm(spark: SparkSession, ratings: DataFrame, reference=None,
            paths: tables.RunPaths | None = None) -> SimpleNamespace:
    """Segments with reports; cross-tabs with the clusters that a clustering run under ``paths`` has written."""
    prepare_session(spark)
    seg = cut_lineage(rfm_segments(rfm_scores(rfm_base(ratings, reference))))
    ns = SimpleNamespace(segments=seg, sizes=segment_sizes(seg), heatmap=rf_heatmap(seg), histogram=score_histogram(seg),
                         rollup=segment_rollup(seg), box=box_stats(seg, "segment", ["R", "F", "M"]))
    ns.crosstab = ns.crosstab_pct = None
    if paths is not None and tables.path_exists(spark, paths.user_clusters):
        joined = cut_lineage(rfm_with_cluster(seg, spark.read.parquet(paths.user_clusters)))
        ns.crosstab, ns.crosstab_pct = crosstab(joined, "segment", "cluster_name"), crosstab_pct(joined, "segment", "cluster_name")
    if paths is not None:
        tables.write_table(seg, paths._p("rfm_segments.parquet"))
        for name in ("sizes", "heatmap", "histogram", "rollup", "box", "crosstab", "crosstab_pct"):
            if getattr(ns, name) is not None:
                tables.write_csv(getattr(ns, name), paths._p(f"rfm_{name}.csv"))
    return ns

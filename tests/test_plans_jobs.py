"""Plan shape (no Python UDF in SQL-checked plans, no single-task global
window in rank plans, semi/anti joins) and job/sink behaviour."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001, ratings_df
from ratelens.plans.jobs import ChurnParams, ingest, run_churn
from ratelens.plans.registry import load_all
from ratelens.sources import tables

ENTRIES = load_all()
# keys that legitimately run NumPy inside Arrow batches (mapInPandas)
ARROW_KEYS = {"item_cosine", "item_cosine_gramian", "item_topk", "knn_residual", "hybrid_predictions",
              "hybrid_rmse", "model_ladder", "silhouette_euclidean"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(k for k, e in ENTRIES.items() if e.sql))
def test_no_python_udf_no_cross_join(spark, key):
    p = _plan(ENTRIES[key].build(spark, SF001))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    if key not in ARROW_KEYS:
        assert "MapInPandas" not in p and "PythonUDF" not in p


def test_rank_plan_has_no_unpartitioned_window(spark):
    """With more rows than one range holds, every ranking window is
    partitioned by the range id (one range of <= ROWS_PER_BUCKET rows may be
    a single task by design)."""
    from ratelens.operators import rank
    old = rank.ROWS_PER_BUCKET
    rank.ROWS_PER_BUCKET = 20
    try:
        p = _plan(ENTRIES["rfm_scores"].build(spark, SF001))
    finally:
        rank.ROWS_PER_BUCKET = old
    wins = [ln for ln in p.splitlines() if "Window [" in ln and "_off" not in ln]
    assert wins
    for line in wins:
        part = line.rsplit("], [", 1)
        assert "_bkt" in line, line


def test_probe_split_uses_semi_and_anti(spark):
    assert "LeftSemi" in _plan(ENTRIES["probe_with_ratings"].build(spark, SF001))
    assert "LeftAnti" in _plan(ENTRIES["train_split"].build(spark, SF001))


def test_churn_filter_reaches_scan(spark):
    from ratelens.operators.churn import churn_dataset
    r = spark.read.parquet(os.path.join(SF001, "orders.parquet"))
    df = churn_dataset(
        r.select(F.col("o_custkey").alias("customer_id"), F.col("o_orderkey").alias("movie_id"),
                 F.lit(3).alias("rating"), F.col("o_orderdate").cast("date").alias("rating_date")),
        "1998-01-01", 180, 1)
    p = _plan(df)
    assert "PushedFilters" in p and "o_orderdate" in p
    assert "LessThan(o_orderdate" in p  # date <= reference, pushed to the scan
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in p  # pruned


def test_churn_job_writes_artifacts(spark, tmp_dir):
    from ratelens.fixtures import views
    paths = tables.RunPaths(tmp_dir, "run1")
    res = run_churn(spark, views(spark, SF001).ratings, ChurnParams(), paths)
    m = res.metrics.first()
    assert 0.0 <= m.accuracy <= 1.0
    for p in (paths.dataset, paths.holdout, paths.model, paths.metrics, paths.roc):
        assert os.path.exists(p), p
    js = [f for f in os.listdir(paths.metrics) if f.endswith(".json")]
    assert set(json.loads(open(os.path.join(paths.metrics, js[0])).read())) >= {"accuracy", "roc_auc"}


def test_ingest_reuse_and_run(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(os.path.join(raw, "training_set"))
    with open(os.path.join(raw, "movie_titles.txt"), "w") as f:
        f.write("1,2001,Alpha, the\n2,NULL,Beta\n")
    for m in (1, 2):
        with open(os.path.join(raw, "training_set", f"mv_{m:07d}.txt"), "w") as f:
            f.write(f"{m}:\n10,3,2005-01-01\n11,4,2005-01-02\n")
    with open(os.path.join(raw, "probe.txt"), "w") as f:
        f.write("1:\n10\n")
    paths = tables.RunPaths(tmp_dir, "r")
    target = ingest(spark, paths, raw)
    t = spark.read.parquet(target)
    assert t.count() == 4 and {"title", "year", "day_of_week"} <= set(t.columns)
    assert spark.read.parquet(paths.probe).count() == 1
    assert ingest(spark, paths, None, skip_if_exists=True) == target
    with pytest.raises(FileNotFoundError):
        ingest(spark, tables.RunPaths(tmp_dir, "none"), None, enabled=False)


def test_clustering_then_rfm_job_read_back(spark, tmp_dir):
    from ratelens.fixtures import views
    from ratelens.plans.jobs import ClusterParams, run_clustering, run_eda, run_rfm
    from ratelens.sources.tables import RunPaths
    v = views(spark, SF001)
    paths = RunPaths(tmp_dir, "run1")
    ratings = v.ratings
    c = run_clustering(ratings, v.movie_titles, ClusterParams(user_ks=(2, 3), movie_ks=(2, 3)), paths)
    users, movies = spark.read.parquet(paths.user_clusters), spark.read.parquet(paths.movie_clusters)
    assert users.count() == ratings.select("customer_id").distinct().count()
    assert movies.count() == ratings.select("movie_id").distinct().count()
    assert {"cluster", "cluster_name", "cluster_hierarchical", "cluster_dbscan", "x", "y"} <= set(movies.columns)
    comparison = spark.read.option("header", True).csv(paths.comparison)
    assert sorted(r.method for r in comparison.collect()) == ["DBSCAN", "Hierarchical", "K-Means"]
    assert c.user_sweep.count() == 2
    r = run_rfm(spark, ratings, None, paths)
    seg = spark.read.parquet(paths._p("rfm_segments.parquet"))
    assert seg.count() == users.count() and r.crosstab is not None
    total = spark.read.option("header", True).csv(paths._p("rfm_crosstab.csv")).filter("segment = 'All' and cluster_name = 'All'")
    assert int(total.first()["n"]) == users.count()
    run_eda(ratings, paths)
    assert int(spark.read.option("header", True).csv(paths._p("eda_shape.csv")).first()["n_rows"]) == ratings.count()


def test_recommendation_job_writes_tables_and_models(spark, tmp_dir):
    from ratelens.fixtures import views
    from ratelens.plans import jobs
    from ratelens.sources.tables import RunPaths, load_als, load_factors
    v = views(spark, SF001)
    paths = RunPaths(tmp_dir, "run2")
    old = jobs.MF_GRID, jobs.NMF_GRID
    jobs.MF_GRID = jobs.NMF_GRID = {"rank": [3], "regParam": [0.05], "maxIter": [2]}
    try:
        ns = jobs.run_recommendation(spark, v.ratings, v.probe, jobs.RecParams(run_hybrid=False), paths)
    finally:
        jobs.MF_GRID, jobs.NMF_GRID = old
    assert spark.read.parquet(paths.train).count() == ns.train.count()
    assert spark.read.parquet(paths.probe_rows).count() == ns.probe_rows.count()
    assert load_als(paths.nmf_model).rank == 3
    mf = load_factors(spark, paths.mf_model)
    assert {len(r.factors) for r in mf.items.collect()} == {3} and mf.predict(ns.probe_rows).count() == ns.probe_rows.count()

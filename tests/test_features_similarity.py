"""Feature aggregates (N3, N4, N7) and the residual KNN."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import ratings_df
from ratelens.operators.features import movie_features, user_features
from ratelens.operators.similarity import item_cosine, knn_predict, topk_neighbours


def test_skewness_matches_pandas(spark):
    vals = {1: [1, 2, 2, 5, 3, 3, 1], 2: [4], 3: [4, 5], 4: [3, 3, 3, 3], 5: [1, 5, 5, 5, 2, 4]}
    rows = [(c, m, r, "2005-01-01") for m, rs in vals.items() for c, r in enumerate(rs)]
    got = {r.movie_id: r.rating_skewness for r in movie_features(ratings_df(spark, rows)).collect()}
    for m, rs in vals.items():
        s = pd.Series(rs, dtype=float).skew()
        want = 0.0 if (len(rs) < 3 or np.isnan(s)) else s
        assert got[m] == pytest.approx(want, abs=1e-9)
    assert got[1] == pytest.approx(0.97402, abs=1e-5)


def test_user_features_mode_and_std(spark):
    r = ratings_df(spark, [(1, 1, 2, "2005-01-01"), (1, 2, 4, "2005-01-03"), (2, 1, 5, "2005-01-01")])
    got = {x.customer_id: x for x in user_features(r).collect()}
    assert got[1].most_common_rating == 2 and got[1].date_range_days == 2
    assert got[2].rating_std == 0.0 and got[2].five_star_pct == 1.0


def test_movie_year_median_over_items(spark):
    df = spark.createDataFrame(
        [(1, 1, 3, None, None), (1, 2, 3, 1990, None), (1, 3, 3, 2000, None), (2, 4, 3, 2010, None)],
        "customer_id long, movie_id long, rating int, year_of_release int, x int")
    got = {r.movie_id: r.year_of_release for r in movie_features(df).collect()}
    assert got[1] == 2000.0  # median of items' years (1990, 2000, 2010), not of rows


def _dense_mirror(res_rows, probe_pairs, k):
    """NumPy mirror of the reference: dense residual matrix, cosine,
    argsort(-sim)[:k] (stable, ties by item), masked weighted mean."""
    users = sorted({u for u, _, _ in res_rows})
    items = sorted({i for _, i, _ in res_rows})
    ui, ii = {u: n for n, u in enumerate(users)}, {i: n for n, i in enumerate(items)}
    R = np.zeros((len(users), len(items)))
    for u, i, v in res_rows:
        R[ui[u], ii[i]] += v
    norms = np.sqrt((R * R).sum(0))
    with np.errstate(invalid="ignore", divide="ignore"):
        S = (R.T @ R) / np.outer(norms, norms)
    S = np.nan_to_num(S)
    S = np.round(S, 9)
    out = {}
    for u, i in probe_pairs:
        if u not in ui or i not in ii:
            out[(u, i)] = 0.0
            continue
        row = S[ii[i]]
        order = sorted(range(len(items)), key=lambda j: (-row[j], items[j]))
        nb = [j for j in order[:k] if row[j] != 0]
        r = R[ui[u], nb]
        s = row[nb]
        m = r != 0
        out[(u, i)] = float((s[m] * r[m]).sum() / np.abs(s[m]).sum()) if m.any() and np.abs(s[m]).sum() else 0.0
    return out


@pytest.mark.parametrize("n_items,k", [(3, 40), (8, 5), (30, 40), (50, 10)])
def test_slot_rule_equals_dense_mirror(spark, n_items, k):
    rnd = random.Random(n_items)
    res = []
    for u in range(40):
        for i in rnd.sample(range(n_items), rnd.randint(1, n_items)):
            res.append((u, 100 + i, round(rnd.uniform(-2, 2), 3)))
    res.append((0, 100, 0.5))  # a duplicate pair: summed
    probe = [(u, 100 + i) for u in range(0, 45, 3) for i in range(0, n_items + 2, 2)]
    rdf = spark.createDataFrame(res, "customer_id long, movie_id long, residual double") \
        .groupBy("customer_id", "movie_id").agg(F.sum("residual").alias("residual"))
    n = rdf.select("movie_id").distinct().count()
    topk = topk_neighbours(item_cosine(rdf, "pairs"), n, k)
    pdf = spark.createDataFrame(probe, "customer_id long, movie_id long")
    got = {(r.customer_id, r.movie_id): r.knn for r in knn_predict(rdf, topk, pdf).collect()}
    want = _dense_mirror(res, probe, k)
    assert set(got) == set(want)
    for key, v in want.items():
        assert got[key] == pytest.approx(v, abs=1e-7), key


def test_pairs_and_gramian_paths_agree(spark):
    rnd = random.Random(5)
    res = [(u, i, rnd.uniform(-1, 1)) for u in range(300) for i in rnd.sample(range(60), 12)]
    rdf = spark.createDataFrame(res, "customer_id long, movie_id long, residual double")
    a = {(r.movie_id, r.neighbour_id): r.sim for r in item_cosine(rdf, "pairs").collect()}
    b = {(r.movie_id, r.neighbour_id): r.sim for r in item_cosine(rdf, "gramian").collect()}
    assert set(a) == set(b)
    assert all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_gramian_heavy_and_light_users(spark):
    """Heavy users (dense product) and light users (bincount) together."""
    from ratelens.operators import similarity
    rnd = random.Random(9)
    res = [(u, i, rnd.uniform(-1, 1)) for u in range(40) for i in rnd.sample(range(80), 70 if u < 5 else 4)]
    rdf = spark.createDataFrame(res, "customer_id long, movie_id long, residual double")
    old = similarity.HEAVY_DEGREE
    similarity.HEAVY_DEGREE = 20
    try:
        b = {(r.movie_id, r.neighbour_id): r.sim for r in item_cosine(rdf, "gramian").collect()}
    finally:
        similarity.HEAVY_DEGREE = old
    a = {(r.movie_id, r.neighbour_id): r.sim for r in item_cosine(rdf, "pairs").collect()}
    assert set(a) == set(b) and all(abs(a[k] - b[k]) < 1e-9 for k in a)


@pytest.mark.parametrize("tile", [7, 32])
def test_tiled_product_equals_the_pairs(spark, monkeypatch, tile):
    """Items over several tiles, light and heavy users, a user with a third of the entries, small Arrow batches."""
    from ratelens.operators import similarity
    monkeypatch.setattr(similarity, "HEAVY_DEGREE", 10)
    rnd = random.Random(tile)
    res = [(u, 3 * i, rnd.uniform(-1, 1)) for u in range(60) for i in rnd.sample(range(90), 80 if u < 4 else 6)]
    rdf = spark.createDataFrame(res, "customer_id long, movie_id long, residual double")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        b = {(r.movie_id, r.neighbour_id): r.sim for r in item_cosine(rdf, "gramian", tile=tile).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    a = {(r.movie_id, r.neighbour_id): r.sim for r in item_cosine(rdf, "pairs").collect()}
    assert set(a) == set(b) and all(abs(a[k] - b[k]) < 1e-9 for k in a)
    none = rdf.limit(0)
    assert item_cosine(none).collect() == []


def test_twenty_thousand_items(spark):
    """Ten tiles a side; no limit on the number of items."""
    from ratelens.operators import similarity
    df = spark.range(400).selectExpr("id AS customer_id", "explode(sequence(0, 99)) AS k").selectExpr(
        "customer_id", "pmod(xxhash64(customer_id, k), 20000) AS movie_id", "(pmod(hash(customer_id, k), 2000) - 1000) / 1000D AS residual")
    df = df.unionByName(spark.range(20000).selectExpr("1000 + id AS customer_id", "id AS movie_id", "0.5D AS residual")).dropDuplicates(["customer_id", "movie_id"])
    assert similarity.residual_stats(df)[1] == 20000
    a, b = item_cosine(df, "pairs").cache(), item_cosine(df).cache()
    assert a.count() == b.count()
    off = a.join(b.withColumnRenamed("sim", "other"), ["movie_id", "neighbour_id"], "full").filter(
        "other IS NULL OR sim IS NULL OR abs(sim - other) > 1e-9").count()
    assert off == 0

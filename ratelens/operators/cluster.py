"""Clustering on feature tables.

PCA uses ``pyspark.ml`` (distributed covariance).  K-means runs all its models
-- every k and every restart -- in shared scans: the centres of all models
are sent to the tasks, one pass sums the points of every (model, cluster) in
the tasks, and the few sums come back.  A fit of 80 models reads the points
once per iteration, not 80 times.  Assignment and inertia against given
centroids are plain column expressions, so they are exact and SQL-checkable.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import label_map
from ..session import cut_lineage


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out).transform(df)


def pca(df: DataFrame, cols: Sequence[str], k: int, keep: Sequence[str] = (), prefix: str = "pc") -> DataFrame:
    """C4: project centred columns on the top-k principal components.

    Signs are fixed so the largest-magnitude loading of each component is
    positive (the SVD sign is otherwise arbitrary).  Output: keep + pc1..pck.
    """
    x = assemble(df, cols)
    model = PCA(k=k, inputCol="features", outputCol="_pca").fit(x)
    pcs = model.pc.toArray()  # d x k, tiny
    signs = [1.0 if pcs[abs(pcs[:, j]).argmax(), j] >= 0 else -1.0 for j in range(k)]
    arr = vector_to_array(F.col("_pca"))
    return model.transform(x).select(*keep, *[(arr[j] * F.lit(signs[j])).alias(f"{prefix}{j + 1}")
                                            for j in range(k)])


#: points that starting centres are drawn from (a hash share of all points, in one order everywhere)
START_SAMPLE = 20_000


def _plus_plus(points: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means++ starts: each next centre is the best of a few points drawn by squared distance."""
    centres = [points[rng.integers(len(points))]]
    near = ((points - centres[0]) ** 2).sum(axis=1)
    for _ in range(1, k):
        if near.sum() <= 0:  # fewer places than centres
            centres.append(points[rng.integers(len(points))])
            continue
        tries = rng.choice(len(points), size=2 + int(math.log(k)), p=near / near.sum())
        after = np.minimum(near[None], ((points[None] - points[tries][:, None]) ** 2).sum(axis=2))
        best = int(after.sum(axis=1).argmin())
        centres.append(points[tries[best]])
        near = after[best]
    return np.array(centres)


def _sums(points: DataFrame, models: Sequence[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """(sums, counts, inertia) of every model's clusters in one pass over ``points`` (one array column)."""
    d = models[0].shape[1]
    starts = np.cumsum([0, *map(len, models)])
    centres = np.concatenate(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centres), d + 2))
        for b in batches:
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            d2 = np.maximum((x ** 2).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres ** 2).sum(axis=1)[None], 0)
            for a, z in zip(starts, starts[1:]):
                own = d2[:, a:z].argmin(axis=1)
                for k in range(d):
                    total[a:z, k] += np.bincount(own, weights=x[:, k], minlength=z - a)
                total[a:z, d] += np.bincount(own, minlength=z - a)
                total[a:z, d + 1] += np.bincount(own, weights=((x - centres[a + own]) ** 2).sum(axis=1), minlength=z - a)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(centres))), pa.array(list(total), pa.list_(pa.float64()))], names=["centre", "v"])

    rows = (points.mapInArrow(run, "centre bigint, v array<double>").groupBy("centre")
            .agg(*[F.sum(F.col("v")[k]).alias(f"v{k}") for k in range(d + 2)]).collect())  # one row per centre of the models
    total = np.zeros((len(centres), d + 2))
    for r in rows:
        total[r[0]] = r[1:]
    return [(total[a:z, :d], total[a:z, d], float(total[a:z, d + 1].sum())) for a, z in zip(starts, starts[1:])]


def fit_many(df: DataFrame, cols: Sequence[str], ks: Sequence[int], seed: int = 42, n_init: int = 10,
             max_iter: int = 300, tol: float = 1e-4) -> dict[int, tuple[np.ndarray, float]]:
    """K -> (centres, inertia) of the best of ``n_init`` restarts; all models share every scan.

    A model is done when its centres move by at most ``tol`` of the mean
    variance; a cluster that loses its points keeps its centre.
    """
    points = cut_lineage(df.select(F.array(*[F.col(c).cast("double") for c in cols]).alias("x")))
    n, *spread = points.agg(F.count(F.lit(1)), *[F.var_pop(F.col("x")[k]) for k in range(len(cols))]).first()
    share = min(1.0, START_SAMPLE / max(n, 1))
    sample = points.filter(F.crc32(F.array_join(F.col("x").cast("array<string>"), ",")) < int(share * 2 ** 32)).orderBy("x").limit(4 * START_SAMPLE).collect()
    base = np.array([r.x for r in sample], float).reshape(-1, len(cols))
    if not len(base):
        raise ValueError("k-means needs points")
    models = [(k, i) for k in ks for i in range(n_init)]
    centres = {m: _plus_plus(base, m[0], np.random.default_rng([seed + m[1], m[0]])) for m in models}
    stop = tol * float(np.mean([v or 0.0 for v in spread]))
    moving = list(models)
    for _ in range(max_iter):
        found = _sums(points, [centres[m] for m in moving])
        still = []
        for m, (total, count, _) in zip(moving, found):
            new = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres[m])
            if ((new - centres[m]) ** 2).sum() > stop:
                still.append(m)
            centres[m] = new
        moving = still
        if not moving:
            break
    cost = {m: c for m, (_, _, c) in zip(models, _sums(points, [centres[m] for m in models]))}
    best = {k: min(((k, i) for i in range(n_init)), key=lambda m: (cost[m], m[1])) for k in ks}
    return {k: (centres[m], cost[m]) for k, m in best.items()}


@dataclass
class Centres:
    """A fitted k-means model."""

    values: np.ndarray

    def clusterCenters(self) -> list[np.ndarray]:  # as pyspark.ml names it
        return list(self.values)


def fit_kmeans(df: DataFrame, cols: Sequence[str], k: int, seed: int = 42, n_init: int = 10,
               max_iter: int = 300):
    """(model, inertia) of the best of ``n_init`` restarts."""
    values, cost = fit_many(df, cols, [k], seed, n_init, max_iter)[k]
    return Centres(values), cost


def centroids_of(model) -> list[list[float]]:
    return [list(map(float, c)) for c in model.clusterCenters()]


def sq_dist(cols: Sequence[str], centre: Sequence[float]) -> Column:
    e = F.lit(0.0)
    for c, v in zip(cols, centre):
        e = e + (F.col(c) - F.lit(float(v))) ** 2
    return e


def assign(df: DataFrame, cols: Sequence[str], centroids: Sequence[Sequence[float]],
           out: str = "cluster", dist_out: str | None = None) -> DataFrame:
    """Nearest centroid; distances compared at 9 dp, ties to the lower
    id.  Centroids are k literals (bounded), no join."""
    ds = [F.round(sq_dist(cols, c), 9) for c in centroids]
    best = F.least(*ds) if len(ds) > 1 else ds[0]
    lab = F.lit(None).cast("int")
    for j in reversed(range(len(ds))):
        lab = F.when(ds[j] == best, F.lit(j)).otherwise(lab)
    res = df.withColumn(out, lab)
    if dist_out:
        res = res.withColumn(dist_out, F.least(*[sq_dist(cols, c) for c in centroids])
                             if len(centroids) > 1 else sq_dist(cols, centroids[0]))
    return res


def inertia(df: DataFrame, cols: Sequence[str], centroids) -> DataFrame:
    """Sum of squared distances to the nearest centroid."""
    return assign(df, cols, centroids, dist_out="_d").agg(F.sum("_d").alias("inertia"))


def name_clusters(df: DataFrame, names: dict, col: str = "cluster", out: str = "cluster_name") -> DataFrame:
    """C11/F10."""
    return df.withColumn(out, label_map(col, names))


def kmeans_sweep(df: DataFrame, cols: Sequence[str], ks: Sequence[int], seed: int = 42, n_init: int = 10,
                 silhouette_sample: int | None = None, id_col: str = "id") -> DataFrame:
    """K, inertia, silhouette for each k: shared scans for all fits, one pass of distances for all silhouettes."""
    from .silhouette import silhouettes
    base = cut_lineage(df)
    fits = fit_many(base, cols, ks, seed, n_init)
    labelled = base
    for k in ks:
        labelled = assign(labelled, cols, fits[k][0].tolist(), out=f"_k{k}")
    scores = silhouettes(labelled, cols, [f"_k{k}" for k in ks], id_col, silhouette_sample, seed)
    rows = [(int(k), float(fits[k][1]), s) for k, s in zip(ks, scores)]
    return df.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


def best_k(sweep: DataFrame) -> int:
    """Arg-max silhouette, first (smallest) k on ties."""
    r = sweep.agg(F.max_by("k", F.struct(F.col("silhouette"), -F.col("k"))).alias("k")).first()
    return int(r["k"])


def bisecting(df: DataFrame, cols: Sequence[str], k: int, seed: int = 42, out: str = "cluster_hierarchical",
              n_init: int = 3) -> DataFrame:
    """C12 (re-aimed): divisive hierarchy cut at k clusters.

    Start with one cluster; k-1 times split the cluster with the largest
    within-cluster sum of squares by a 2-means fit over its members only.
    New ids are assigned in split order.  (Spark's BisectingKMeans leaves
    empty leaves on some inputs, so the loop is explicit.)  Labels are
    checkpointed after each split.
    """
    lab = cut_lineage(df.withColumn(out, F.lit(0)))
    for new_id in range(1, k):
        sse = lab.groupBy(out).agg(
            F.count(F.lit(1)).alias("_n"),
            sum((F.sum(F.col(c) ** 2) - F.sum(c) ** 2 / F.count(F.lit(1))) for c in cols).alias("_sse"))
        top = sse.filter(F.col("_n") >= 2).orderBy(F.desc("_sse"), F.asc(out)).first()
        if top is None:
            break
        victim = top[out]
        members = lab.filter(F.col(out) == victim)
        model, _ = fit_kmeans(members, cols, 2, seed, n_init)
        cents = centroids_of(model)
        side = assign(lab, cols, cents, out="_side")
        lab = cut_lineage(side.withColumn(out, F.when((F.col(out) == victim) & (F.col("_side") == 1),
                                                      F.lit(new_id)).otherwise(F.col(out))).drop("_side"))
    return lab

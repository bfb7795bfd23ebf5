"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (every row computed,
nothing collected to the driver).  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "parse_rating_sections",
    "enrich_ratings",
    "eda_describe",
    "churn_dataset",
    "user_features",
    "movie_features",
    "rfm_segments",
    "rfm_box_stats",
    "bias_rmse",
    "item_cosine",
    "hybrid_rmse",
    "kmeans_assign",
    "dbscan_items_narrow",
    "silhouette_euclidean",
    "roc_auc",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "1"))
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]
    from ratelens.plans.registry import load_all
    from ratelens.session import build_session

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus))
    entries = load_all()
    keys = only or HEADLINE
    # warm-up: JVM, parquet footers, codegen caches
    entries["date_range"].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for k in keys:
        best = None
        for _ in range(reps):
            spark.catalog.clearCache()  # no query may reuse another's persisted data
            t0 = time.perf_counter()
            entries[k].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[k] = round(best, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()

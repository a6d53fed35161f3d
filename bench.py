"""Times the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import time

from eigenlake.registry.queries import QUERIES
from eigenlake.session import local_session

# Preprocess + PCA, TSQR SVD, scoring, exact metrics, clustering, graphs, planes, series.
HEADLINE = [
    "exact_split",
    "preprocessor_state",
    "pca_scores",
    "svd_scores",
    "score_new_rows",
    "reconstruction_curve",
    "wide_svd_spectrum",
    "wide_covariance",
    "silhouette",
    "adjusted_rand_index",
    "kmeans_fit",
    "clustering_sweep",
    "feature_histograms",
    "feature_density",
    "correlation_matrix",
    "nearest_neighbours",
    "joint_affinities",
    "rank_sweep",
    "series_denoise",
    "compare_job",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    # Start the JVM code paths and Python workers on the smallest query before timing.
    QUERIES["gram_matrix"](spark, sf_dir).collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        spark.catalog.clearCache()
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

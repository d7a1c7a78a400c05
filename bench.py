"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from stayline.plans import catalog
from stayline.session import build_session, scratch_scope

HEADLINE = (
    "customer_view",
    "latest_order_per_customer",
    "etl_processed",
    "etl_summary",
    "request_validation",
    "exact_stratified_split",
    "stratified_folds",
    "ranking_metrics",
    "classification_report",
    "version_evaluations",
    "nearest_cluster",
    "segment_profiles",
    "silhouette_samples",
    "internal_cluster_metrics",
    "external_cluster_metrics",
    "profile_cards",
    "prediction_responses",
    "document_chunks",
    "tfidf_document_norms",
    "tfidf_search",
    "dense_search",
    "population_stability",
    "kolmogorov_smirnov",
    "feature_statistics",
    "concept_drift_7d",
    "online_feature_lookup",
    "latency_by_day",
    "stream_latency",
    "gbt_scores",
    "kmeans_segments",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    catalog.QUERIES["latest_order_per_customer"](spark, sf).count()  # start the JVM and workers
    seconds = {}
    for name in HEADLINE:
        with scratch_scope(spark):
            start = time.time()
            catalog.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.time() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()

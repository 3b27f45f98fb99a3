"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""
from __future__ import annotations

import json
import os
import sys
import time

from lumenframe.plans import registry
from lumenframe.session import build_session

HEADLINE = ["group_sum", "summary_stats", "top_k_per_group", "encode_first_seen", "running_sum", "covariance_matrix", "clean_review",
            "extract_issues", "extract_issues_phrases", "phrase_counts", "lexicon_sentiment", "build_vocab", "tfidf_top_terms",
            "encode_sequences", "class_mean_vectors", "nearest", "roc_curve", "spearman_test", "kendall_test", "degree_centrality",
            "connected_components", "closeness", "clustering", "pagerank", "score_selections", "soft_kmeans_step", "linear_regression",
            "cluster_top_terms", "truncated_svd"]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    book = registry()
    names = sys.argv[1:] or HEADLINE
    spark.read.parquet(f"{folder}/lineitem.parquet").count()     # start the JVM and the workers before timing
    times = {}
    for name in names:
        start = time.perf_counter()
        book[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline queries, total time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()

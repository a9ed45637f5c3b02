"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from readflow.plans.catalog import QUERIES
from readflow.session import scratch

HEADLINE = [
    "top_pages", "time_since_last", "explode_history", "normalize_interactions", "users_per_item", "popularity_deciles",
    "recency_curve", "clean_text", "tfidf_terms", "tfidf_hashed", "dense_index", "interaction_matrix", "user_feature_vectors",
    "compact_items", "recommend_top_n", "recommend_unseen", "recommend_batch", "content_recommend", "als_recommend",
    "metrics_by_k", "score_ks", "interaction_distribution", "item_gini",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("user_id").count().write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        with scratch(spark):
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()

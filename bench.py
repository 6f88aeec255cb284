"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  data folder (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_QUERIES comma-separated names, or "all" (default: the headline list)
"""

from __future__ import annotations

import json
import os
import sys
import time

from tapeloom.plans import PLANS
from tapeloom.session import local_session

HEADLINE = [
    "matched_pairs",
    "paired_gap_changes",
    "titles_left_join_prices",
    "rank_by_title",
    "random_order",
    "adjacent_pairs",
    "sampled_pairs",
    "decile_bucket",
    "decile_bucket_pooled",
    "return_target",
    "decay_impute",
    "ffill",
    "sliding_sequences",
    "multimodal_sequences",
    "bag_asof_fill",
    "news_target_join",
    "daily_mean_sentiment",
    "daily_mean_embedding",
    "daily_text",
    "quantiles_by_group",
    "price_percentile_trim",
    "tercile_bins",
    "minmax_per_symbol",
    "standardize",
    "outlier_flag",
    "token_vocabulary",
    "token_pack",
    "stratified_split",
    "project_embedding",
    "attention_pool",
    "euclidean_distance",
    "pair_regression",
    "sequence_forecast",
    "backtest_long_only",
    "roc_auc_documents",
    "f1_threshold_sweep",
    "clean_text",
    "page_text",
    "chunked_write",
    "stream_ingest",
]


def run(build, spark, sf_dir: str) -> float:
    """Seconds to compute all rows and columns, without sending them to the driver."""
    start = time.perf_counter()
    build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    chosen = os.environ.get("BENCH_QUERIES")
    names = HEADLINE if not chosen else list(PLANS) if chosen == "all" else chosen.split(",")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    warmed = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warmed):
        run(PLANS["matched_pairs"].build, spark, warmed)
    cold, warm = {}, {}
    for name in names:
        cold[name] = round(run(PLANS[name].build, spark, sf_dir), 3)
        warm[name] = round(run(PLANS[name].build, spark, sf_dir), 3)
        print(f"{name}: {cold[name]} s, again {warm[name]} s", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of second runs",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "first_runs": cold,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

"""Times the headline queries and prints one JSON line.

    BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default 8)
    BENCH_QUERIES  comma-separated names instead of the headline ones, or "all"
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from delaykit.plans import CATALOG  # noqa: E402
from delaykit.session import local_session  # noqa: E402

HEADLINE = (
    "clean_delay_cause", "airport_summary", "monthly_trends", "carrier_airport_month_lookup",
    "dataset_kpis", "flight_lookup_mode", "enrich_origin_dest", "target_encode_join",
    "lookup_enrich_default", "expected_delay_grid", "training_features", "serving_features",
    "correlation_matrix", "anova_by_carrier", "delay_distribution", "temporal_split", "cv_mae",
    "density_histogram_50", "score_batch", "score_gated", "history_dedup",
    "extract_flight_mentions", "pca_fit", "clean_flights", "carrier_summary", "airport_lookup",
    "availability_features", "composite_delay_risk", "factor_significance", "top_bottom_ttest",
    "stratified_sample", "regression_metrics", "extract_route", "flatten_itineraries", "train_linear",
    "train_airport_forest",
)


def timed(spark, name: str, path: str) -> float:
    start = time.perf_counter()
    df = CATALOG[name].plain(spark, path)
    # Every row and column is produced, nothing is kept.
    df.write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - start
    spark.catalog.clearCache()
    return round(seconds, 3)


def main() -> None:
    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(CATALOG) if chosen == "all" else [n for n in chosen.split(",") if n] or list(HEADLINE)
    spark = local_session(cpus, "delaykit-bench")
    # Class loading and code generation of the first query are not the query's.
    timed(spark, "monthly_trends", path)
    seconds = {n: timed(spark, n, path) for n in names}
    size = re.search(r"sf([\d.]+)", path)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(size.group(1).rstrip(".")) if size else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

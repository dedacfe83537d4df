"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the number of cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
import warnings

from certiscope.plans.queries import QUERIES
from certiscope.session import cores_from_env, local_session

HEADLINE = [
    "latest_per_key", "class_balance", "missing_profile", "correlation_matrix", "crosstab_pct", "csv_scan",
    "stratified_sample_quota", "stratified_folds", "per_year_sample", "scale_numeric", "build_feature_matrix",
    "roc_auc", "average_precision", "roc_curve", "model_comparison", "calibration_curve", "mcnemar",
    "bootstrap_auc", "topk_budget", "impact_uplift", "fairness_by_group", "threshold_sweep", "group_threshold",
    "city_table", "district_summary", "enrich_left_join", "incremental_load", "logistic_fit", "forest_fit",
]


def main() -> None:
    warnings.simplefilter("ignore")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = cores_from_env()
    spark = local_session("bench", cores, partitions=int(cores) if cores.isdigit() else 8, memory="16g")
    QUERIES["class_balance"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start-up
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cores": cores,
    }))


if __name__ == "__main__":
    main()

"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query runs ``$BENCH_RUNS`` times (default 2) after one warm-up of the session; the median counts.
Results go to the no-op sink, so every row is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from fieldglass.checks.registry import QUERIES  # noqa: E402
from fieldglass.session import local_session  # noqa: E402

HEADLINE = [
    "profile_columns_lineitem",
    "profile_columns_documents",
    "missing_profile",
    "approx_distinct_profile",
    "duplicate_rows",
    "drop_duplicates",
    "summary_stats",
    "boxplot_outliers",
    "impute_mean",
    "string_index",
    "string_index_many_labels",
    "scale_standard",
    "corr_pearson",
    "corr_pearson_many_pairs",
    "corr_spearman",
    "corr_kendall_lineitem",
    "corr_matrix",
    "multi_target_selection",
    "impute_ffill",
    "interpolate_time",
    "lags_by_user",
    "rolling_stats",
    "ts_feature_table",
    "lookback_sequences",
    "chronological_split",
    "artifact_catalog_latest",
    "calibration_sample",
    "union_by_name_widen",
    "run_etl",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    wanted = sys.argv[1:] or HEADLINE
    spark = local_session(cores, partitions=int(cores) if cores.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["row_count"](spark, sf_dir).collect()
    times: dict[str, float] = {}
    for name in wanted:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken), 3)
        print(name, [round(t, 2) for t in taken], file=sys.stderr, flush=True)
    result = {
        "metric": "total_headline_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf_dir.rsplit("sf", 1)[-1]) if "sf" in sf_dir else None,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()

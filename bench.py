"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) is the folder of parquet tables, BENCH_CPUS the number
of local cores, BENCH_QUERIES an optional comma-separated list of query keys.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

HEADLINE = [
    "t1_within_anchor_window",
    "t2_pivot_agg",
    "t3_asof_backward",
    "t4_rolling_range_agg",
    "t4_rolling_range_agg_hot_keys",
    "t5_rolling_rows_median",
    "t7_running_max",
    "t7_running_max_hot_keys",
    "t8_sessionize",
    "t11_pick_row",
    "t13_first_onset_per_level",
    "t14_code_flag",
    "t17_normalize_units",
    "c1_urine_first_day",
    "c3_vent_durations",
    "c5_vitals_first_day",
    "c6_gcs_first_day",
    "c9_oasis_score",
    "c12_urine_stats",
    "c14_creatinine_baseline_median",
    "c16_aki_stages",
    "c24_running_anemia",
    "d1_admission_demographics",
    "d2_ccs_primary_distribution",
    "l4_merge_labels_aki",
    "l5_label_distribution_anemia",
    "l7_acquired_stage_onsets_aki",
    "l10_positive_onsets_pi",
    "s3_write_bucketed",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    keys = chosen.split(",") if chosen else HEADLINE

    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("wardframe-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from wardframe.checks.all_queries import QUERIES

    def run(key: str) -> float:
        start = time.perf_counter()
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run(keys[0])  # JVM and parquet reader warm up
    seconds = {key: round(run(key), 3) for key in keys}
    print(
        json.dumps(
            {
                "metric": "wardframe_headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

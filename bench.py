"""Times headline queries on the tables in $BENCH_SF_DIR and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from panelwave.workload.catalog import QUERIES

# One or more queries per phase: ingest, audits, description, segments, models, evaluation.
HEADLINE = (
    "write_read_periods",
    "missing_invalid_audit",
    "key_audit",
    "cross_period_keys",
    "funnel_by_group",
    "coverage",
    "sample_md5",
    "summary_global",
    "summary_by_period",
    "composition_by_period",
    "tail_concentration",
    "pearson_long",
    "histogram_log",
    "error_table",
    "high_band_diagnosis",
    "silhouette_fixed",
    "hygiene_counts",
    "household_missing",
    "household_funnel",
    "household_checks",
    "household_summary",
    "household_clusters",
    "household_selection",
    "household_final_test",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("panelwave-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    times: dict[str, float] = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )


if __name__ == "__main__":
    main()

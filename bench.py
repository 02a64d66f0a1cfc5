"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the input folder and BENCH_CPUS the local cores. The stored inputs (trips and
the processed table) are built first and timed as entries of their own.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import DataFrame, SparkSession

from waitspark.registry import QUERIES, common

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "processed",
    "iqr_filter",
    "iqr_report",
    "join_weather",
    "join_zones",
    "time_anomaly_filter",
    "weather_dedupe",
    "encode_weather",
    "hourly_trend",
    "monthly_trend",
    "avg_wait_by_zone",
    "top10_zones",
    "histogram",
    "correlation_matrix",
    "describe_target",
    "quartiles",
    "standardize",
    "compare_models",
    "error_density",
    "html_rows",
    "weather_ingest",
    "write_read_roundtrip",
    "gbt_predict",
    "mlp_predict",
]


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("waitspark-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}

    def timed(name, work) -> None:
        start = time.perf_counter()
        work()
        times[name] = round(time.perf_counter() - start, 3)

    timed("store_trips", lambda: common.trips(spark, FOLDER))
    timed("store_processed", lambda: common.processed(spark, FOLDER))
    for name in HEADLINE:
        timed(name, lambda: run(QUERIES[name](spark, FOLDER)))
    scale = re.search(r"sf([0-9.]+)", FOLDER)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS`` the timed
runs per query after one warm-up; the least of them counts.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import SparkSession

from strata.plans.registered import REGISTERED

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

HEADLINE = (
    "transaccion_enriquecida",
    "enrich_step1",
    "enrich_step3",
    "enrich_hot_keys",
    "broadcast_equals_shuffle",
    "quality_transaccion",
    "quality_report",
    "lenient_int_cast_amounts",
    "step_metrics",
    "integrity_check",
    "match_report",
    "sample_rows",
    "raw_fact_roundtrip",
    "landing_partitioned",
    "dynamic_partition_overwrite",
    "gold_partitioned_write",
    "csv_export_roundtrip",
    "document_export_verify",
    "stages_gold",
)
# Timed once more besides, and not part of the total, so that totals of rounds compare.
OTHERS = (
    "landing_avro_roundtrip",
    "avro_fact_roundtrip",
    "employer_as_of",
    "gold_cube",
    "merged_metrics",
    "document_export_content",
    "landing_stream",
)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("strata-bench")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(CPUS))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(spark: SparkSession, name: str) -> float:
    start = time.perf_counter()
    REGISTERED[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = session()
    timings = {}
    for name in HEADLINE:
        seconds(spark, name)
        timings[name] = round(min(seconds(spark, name) for _ in range(RUNS)), 3)
    others = {}
    for name in OTHERS:
        seconds(spark, name)
        others[name] = round(seconds(spark, name), 3)
    found = re.search(r"sf([0-9.]+)", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "others": others,
                "sf": float(found.group(1)) if found else SF_DIR,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

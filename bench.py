"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the local threads. Each
query is planned and run in full (every row and column is produced and thrown
away) BENCH_RUNS times; the fastest counts. The first query is run once before
the clock starts, so that the start of the JVM is not charged to it.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from workload.queries import QUERIES

HEADLINE = (
    "q07_match_or_create",
    "q08_allocate_ids",
    "q10_remap_fk",
    "q14_semi_children",
    "q15_anti_existing",
    "q16_dedupe_subset",
    "q17_remap_list",
    "q18_remap_list_strict",
    "q19_frame_difference",
    "q22_free_names",
    "q25_user_relationship",
    "q28_contacts",
    "q29_tag_applications",
    "q30_orders_cascade",
    "q30_invoice_items",
    "q33_subscriptions",
    "q36_actions",
    "q37_custom_fields",
)


def timed(spark: SparkSession, name: str, folder: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("regraft-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    timed(spark, HEADLINE[0], folder)
    seconds = {}
    for name in HEADLINE:
        seconds[name] = round(min(timed(spark, name, folder) for _ in range(runs)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

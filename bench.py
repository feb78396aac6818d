"""Headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]: one JSON line of seconds."""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from pyspark.sql import SparkSession

from ledgerloom.plans.queries import QUERIES

HEADLINE = ["clean_placing", "policy_tokens", "p1_amount_tiers", "p1_substring", "p1_single", "p1_combo", "p1_claims", "p2_policy_hits", "p3_name_pairs", "p3_cumulative", "matrix_match"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/orders.parquet").count()  # the session's start isn't a query's time
    seconds = {}
    for name in HEADLINE:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    spark.stop()
    print(json.dumps({"metric": "headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": Path(sf_dir).name}))


if __name__ == "__main__":
    main()

"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from ambrel.plans import catalogue

NAMES = ["recommendation_prior", "contract_issues", "line_order_contiguity", "broken_references", "latest_event", "trait_pivot", "enrich_overlay", "scd2_versions", "nest_children", "within_group_auc", "keyword_rules", "l1_similarity"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in NAMES:
        times = []
        for _ in range(2):  # the first run compiles
            began = time.time()
            catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.time() - began)
        seconds[name] = round(min(times), 3)
    print(json.dumps({"metric": "headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": sf_dir.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()

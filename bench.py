"""Headline queries, timed on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from touchgrid.catalog import all_queries

HEADLINE = (
    "rep_scorecard_alltime", "rep_weekly_trend", "multi_window_scorecard", "rep_account_drilldown",
    "owned_account_coverage", "account_deal_status", "meeting_account_map", "meeting_new_flags",
    "recording_verification", "company_crosswalk", "call_groups", "meeting_facts", "activity_addresses",
    "email_clusters", "text_shingles", "link_table", "upsert_latest", "email_facts", "text_families_lsh",
    "text_families_exact", "nearest_representative",
)
#: Queries under this many seconds run again, and their warm median is reported too.
AGAIN_UNDER, WARM_RUNS = 15.0, 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", str(max(8, int(cpus) if cpus.isdigit() else 8)))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "5g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()

    def seconds(name: str) -> float:
        start = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.time() - start, 3)

    # The JVM's start belongs to no query.
    spark.range(1000).groupBy(F.col("id") % 7).count().write.format("noop").mode("overwrite").save()
    times = {name: seconds(name) for name in names}
    warm = {name: median(seconds(name) for _ in range(WARM_RUNS)) for name in names if times[name] < AGAIN_UNDER}
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "warm_median": warm, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

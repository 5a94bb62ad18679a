"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the cores. Each figure is the
median of three warm runs; applying one delivery is timed once per fresh delivery.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import functions as F

from lamina import registry
from lamina.plans import batch_run
from lamina.session import build_session, fresh_folder
from lamina.sources import event_feed
from lamina.sources.store import Store

HEADLINE = (
    "gold_daily_full", "gold_hourly_full", "gold_hourly_for_batch", "gold_daily_for_batch", "silver_fact_current",
    "silver_clean", "quarantine_by_reason", "row_accounting", "dim_users_scd2", "serving_upsert_hourly",
    "delivery_mismatches", "column_profile",
)
# What writes tables or measures all layers is timed once and left out of the sum.
ONCE = (
    "bronze_ingest", "batch_ledger", "export_hourly_roundtrip", "export_daily_roundtrip", "delivery_validation",
    "layer_summary", "catalog_tables", "catalog_columns", "lineage_edges", "lineage_closure",
)
RUNS = 3


def timed(job) -> float:
    start = time.perf_counter()
    job()
    return time.perf_counter() - start


def one_delivery(spark, folder: str) -> list[float]:
    """Seconds for each of three daily deliveries on a store that holds everything before them."""
    store = Store(spark, fresh_folder(spark, "bench"))
    days = [f"batch_2024-01-{d}" for d in (20, 21, 22)]
    feed = event_feed.deliveries(event_feed.events(spark, folder), "day").where(F.col("batch_id") <= days[-1])
    before = F.when(F.col("batch_id") < days[0], F.lit("batch_2024-01-19")).otherwise(F.col("batch_id"))
    batch_run.bronze.ingest(store, feed.withColumn("batch_id", before), batch_run.now())
    batch_run.apply_batch(store, "batch_2024-01-19")
    return [timed(lambda day=day: batch_run.apply_batch(store, day)) for day in days]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus,
        # The tables are so small here that the default would leave all of them to one core.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
        "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    queries = registry.queries()

    def run(name: str) -> None:
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()

    # All once before anything is timed, as the first queries also warm up the JVM.
    for name in HEADLINE:
        run(name)
    for name in HEADLINE:
        seconds[name] = round(statistics.median(timed(lambda: run(name)) for _ in range(RUNS)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    seconds["apply_one_delivery"] = round(statistics.median(one_delivery(spark, folder)), 3)
    total = round(sum(seconds.values()), 3)
    for name in ONCE:
        seconds[name] = round(timed(lambda: run(name)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    scale = Path(folder).name.removeprefix("sf")
    rows = event_feed.table(spark, folder, "events").count()
    print(json.dumps({
        "metric": "headline queries, sum of medians", "value": total, "unit": "sec",
        "queries": seconds, "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale, "cpus": int(cpus),
        "events": rows, "fact_rows_per_second": round(rows / seconds["silver_fact_current"]),
    }))


if __name__ == "__main__":
    main()

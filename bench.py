"""Timed headline queries on the shared tables; prints one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from pitwall.plans.adapters import STORED, Tables
from pitwall.plans.registry import queries

HEADLINE = (
    "dedup_event_id",
    "valid_lap_stats",
    "merge_lap_partials",
    "classification",
    "consumer_parity",
    "complete_laps",
    "checkpoint_bests",
    "splits_with_bests",
    "split_progression",
    "clean_pace",
    "gaps",
    "car_analytics",
    "running_order",
    "frames_batch",
    "neutralized_crossings",
    "crossing_times",
    "event_revision",
    "validate_source_event",
    "validate_telemetry_contract",
    "archive_summary",
    "stream_throughput",
    "retention_candidates",
    "lap_completion_stream",
    "frame_assembler",
    "live_bests",
    "stream_lap_metrics",
    "materialize_finished_races",
)


def _run(frame) -> None:
    """Evaluate every row and column without collecting them."""
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    """Run each query once after a warm-up and report seconds."""
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("pitwall-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(max(8, 2 * int(cpus.strip("*") or 8))))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "16g")
        # One machine: a local folder serves as the shared one.
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="pitwall-bench-"))
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    Tables(spark, folder)("lineitem").write.format("noop").mode("overwrite").save()
    _run(registered["valid_lap_stats"](spark, folder))
    seconds = {}
    # The event tables derived from the base tables are written once and count as a query.
    start = time.perf_counter()
    for view in STORED:
        Tables(spark, folder)(view)
    seconds["event_tables"] = round(time.perf_counter() - start, 3)
    for name in names:
        start = time.perf_counter()
        _run(registered[name](spark, folder))
        seconds[name] = round(time.perf_counter() - start, 3)
    rows = Tables(spark, folder)("lineitem").count()
    crossings = Tables(spark, folder)("timing").count()
    scale = folder.rstrip("/").rsplit("sf", 1)[-1]
    line = {
        "metric": "headline_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
        "lap_records": rows,
        "timing_events": crossings,
        "timing_events_per_second": {
            name: round(crossings / seconds[name])
            for name in (
                "complete_laps", "split_progression", "gaps", "car_analytics",
                "lap_completion_stream", "live_bests",
            )
            if name in seconds
        },
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()

"""Laps that are complete, and corrected as long as crossings of them come in."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.operators.laps import lap_aggregates, merge_lap_aggregates, whole_laps
from pitwall.streaming import runs

LAP = ["race_id", "car_id", "lap"]
PARTS = "completion/parts"
COMMITS = "completion/commits"
PART = """race_id string, car_id string, lap int, event_id string, lap_time_ms bigint,
    pit_lap boolean, _finish_valid boolean, neutralized boolean, _sector_1 bigint,
    _sector_2 bigint, _sector_3 bigint"""


def _completed(grouped: DataFrame) -> DataFrame:
    """Whole laps with a column for each sector."""
    sectors = [F.col("sectors_ms")[i].alias(f"s{i + 1}_ms") for i in range(3)]
    return whole_laps(grouped).select(
        *LAP, "event_id", "lap_time_ms", *sectors, "pit_lap", "neutralized", "valid"
    )


def lap_completion_sink(base: str, fan: int = runs.FAN) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function for crossings: what those of a trigger say of their laps is a run.

    A trigger writes its own laps only and holds no state, whatever was stored before; merged runs
    have one row a lap.  :func:`completed_laps` puts the runs together, so late sectors and
    neutralisations correct what was said before, and laps are kept for good.  A repeated batch
    replaces its run, and one that is committed is not written again.
    """

    def combined(parts: DataFrame) -> DataFrame:
        return merge_lap_aggregates(parts, ["event_id"], F.max(runs.RUN).alias(runs.RUN))

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        last, newest = runs.last_commit(spark, f"{base}/{COMMITS}")
        if batch_id <= newest:
            return
        parts = batch.groupBy(*LAP).agg(*lap_aggregates(["event_id"]))
        parts = parts.select(*T.StructType.fromDDL(PART).names)
        runs.append_run(parts, f"{base}/{PARTS}", last + 1, ["race_id"], fan, combine=combined)
        commit = spark.range(1).select(F.lit(batch_id).cast("bigint").alias("batch_id"))
        runs.append_run(commit, f"{base}/{COMMITS}", last + 1, fan=fan)

    return sink


def completed_laps(spark: SparkSession, base: str, fan: int = runs.FAN) -> DataFrame:
    """Every lap whose finish and three sectors are in, as of the newest committed trigger."""
    last = runs.last_commit(spark, f"{base}/{COMMITS}")[0]
    parts = runs.read_runs(spark, f"{base}/{PARTS}", T.StructType.fromDDL(PART), last, fan)
    return _completed(merge_lap_aggregates(parts, ["event_id"]))


def lap_completion_stream(
    timing: DataFrame, started_at: str | None = None, delay: str = "2 days"
) -> DataFrame:
    """Streaming aggregation for update mode: every lap whose finish and three sectors are in.

    A lap appears with the trigger that completes it and again with each later crossing of it, so
    late sectors and neutralisations correct what was said before; readers keep the newest row of
    a lap.  Replayed crossings change no value, and crossings without a time complete nothing.
    With ``started_at`` (a timestamp that all crossings of a race share) laps leave the state once
    races ``delay`` younger have begun; without it laps are kept for good.
    """
    keys = LAP
    if started_at is not None:
        timing = timing.withWatermark(started_at, delay)
        keys = [*LAP, started_at]
    return _completed(timing.groupBy(*keys).agg(*lap_aggregates(["event_id"])))

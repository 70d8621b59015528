"""Deduplication with a deterministic survivor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.operators.ranges import keep_first

BROKER_ORDER = ("kafka_partition", "kafka_offset")


def _order(df: DataFrame, names: Sequence[str]) -> list[Column]:
    """Columns that decide which copy stays; without any the survivor would be arbitrary."""
    known = [F.col(name) for name in names if name in df.columns]
    if not known:
        raise ValueError(f"none of the ordering columns {list(names)} is in {df.columns}")
    return known


def dedup_event_id(
    df: DataFrame, order: Sequence[str] = BROKER_ORDER, within: Sequence[str] = ()
) -> DataFrame:
    """One row per ``event_id`` (per ``within`` group): the first in broker order."""
    return keep_first(df, [*within, "event_id"], _order(df, order))


def dedup_offset(
    df: DataFrame,
    keys: Sequence[str] = ("topic", "kafka_partition", "kafka_offset"),
    order: Sequence[str] = ("kafka_timestamp",),
) -> DataFrame:
    """One receipt per broker position."""
    return keep_first(df, keys, _order(df, order))


def dedup_timing_key(
    timing: DataFrame, order: Sequence[str] = ("simulation_time_us", "event_id")
) -> DataFrame:
    """One crossing per race, car, lap and checkpoint, whatever its event id."""
    keys = ["race_id", "car_id", "lap", "checkpoint_id"]
    return keep_first(timing, keys, _order(timing, order))


def dedup_pit_stop(pitstops: DataFrame) -> DataFrame:
    """Completed stops: one key per race, car and stop number with an exit."""
    keys = ["race_id", "car_id", "stop_number"]
    return pitstops.filter(F.col("phase") == "exit").select(*keys).distinct()


def duplicate_incident_plan(plan: DataFrame) -> DataFrame:
    """Planned incidents listed more than once; the order of a collision pair is ignored."""
    pair = F.concat_ws(":", F.array_sort(F.array("car_id", "second_car_id")))
    cars = F.when(F.col("incident_type") == "collision", pair).otherwise(F.col("car_id"))
    return (
        plan.groupBy("race_id", "incident_type", "lap", cars.alias("cars"))
        .agg(F.count("*").alias("copies"))
        .filter(F.col("copies") > 1)
    )


def stream_dedup(stream: DataFrame, time_column: str, delay: str) -> DataFrame:
    """Replay-safe stream: an event id is passed once within the watermark delay."""
    return stream.withWatermark(time_column, delay).dropDuplicatesWithinWatermark(["event_id"])


def unseen_events(
    batch: DataFrame, facts: DataFrame, keys: Sequence[str] = ("event_id",)
) -> DataFrame:
    """Rows of a micro-batch whose key is not stored yet (replays older than any watermark)."""
    return batch.join(facts.select(*keys), list(keys), "left_anti")

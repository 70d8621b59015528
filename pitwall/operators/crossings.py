"""Crossings derived from samples, safety-car periods and pit-lane durations."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitwall.functions.track import track_column, track_lines
from pitwall.operators import ranges

CAR = ["race_id", "car_id"]
# Incident reasons that start and end a neutralised period.
PERIOD_START = "safety_car_started"
PERIOD_END = "safety_car_ended"
# Phases of a pit stop.
PHASES = ("entry", "service_started", "service_finished", "exit")


def crossing_times(
    samples: DataFrame,
    track: Column | Mapping[str, object],
    slice_us: int = ranges.CLOCK_SLICE_US,
) -> DataFrame:
    """When each car passed each timing line, interpolated between its distance samples.

    A step may pass several lines; the first sample of a car passes none.  ``track`` is one known
    track, or a constant track column.
    """
    lines, length = _constants(
        samples, track if isinstance(track, Column) else track_column(dict(track))
    )
    rows = ranges.with_slice(
        samples.select(*CAR, "simulation_time_us", "distance_m"), "simulation_time_us", slice_us
    )
    step = F.struct("simulation_time_us", "distance_m")
    seeds = ranges.carried(
        rows.withColumn("_sample", step),
        CAR,
        {"_sample": (F.max("_sample"), ranges.latest)},
    ).select(*CAR, ranges.SLICE, "_sample.simulation_time_us", "_sample.distance_m")
    merged = ranges.with_seeds(rows, seeds.filter(F.col("simulation_time_us").isNotNull()))
    window = ranges.slice_window(CAR, [F.col("simulation_time_us"), F.col("distance_m")])
    steps = ranges.drop_seeds(
        merged.withColumn("_from_us", F.lag("simulation_time_us").over(window)).withColumn(
            "_from_m", F.lag("distance_m").over(window)
        )
    ).filter(F.col("distance_m") > F.col("_from_m"))

    first_lap = F.greatest(F.lit(0), F.floor(F.col("_from_m") / length)).cast("int")
    last_lap = F.floor(F.col("distance_m") / length).cast("int")

    def passed(line: Column) -> Column:
        boundary = (F.col("_lap") + line["fraction"]) * length
        return (F.col("_from_m") < boundary) & (boundary <= F.col("distance_m"))

    # Lines are picked inside the array, so only those that a step passed become rows.
    crossed = (
        steps.filter(last_lap >= first_lap)
        .withColumn("_lap", F.explode(F.sequence(first_lap, last_lap)))
        .select("*", F.inline(F.filter(lines, passed)))
        .withColumn("_boundary_m", (F.col("_lap") + F.col("fraction")) * length)
    )
    share = (F.col("_boundary_m") - F.col("_from_m")) / (F.col("distance_m") - F.col("_from_m"))
    at_us = F.col("_from_us") + share * (F.col("simulation_time_us") - F.col("_from_us"))
    return crossed.select(
        *CAR,
        (F.col("_lap") + 1).alias("lap"),
        "checkpoint_id",
        "sector",
        F.bround(at_us, 0).cast("bigint").alias("crossing_us"),
    )


def _constants(samples: DataFrame, track: Column) -> tuple[Column, Column]:
    """Timing lines and length of one track, worked out once and put into the plan as values."""
    row = samples.sparkSession.range(1).select(track_lines(track), track["length_m"]).first()
    lines = F.array(
        *[F.struct(*[F.lit(v).alias(k) for k, v in line.asDict().items()]) for line in row[0]]
    )
    return lines, F.lit(row[1])


def safety_car_periods(incidents: DataFrame) -> DataFrame:
    """Neutralised periods per race; the last one may still be open (null end)."""
    marks = incidents.filter(F.col("reason").isin(PERIOD_START, PERIOD_END)).select(
        "race_id", "reason", F.col("simulation_time_us").alias("start_us")
    )
    following = Window.partitionBy("race_id").orderBy("start_us", "reason")
    return (
        marks.distinct()
        .withColumn("end_us", F.lead("start_us").over(following))
        .filter(F.col("reason") == PERIOD_START)
        .drop("reason")
    )


def neutralized_crossings(
    timing: DataFrame, incidents: DataFrame, slice_us: int = ranges.CLOCK_SLICE_US
) -> DataFrame:
    """Crossings inside a safety-car period (start included, end not).

    Periods are listed once per clock slice they touch, so the range condition is checked after an
    equi-join on race and slice; periods of a race never overlap. An open period ends behind the
    last crossing of its race.
    """
    last = timing.groupBy("race_id").agg((F.max("simulation_time_us") + 1).alias("_last"))
    periods = (
        safety_car_periods(incidents)
        .join(last, "race_id")
        .withColumn("end_us", F.coalesce("end_us", "_last"))
        .filter(F.col("end_us") > F.col("start_us"))
    )

    def slice_of(column: str) -> Column:
        return F.floor(F.col(column) / F.lit(slice_us)).cast("bigint")

    listed = periods.select(
        F.col("race_id").alias("_r"),
        F.col("start_us").alias("_from"),
        F.col("end_us").alias("_to"),
        F.explode(F.sequence(slice_of("start_us"), slice_of("end_us"))).alias("_s"),
    )
    clock = F.col("simulation_time_us")
    inside = (
        (F.col("race_id") == F.col("_r"))
        & (F.col(ranges.SLICE) == F.col("_s"))
        & (clock >= F.col("_from"))
        & (clock < F.col("_to"))
    )
    return (
        ranges.with_slice(timing, "simulation_time_us", slice_us)
        .join(listed, inside, "left_semi")
        .select(*timing.columns)
    )


def pit_lane_durations(pitstops: DataFrame) -> DataFrame:
    """Per stop: time in the pit lane, service time and fuel, from the phases seen."""

    def at(phase: str) -> Column:
        return F.max(F.when(F.col("phase") == phase, F.col("pit_stop_time_ms")))

    entered, started, finished, left = (f"_{phase}_ms" for phase in PHASES)
    stops = pitstops.groupBy(*CAR, "stop_number").agg(
        *[at(phase).alias(f"_{phase}_ms") for phase in PHASES],
        F.max("fuel_added_kg").alias("fuel_added_kg"),
    )
    return stops.select(
        *CAR,
        "stop_number",
        (F.col(left) - F.col(entered)).alias("pit_lane_ms"),
        (F.col(finished) - F.col(started)).alias("service_ms"),
        "fuel_added_kg",
        F.col(left).isNotNull().alias("completed"),
    )

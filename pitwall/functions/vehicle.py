"""Per-sample car measures and lap-time estimates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Lap-time model.
BASE_LAP_MS = 90_000
FLOOR_LAP_MS = 60_000
COMPOUND_DELTA_MS = {"soft": -250, "medium": 0, "hard": 300, "wet": 0}
# Reference car of the model, and milliseconds for each unit away from it.
REFERENCE = {"car_weight_kg": 820.0, "driver_weight_kg": 75.0, "top_speed_kmh": 330.0}
MS_PER_UNIT = {
    "car_weight_kg": 4.0, "driver_weight_kg": 3.0, "top_speed_kmh": -18.0, "tire_age_laps": 15.0,
}
# Gear and engine-speed bands.
GEAR_STEP_KMH = 42
TOP_GEAR = 8


def event_date(timestamp: Column) -> Column:
    """Calendar date of a broker timestamp (the session runs in UTC)."""
    return F.to_date(timestamp)


def telemetry_features(
    telemetry: DataFrame,
    track_length_m: float = 4309.0,
    sector_ends: tuple[float, float] = (0.34, 0.76),
) -> DataFrame:
    """Add progress, laps, sector, gear, rpm, phase and horizontal G to raw samples."""
    progress = F.pmod(F.col("distance_m") / track_length_m, F.lit(1.0))
    laps = F.greatest(F.lit(0), F.floor(F.col("distance_m") / track_length_m)).cast("int")
    speed = F.col("speed_kmh")
    sector = F.lit(1)
    for end in sector_ends:
        sector = sector + (F.col("track_progress") >= end).cast("int")
    return (
        telemetry.withColumn("track_progress", progress)
        .withColumn("laps_completed", laps)
        .withColumn("lap", F.col("laps_completed") + 1)
        .withColumn("lap_distance_m", F.col("track_progress") * track_length_m)
        .withColumn("sector", sector.cast("int"))
        .withColumn(
            "gear",
            F.greatest(
                F.lit(1), F.least(F.lit(TOP_GEAR), F.floor(speed / GEAR_STEP_KMH) + 1)
            ).cast("int"),
        )
        .withColumn(
            "rpm",
            (1000 + F.bround(speed % GEAR_STEP_KMH / GEAR_STEP_KMH * 5000, 0)).cast("int"),
        )
        .withColumn(
            "driving_phase",
            F.when(F.col("brake") > 0, "braking")
            .when(F.coalesce(F.col("g_lateral"), F.lit(0.0)) != 0, "corner")
            .otherwise("straight"),
        )
        .withColumn(
            "g_horizontal",
            F.sqrt(
                F.col("g_longitudinal") * F.col("g_longitudinal")
                + F.col("g_lateral") * F.col("g_lateral")
            ),
        )
    )


def lap_time_estimate(
    car_weight_kg: Column,
    driver_weight_kg: Column,
    top_speed_kmh: Column,
    tire_compound: Column,
    tire_age_laps: Column,
) -> Column:
    """Lap time (ms) expected from mass, top speed, compound and tyre age.

    A negative tyre age or an unknown compound has no estimate (null).
    """
    pairs = [F.lit(part) for item in COMPOUND_DELTA_MS.items() for part in item]
    compound_ms = F.try_element_at(F.create_map(*pairs), tire_compound)
    traits = {
        "car_weight_kg": car_weight_kg, "driver_weight_kg": driver_weight_kg,
        "top_speed_kmh": top_speed_kmh, "tire_age_laps": tire_age_laps,
    }
    raw = F.lit(float(BASE_LAP_MS)) + compound_ms
    for name, value in traits.items():
        raw = raw + (value - REFERENCE.get(name, 0.0)) * MS_PER_UNIT[name]
    estimate = F.greatest(F.lit(FLOOR_LAP_MS).cast("bigint"), F.bround(raw, 0).cast("bigint"))
    return F.when((tire_age_laps >= 0) & compound_ms.isNotNull(), estimate)

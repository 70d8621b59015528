"""Projections from envelopes and nested documents to flat tables and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.operators.gaps import gaps
from pitwall.operators.laps import car_lap_summary, clean_pace
from pitwall.operators.timing import sector_bests

CAR = ["race_id", "car_id"]
# Header fields a derived event takes over from its source.
INHERITED = (
    "race_id",
    "event_time",
    "produced_at",
    "simulation_time_us",
    "source_sequence",
    "track_version",
    "rules_version",
    "car_id",
)
# Columns of the bronze and silver lap tables.
BRONZE = (
    "topic",
    "kafka_timestamp",
    "kafka_partition",
    "kafka_offset",
    "event_id",
    "event_time",
    "race_id",
    "avro_envelope",
)
SILVER_LAPS = (
    "event_id",
    "race_id",
    "car_id",
    "lap",
    "lap_time_ms",
    "valid",
    "sectors_ms",
    "pit_lap",
    "race_position",
    "event_time",
    "kafka_partition",
    "kafka_offset",
)


def envelope_projection(broker: DataFrame) -> DataFrame:
    """Broker columns under their archive names, with the UTC date."""
    names = {
        "timestamp": "kafka_timestamp",
        "topic": "topic",
        "partition": "kafka_partition",
        "offset": "kafka_offset",
        "key": "event_key",
        "value": "avro_envelope",
        "headers": "kafka_headers",
    }
    chosen = [F.col(old).alias(new) for old, new in names.items() if old in broker.columns]
    return broker.select(*chosen, F.to_date("timestamp").alias("event_date_utc"))


def _from_event(decoded: DataFrame, name: str) -> Column:
    return F.col(name) if name in decoded.columns else F.col(f"evento.{name}").alias(name)


def bronze_projection(decoded: DataFrame) -> DataFrame:
    """Minimum columns shared by every topic, with the untouched envelope."""
    return decoded.select(*[_from_event(decoded, name) for name in BRONZE])


def silver_lap_projection(decoded: DataFrame) -> DataFrame:
    """Normalised lap facts."""
    return decoded.select(*[_from_event(decoded, name) for name in SILVER_LAPS])


def flatten_state_cars(state: DataFrame) -> DataFrame:
    """One row per car of every complete frame, with all telemetry fields."""
    cars = state.filter("complete").select(
        F.col("snapshot_id").alias("frame_snapshot_id"), F.explode("cars").alias("car")
    )
    return cars.select("frame_snapshot_id", "car.telemetry.*")


def flatten_analytics_cars(analytics: DataFrame) -> DataFrame:
    """One row per race, revision and car of the online summary, with the broker offset if known."""
    offset = [name for name in ("kafka_offset",) if name in analytics.columns]
    cars = analytics.select("race_id", "revision", *offset, F.explode("cars").alias("car"))
    return cars.select(
        "race_id",
        "revision",
        *offset,
        F.col("car.car_id").alias("car_id"),
        F.col("car.lap_count").alias("voltas_consumer"),
        F.col("car.best_lap_time_ms").alias("melhor_consumer_ms"),
        F.col("car.worst_lap_time_ms").alias("pior_consumer_ms"),
    )


def derived_event_identity(
    events: DataFrame, kind: str, suffix: Column, *data: Column
) -> DataFrame:
    """Derived events with a reproducible id: source id, colon, suffix."""
    inherited = [F.col(name) for name in INHERITED if name in events.columns]
    return events.select(
        *inherited,
        F.lit(kind).alias("kind"),
        F.lit(1).alias("schema_version"),
        F.concat_ws(":", F.col("event_id"), suffix).alias("event_id"),
        *data,
    )


def participants_of_race(control: DataFrame) -> DataFrame:
    """Cars of the newest control event of each race that lists any."""
    listed = control.filter(F.size("participants") > 0)
    newest = listed.groupBy("race_id").agg(
        F.max_by("participants", "source_sequence").alias("participants")
    )
    return newest.select("race_id", F.explode("participants").alias("p")).select("race_id", "p.*")


def validated_events(telemetry: DataFrame) -> DataFrame:
    """Accepted telemetry under the kind ``validated``."""
    accepted = telemetry.filter(F.size("reasons") == 0).drop("reasons")
    return accepted.withColumn("kind", F.lit("validated"))


def lap_history(
    events: DataFrame,
    kind: str,
    race_id: str | None = None,
    car_id: str | None = None,
) -> DataFrame:
    """Facts of one kind with a payload, by race, car and physical clock."""
    chosen = events.filter((F.col("kind") == kind) & (F.col("payload") != "{}"))
    if race_id is not None:
        chosen = chosen.filter(F.col("race_id") == race_id)
    if car_id is not None:
        chosen = chosen.filter(F.col("car_id") == car_id)
    return chosen.orderBy("race_id", "car_id", "simulation_time_us", "event_id")


def team_summary(
    summary: DataFrame, race_id: str | None = None, team_id: str | None = None
) -> DataFrame:
    """Online summaries of the cars of one team (of every team without a name)."""
    chosen = summary
    if race_id is not None:
        chosen = chosen.filter(F.col("race_id") == race_id)
    if team_id is not None:
        chosen = chosen.filter(F.col("team_id") == team_id)
    return chosen


def car_analytics(timing: DataFrame, laps: DataFrame, order: DataFrame) -> DataFrame:
    """Online summary of every ranked car: laps, pace, sector bests and gaps.

    All parts are keyed by race and car, so they join without a further shuffle of the facts.
    """
    bests = sector_bests(timing)
    total = F.col("s1_ms") + F.col("s2_ms") + F.col("s3_ms")
    return (
        gaps(timing, order)
        .join(car_lap_summary(laps), CAR, "left")
        .join(clean_pace(laps), CAR, "left")
        .join(bests, CAR, "left")
        .withColumn("lap_count", F.coalesce("lap_count", F.lit(0)))
        .withColumn("theoretical_lap_ms", total)
        .drop("s1_ms", "s2_ms", "s3_ms")
        .withColumn(
            "sector_best_ms",
            F.coalesce(
                "sector_best_ms", F.array_repeat(F.lit(None).cast("bigint"), 3)
            ),
        )
    )


def analytics_document(cars: DataFrame, splits: DataFrame) -> DataFrame:
    """One nested analytics document per race: cars in order, each with its splits.

    A document is as large as the entrants times the lines of the track.
    """
    fields = [name for name in splits.columns if name not in (*CAR, "team_id", "checkpoint_id")]
    per_car = splits.groupBy(*CAR).agg(
        F.sort_array(F.collect_list(F.struct("checkpoint_id", *fields))).alias("splits")
    )
    keys = ("race_id", "race_position", "car_id")
    rest = [name for name in cars.columns if name not in keys]
    car = F.struct("race_position", "car_id", *rest, "splits")
    return (
        cars.join(per_car, CAR, "left")
        .groupBy("race_id")
        .agg(F.sort_array(F.collect_list(car)).alias("cars"))
    )


def state_document(frames: DataFrame) -> DataFrame:
    """One nested frame document per race and snapshot: cars by position, each with staleness."""
    keys = ("race_id", "snapshot_id", "complete", "stale", "car_id", "race_position")
    rest = [F.col(name) for name in frames.columns if name not in keys]
    telemetry = F.struct("race_id", "snapshot_id", "car_id", "race_position", *rest)
    car = F.struct("race_position", "car_id", "stale", telemetry.alias("telemetry"))
    ordered = F.sort_array(F.collect_list(car))
    return frames.groupBy("race_id", "snapshot_id").agg(
        F.bool_and("complete").alias("complete"),
        F.transform(
            ordered,
            lambda c: F.struct(c["telemetry"].alias("telemetry"), c["stale"].alias("stale")),
        ).alias("cars"),
    )

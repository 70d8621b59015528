"""Validation, dead-letter and archive-check queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitwall.functions import INTERLAGOS, track_column
from pitwall.operators import archive, projections, quality
from pitwall.plans.registry import query
from pitwall.schemas import SOURCE_KINDS

_KINDS = ", ".join(f"'{kind}'" for kind in SOURCE_KINDS)
REASON = f"""CASE
    WHEN kind NOT IN ({_KINDS}) THEN '{quality.NOT_A_SOURCE}'
    WHEN simulation_time_us < 0 THEN '{quality.BAD_CLOCK}'
    WHEN kind = 'telemetry' AND (track_progress < 0 OR track_progress >= 1 OR race_position < 1)
      THEN '{quality.BAD_POSITION}'
    WHEN kind = 'telemetry' AND track_status NOT IN ('green', 'safety_car')
      THEN '{quality.BAD_TRACK_STATUS}'
    WHEN kind = 'telemetry' AND (speed_kmh < 0 OR speed_kmh > 380 OR fuel_kg < 0
         OR fuel_kg > 110.001) THEN '{quality.BAD_SPEED_OR_FUEL}'
    WHEN kind = 'timing' AND (lap_elapsed_ms < 0 OR segment_time_ms < 0)
      THEN '{quality.NEGATIVE_SPLIT}'
    WHEN kind = 'timing' AND race_position < 1 THEN '{quality.BAD_SPLIT_POSITION}'
    WHEN kind = 'timing' AND sector NOT IN (0, 1, 2, 3) THEN '{quality.BAD_SECTOR}'
    WHEN kind = 'timing' AND sector <> 0 AND (sector_time_ms IS NULL OR sector_time_ms < 0)
      THEN '{quality.NO_SECTOR_TIME}'
    WHEN kind = 'pitstop' AND (lap < 1 OR pit_stop_time_ms < 0) THEN '{quality.BAD_PIT_STOP}'
    WHEN kind = 'incident' AND (lap < 0 OR penalty_seconds < 0) THEN '{quality.BAD_INCIDENT}'
    END"""


@query("validate_source_event", f"SELECT kind, event_id, {REASON} AS reason FROM source_events")
def _(t):
    checked = quality.validate_source_event(t("source_events"))
    first = F.try_element_at("reasons", F.lit(1))
    return checked.select("kind", "event_id", first.alias("reason"))


@query(
    "validated_events",
    f"""SELECT 'validated' AS kind, event_id, race_id, car_id, speed_kmh
        FROM (SELECT *, {REASON} AS reason FROM source_events WHERE kind = 'telemetry') e
        WHERE reason IS NULL""",
)
def _(t):
    checked = quality.validate_source_event(t("telemetry"))
    return projections.validated_events(checked).select(
        "kind", "event_id", "race_id", "car_id", "speed_kmh"
    )


@query(
    "dead_letter",
    f"""SELECT 'dead_letter' AS kind,
               concat('erro:', kind, ':', kafka_partition, ':', kafka_offset) AS event_id, race_id,
               kind AS source_topic, kafka_partition AS source_partition,
               kafka_offset AS source_offset, reason
        FROM (SELECT *, {REASON} AS reason, CAST(length(event_id) % 6 AS INT) AS kafka_partition,
                     CAST(abs(simulation_time_us) AS BIGINT) AS kafka_offset
              FROM source_events) e
        WHERE reason IS NOT NULL""",
)
def _(t):
    records = (
        t("source_events")
        .withColumn("topic", F.col("kind"))
        .withColumn("kafka_partition", (F.length("event_id") % 6).cast("int"))
        .withColumn("kafka_offset", F.abs("simulation_time_us").cast("bigint"))
    )
    _, rejected = quality.split_rejected(quality.validate_source_event(records))
    return quality.dead_letter(rejected).select(
        "kind", "event_id", "race_id", "source_topic", "source_partition", "source_offset", "reason"
    )


def _range_sql(name: str, low: float, high: float | None) -> str:
    whole = f" OR {name} <> floor({name})" if isinstance(low, int) else ""
    return f"{name} < {low}" + ("" if high is None else f" OR {name} > {high}") + whole


def _listing(broken: list[tuple[str, str]]) -> str:
    parts = [f"CASE WHEN {condition} THEN '{name}' END" for name, condition in broken]
    return f"concat_ws('|', {', '.join(parts)})"


_CONTRACT_RULES = (
    [("schema_version", "schema_version <> 3")]
    + [("tire_compound", "tire_compound NOT IN ('soft', 'medium', 'hard', 'wet')")]
    + [
        (name, _range_sql(name, *bounds) + (" OR track_progress >= 1" if name == "track_progress" else ""))
        for name, bounds in quality.TELEMETRY_BOUNDS.items()
    ]
    + [("last_lap_time_ms", "last_lap_time_ms < 0")]
    + [("tire_pressure_psi", "tire_pressure_psi < 0")]
    + [("overtaking_lane", "overtaking_lane NOT IN (0, 1)")]
    + [("unknown field frontend_x", "frontend_x IS NOT NULL")]
)


@query(
    "validate_telemetry_contract",
    f"SELECT event_id, {_listing(_CONTRACT_RULES)} AS reasons FROM telemetry_contract",
)
def _(t):
    checked = quality.validate_telemetry_contract(t("telemetry_contract"))
    return checked.select("event_id", F.concat_ws("|", "reasons").alias("reasons"))


_CAR_RULES = [
    (name, _range_sql(name, *quality.CAR_BOUNDS[name]))
    for name in ("car_weight_kg", "driver_weight_kg", "top_speed_kmh")
] + [
    ("tire_compound", "tire_compound NOT IN ('soft', 'medium', 'hard', 'wet')"),
    ("strategy", "strategy NOT IN ('A', 'B', 'C')"),
    ("driver_country_code", "NOT regexp_matches(driver_country_code, '^([A-Z]{2})?$')"),
]


@query("validate_car_config", f"SELECT car_id, {_listing(_CAR_RULES)} AS reasons FROM car_config")
def _(t):
    checked = quality.validate_car_config(t("car_config"))
    return checked.select("car_id", F.concat_ws("|", "reasons").alias("reasons"))


_PLAN_RULES = [
    ("penalty_seconds", "penalty_seconds < 0 OR penalty_seconds > 60"),
    (
        "collision needs two different cars",
        "incident_type = 'collision' AND (second_car_id = '' OR second_car_id = car_id)",
    ),
    ("only a collision has a second car", "incident_type <> 'collision' AND second_car_id <> ''"),
    (
        "a penalty needs at least one second",
        "incident_type = 'time_penalty' AND penalty_seconds < 1",
    ),
    ("only a penalty has seconds", "incident_type <> 'time_penalty' AND penalty_seconds <> 0"),
]


@query(
    "validate_incident_plan",
    f"""SELECT race_id, incident_type, lap, car_id, second_car_id, penalty_seconds,
               {_listing(_PLAN_RULES)} AS reasons FROM incident_plan""",
)
def _(t):
    checked = quality.validate_incident_plan(t("incident_plan"))
    return checked.withColumn("reasons", F.concat_ws("|", "reasons"))


_TRACK_RULES = [
    ("length_m", "length_m <= 0"),
    ("pit_exit", "pit_exit < 0 OR pit_exit >= 1"),
    (
        "pit order",
        """NOT (CASE WHEN pit_exit < 0.86::DOUBLE THEN (pit_exit - 0.86::DOUBLE) % 1 + 1
                     ELSE (pit_exit - 0.86::DOUBLE) % 1 END > 0.94::DOUBLE - 0.86::DOUBLE)""",
    ),
    (
        "sector_ends order",
        "NOT (first_end > 0 AND first_end < second_end AND second_end < 1)",
    ),
    (
        "checkpoints order",
        """NOT (first_point > 0 AND first_point <= 1 AND second_point > 0 AND second_point <= 1
                AND first_point < second_point)""",
    ),
    (
        "shared line",
        """first_point IN (first_end, second_end, 1.0)
           OR second_point IN (first_end, second_end, 1.0)""",
    ),
    (
        "corners",
        """NOT (corner_start >= 0 AND corner_start < corner_end AND corner_end <= 0.7
                AND radius <> 0)""",
    ),
]


@query(
    "validate_track",
    f"SELECT p_partkey, {_listing(_TRACK_RULES)} AS reasons FROM track_setups",
)
def _(t):
    setups = t("track_setups")
    varied = {
        "length_m": F.col("length_m"),
        "sector_ends": F.array("first_end", "second_end", F.lit(1.0)),
        "checkpoints": F.array("first_point", "second_point"),
        "corners": F.array(
            F.array("corner_start", "corner_end", "radius"),
            F.array(F.lit(0.7), F.lit(0.8), F.lit(60.0)),
        ),
        "pit_exit": F.col("pit_exit"),
    }
    base = track_column()
    track = F.struct(
        *[varied.get(name, base[name]).alias(name) for name in INTERLAGOS]
    )
    checked = quality.validate_track(setups.withColumn("track", track))
    return checked.select("p_partkey", F.concat_ws("|", "reasons").alias("reasons"))


@query(
    "archive_null_metadata",
    """SELECT CAST(count(*) AS BIGINT) AS rows_without_metadata FROM (
         SELECT CASE WHEN payload = '{"k": 9}' THEN NULL ELSE payload END AS avro_envelope
         FROM envelopes_replay) e WHERE avro_envelope IS NULL""",
)
def _(t):
    return archive.archive_null_metadata(_archive(t))


def _archive(t):
    body = F.when(F.col("payload") != '{"k": 9}', F.col("payload"))
    return t("envelopes_replay").withColumn("avro_envelope", body)


@query(
    "archive_duplicate_offsets",
    """SELECT topic, kafka_partition, kafka_offset, count(*) AS copies FROM envelopes_replay
       GROUP BY topic, kafka_partition, kafka_offset HAVING count(*) > 1""",
)
def _(t):
    return archive.archive_duplicate_offsets(t("envelopes_replay"))


@query(
    "archive_summary",
    """SELECT (SELECT count(*) FROM envelopes_replay) AS registros,
              (SELECT count(DISTINCT topic) FROM envelopes_replay) AS topicos,
              (SELECT count(*) FROM (SELECT 1 FROM envelopes_replay
                 GROUP BY topic, kafka_partition, kafka_offset HAVING count(*) > 1) d)
                AS duplicate_offsets,
              (SELECT count(*) FROM envelopes_replay WHERE payload = '{"k": 9}')
                AS rows_without_metadata""",
)
def _(t):
    return archive.archive_summary(_archive(t))

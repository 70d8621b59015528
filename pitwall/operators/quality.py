"""Contract validation as one projection: rules become reasons, reasons split the rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.schemas import SOURCE_KINDS

# Reasons stored in dead letters.
NO_IDENTITY = "Evento sem identidade de corrida"
NOT_A_SOURCE = "Tipo de evento não aceito como fonte"
BAD_CLOCK = "Tempo físico negativo"
BAD_POSITION = "Posição inválida"
BAD_TRACK_STATUS = "Estado de pista inválido"
BAD_SPEED_OR_FUEL = "Velocidade ou combustível inválido"
NEGATIVE_SPLIT = "Parcial negativa"
BAD_SPLIT_POSITION = "Posição da parcial inválida"
BAD_SECTOR = "Setor inválido"
NO_SECTOR_TIME = "Setor sem tempo válido"
BAD_PIT_STOP = "Contexto de pit stop inválido"
BAD_INCIDENT = "Contexto de incidente inválido"
EMPTY_EVENT = "Evento vazio"
UNKNOWN = "desconhecida"
REASON_LENGTH = 2000

COMPOUNDS = ("soft", "medium", "hard", "wet")

Rule = tuple[str, Column]


def _column(df: DataFrame, name: str, kind: str = "double") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def _holds(condition: Column) -> Column:
    """A null condition (missing value) does not hold."""
    return F.coalesce(condition, F.lit(False))


def with_reasons(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Add ``reasons``: the names of all rules a row breaks, in rule order."""
    broken = [F.when(~_holds(condition), F.lit(reason)) for reason, condition in rules]
    return df.withColumn("reasons", F.array_compact(F.array(*broken)))


def first_reason(rules: Iterable[Rule]) -> Column:
    """The first rule a row breaks, null if it breaks none; later rules are not looked at."""
    return F.coalesce(*[F.when(~_holds(condition), F.lit(reason)) for reason, condition in rules])


def split_rejected(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted rows without reasons, and rejected rows with their first reason."""
    good = F.size("reasons") == 0
    accepted = checked.filter(good).drop("reasons")
    rejected = checked.filter(~good).withColumn("reason", F.col("reasons")[0])
    return accepted, rejected


def source_rules(events: DataFrame) -> list[Rule]:
    """Identity, clock and per-kind limits of producer events (wide rows of all kinds)."""
    kind = F.col("kind")

    def value(name: str) -> Column:
        return _column(events, name)

    def only(name: str, condition: Column) -> Column:
        return ~kind.eqNullSafe(F.lit(name)) | _holds(condition)

    def least(name: str, lowest: float) -> Column:
        """A finite number of at least ``lowest``."""
        return _finite(value(name)) & (value(name) >= lowest)

    sector = value("sector")
    timed = (sector == 0) | least("sector_time_ms", 0)
    track_status = _column(events, "track_status", "string")
    return [
        (
            NO_IDENTITY,
            (F.length(F.col("event_id")) > 0) & (F.length(F.col("race_id")) > 0),
        ),
        (NOT_A_SOURCE, kind.isin(*SOURCE_KINDS)),
        (BAD_CLOCK, least("simulation_time_us", 0)),
        (
            BAD_POSITION,
            only(
                "telemetry",
                value("track_progress").between(0, 1)
                & (value("track_progress") < 1)
                & least("race_position", 1),
            ),
        ),
        (BAD_TRACK_STATUS, only("telemetry", track_status.isin("green", "safety_car"))),
        (
            BAD_SPEED_OR_FUEL,
            only(
                "telemetry",
                value("speed_kmh").between(0, 380) & value("fuel_kg").between(0, 110.001),
            ),
        ),
        (
            NEGATIVE_SPLIT,
            only("timing", least("lap_elapsed_ms", 0) & least("segment_time_ms", 0)),
        ),
        (BAD_SPLIT_POSITION, only("timing", least("race_position", 1))),
        (BAD_SECTOR, only("timing", sector.isin(0, 1, 2, 3))),
        (NO_SECTOR_TIME, only("timing", timed)),
        (
            BAD_PIT_STOP,
            only("pitstop", least("lap", 1) & least("pit_stop_time_ms", 0)),
        ),
        (
            BAD_INCIDENT,
            only("incident", least("lap", 0) & least("penalty_seconds", 0)),
        ),
    ]


def validate_source_event(events: DataFrame) -> DataFrame:
    """Producer events with the names of all :func:`source_rules` they break."""
    return with_reasons(events, source_rules(events))


# Bounds of the telemetry contract, ``(lowest, highest)``; null = no bound.
TELEMETRY_BOUNDS = {
    "speed_kmh": (0.0, 380.0),
    "gear": (1, 8),
    "rpm": (0, 15_000),
    "fuel_kg": (0.0, None),
    "car_weight_kg": (495.0, None),
    "lap": (1, None),
    "sector": (1, 3),
    "lap_distance_m": (0.0, None),
    "track_progress": (0.0, 1.0),
    "race_position": (1, None),
    "throttle": (0.0, 1.0),
    "brake": (0.0, 1.0),
    "tire_age_laps": (0, None),
    "current_lap_time_ms": (0, None),
    "elapsed_race_seconds": (0.0, 120.0),
    "target_laps": (1, None),
}
# Fields that may be null, with their lowest value.
TELEMETRY_OPTIONAL = {"last_lap_time_ms": 0, "best_lap_time_ms": 0}
# Fields with a default, their bounds and the default.
TELEMETRY_DEFAULTED = {
    "tire_pressure_psi": (0.0, None, 38.0),
    "pit_stops": (0, None, 0),
    "overtaking_lane": (0, 1, 0),
}
# Texts the contract allows.
TELEMETRY_CHOICES = {
    "event_type": ("race.telemetry.v3",),
    "schema_version": (3,),
    "tire_compound": COMPOUNDS,
    "pit_status": ("on_track", "pit_lane", "in_pit", "out_of_fuel", "tire_burst"),
    "driving_phase": ("straight", "braking", "corner"),
    "race_status": ("running", "paused", "finished", "stopped"),
}
TELEMETRY_TEXTS = ("event_id", "race_id", "car_id", "driver_id")
TELEMETRY_TIMES = ("event_time", "produced_at")


def _between(value: Column, lowest: float, highest: float | None) -> Column:
    """A finite number within bounds; a bound given as an integer asks for whole numbers."""
    number = value.try_cast("double")
    inside = (number >= lowest) & _finite(number)
    if isinstance(lowest, int):
        inside = inside & (number == F.floor(number))
    return inside if highest is None else inside & (number <= highest)


def validate_telemetry_contract(telemetry: DataFrame) -> DataFrame:
    """Bounds and choices of the versioned telemetry payload; unknown fields are refused."""
    rules: list[Rule] = []
    for name in TELEMETRY_TEXTS:
        rules.append((name, F.length(_column(telemetry, name, "string")) > 0))
    for name in TELEMETRY_TIMES:
        time = _column(telemetry, name, "string")
        if name in telemetry.columns and telemetry.schema[name].dataType == T.StringType():
            time = F.try_to_timestamp(time)
        rules.append((name, time.isNotNull()))
    for name, allowed in TELEMETRY_CHOICES.items():
        kind = "int" if name == "schema_version" else "string"
        rules.append((name, _column(telemetry, name, kind).isin(*allowed)))
    for name, (lowest, highest) in TELEMETRY_BOUNDS.items():
        condition = _between(_column(telemetry, name), lowest, highest)
        if name == "track_progress":
            condition = condition & (_column(telemetry, name) < 1)
        rules.append((name, condition))
    for name, lowest in TELEMETRY_OPTIONAL.items():
        value = _column(telemetry, name)
        rules.append((name, value.isNull() | _between(value, lowest, None)))
    for name, (lowest, highest, default) in TELEMETRY_DEFAULTED.items():
        if name in telemetry.columns:
            value = F.coalesce(F.col(name), F.lit(default))
            rules.append((name, _between(value, lowest, highest)))
    known = {
        *TELEMETRY_TEXTS,
        *TELEMETRY_TIMES,
        *TELEMETRY_CHOICES,
        *TELEMETRY_BOUNDS,
        *TELEMETRY_OPTIONAL,
        *TELEMETRY_DEFAULTED,
    }
    for name in telemetry.columns:
        if name not in known:
            rules.append((f"unknown field {name}", F.col(name).isNull()))
    return with_reasons(telemetry, rules)


# Bounds of a car set-up.
CAR_BOUNDS = {
    "car_weight_kg": (450.0, 1000.0),
    "driver_weight_kg": (45.0, 150.0),
    "top_speed_kmh": (250.0, 380.0),
    "driver_height_m": (1.60, 1.90),
    "pit_service_seconds": (3.0, 6.0),
    "car_length_m": (3.0, 3.0),
}
CAR_CHOICES = {"tire_compound": COMPOUNDS, "team_category": ("A", "B", "C"), "strategy": ("A", "B", "C")}
CAR_TEXT_LENGTHS = {"driver_id": (1, 64), "team_id": (1, 64), "driver_name": (0, 100)}
COUNTRY_CODE = "^([A-Z]{2})?$"


def validate_car_config(cars: DataFrame) -> DataFrame:
    """Bounds of a car set-up; a column that is absent takes its default and passes."""
    rules: list[Rule] = []
    for name, (lowest, highest) in CAR_BOUNDS.items():
        if name in cars.columns:
            rules.append((name, _between(F.col(name), lowest, highest)))
    for name, allowed in CAR_CHOICES.items():
        if name in cars.columns:
            rules.append((name, F.col(name).isin(*allowed)))
    for name, (shortest, longest) in CAR_TEXT_LENGTHS.items():
        if name in cars.columns:
            rules.append((name, F.length(name).between(shortest, longest)))
    if "driver_country_code" in cars.columns:
        rules.append(("driver_country_code", F.col("driver_country_code").rlike(COUNTRY_CODE)))
    return with_reasons(cars, rules)


INCIDENT_TYPES = ("tire_puncture", "collision", "time_penalty")


def validate_incident_plan(plan: DataFrame) -> DataFrame:
    """Participants and penalty of planned incidents."""
    kind = F.col("incident_type")
    second = F.coalesce("second_car_id", F.lit(""))
    seconds = F.coalesce("penalty_seconds", F.lit(0))
    collision = kind == "collision"
    penalty = kind == "time_penalty"
    rules = [
        ("incident_type", kind.isin(*INCIDENT_TYPES)),
        ("lap", F.col("lap").between(1, 1000)),
        ("car_id", F.length("car_id").between(1, 64)),
        ("second_car_id", F.length(second) <= 64),
        ("penalty_seconds", seconds.between(0, 60)),
        (
            "collision needs two different cars",
            ~collision | ((second != "") & (second != F.col("car_id"))),
        ),
        ("only a collision has a second car", collision | (second == "")),
        ("a penalty needs at least one second", ~penalty | (seconds >= 1)),
        ("only a penalty has seconds", penalty | (seconds == 0)),
    ]
    return with_reasons(plan, rules)


# Track fields that must be finite and positive, integers, and lap fractions.
TRACK_POSITIVE = (
    "length_m",
    "physics_step_seconds",
    "acceleration_m_s2",
    "braking_m_s2",
    "refuel_kg_per_second",
    "pit_path_ratio",
    "pit_speed_kmh",
    "lateral_limit_g",
    "finish_timeout_seconds",
    "tank_capacity_kg",
    "fuel_tanks_per_reference",
    "grid_spacing_m",
)
TRACK_INTEGERS = {"fuel_reference_laps": 1, "max_overtakes": 0}
TRACK_FRACTIONS = ("map_start_offset", "pit_entry", "pit_box", "pit_exit")


def _finite(value: Column) -> Column:
    number = value.cast("double")
    return ~F.isnan(number) & (F.abs(number) < float("inf"))


def validate_track(tracks: DataFrame, column: str = "track") -> DataFrame:
    """Geometry rules of a nested track column, checked with array functions."""
    track = F.col(column)
    rules: list[Rule] = []
    for name in TRACK_POSITIVE:
        rules.append((name, _finite(track[name]) & (track[name] > 0)))
    for name, lowest in TRACK_INTEGERS.items():
        value = track[name]
        rules.append((name, _finite(value) & (value >= lowest) & (value == F.floor(value))))
    for name in TRACK_FRACTIONS:
        rules.append((name, (track[name] >= 0) & (track[name] < 1)))
    to_box = F.pmod(track["pit_box"] - track["pit_entry"], F.lit(1.0))
    to_exit = F.pmod(track["pit_exit"] - track["pit_entry"], F.lit(1.0))
    rules.append(("pit order", (to_box > 0) & (to_box < to_exit)))

    ends, points, corners = track["sector_ends"], track["checkpoints"], track["corners"]
    rules.append(
        ("sector ends", (F.size(ends) == 3) & (F.try_element_at(ends, F.lit(-1)) == 1))
    )
    for name, lines in (("sector_ends", ends), ("checkpoints", points)):
        inside = F.forall(lines, lambda p: (p > 0) & (p <= 1))
        increasing = lines == F.array_sort(F.array_distinct(lines))
        rules.append((f"{name} order", inside & increasing))
    rules.append(("shared line", ~F.arrays_overlap(points, ends)))

    shaped = F.forall(corners, lambda c: (F.size(c) == 3) & F.forall(c, _finite))

    def in_place(corner: Column, index: Column) -> Column:
        previous = F.when(
            index > 0, F.try_element_at(F.try_element_at(corners, index), F.lit(2))
        ).otherwise(F.lit(0.0))
        start, end, radius = (F.try_element_at(corner, F.lit(i)) for i in (1, 2, 3))
        return (
            (start >= 0) & (previous <= start) & (start < end) & (end <= 1) & (radius != 0)
        )

    placed = F.forall(F.transform(corners, in_place), lambda ok: _holds(ok))
    rules.append(("corners", shaped & placed))

    grips = track["tire_grip_factors"]
    listed = F.array_sort(F.map_keys(grips)) == F.array(*[F.lit(c) for c in sorted(COMPOUNDS)])
    usable = F.forall(F.map_values(grips), lambda g: _finite(g) & (g > 0))
    rules.append(("tire grip", listed & usable))
    return with_reasons(tracks, rules)


def dead_letter(rejected: DataFrame, now: Column | None = None) -> DataFrame:
    """Dead-letter events of rejected records, keyed by their broker position."""
    stamp = F.current_timestamp() if now is None else now
    stamp_text = F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    position = [F.col(name).cast("string") for name in ("topic", "kafka_partition", "kafka_offset")]
    race = F.col("race_id") if "race_id" in rejected.columns else F.lit(None)
    zero = F.lit(0).cast("bigint")
    return rejected.select(
        F.lit("dead_letter").alias("kind"),
        F.concat_ws(":", F.lit("erro"), *position).alias("event_id"),
        F.coalesce(race.cast("string"), F.lit(UNKNOWN)).alias("race_id"),
        stamp_text.alias("event_time"),
        stamp_text.alias("produced_at"),
        zero.alias("simulation_time_us"),
        zero.alias("source_sequence"),
        F.lit(UNKNOWN).alias("track_version"),
        F.lit(UNKNOWN).alias("rules_version"),
        F.lit(1).alias("schema_version"),
        F.lit("").alias("car_id"),
        F.col("topic").alias("source_topic"),
        F.col("kafka_partition").alias("source_partition"),
        F.col("kafka_offset").alias("source_offset"),
        F.substring(F.coalesce("reason", F.lit(EMPTY_EVENT)), 1, REASON_LENGTH).alias("reason"),
    )

"""Contracts, dead letters, archive checks, decoding and expressions."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pitwall import functions as fn
from pitwall import schemas
from pitwall.operators import archive, lifecycle, projections, quality
from pitwall.sources import broker, decode


def first_reason(frame):
    _, rejected = quality.split_rejected(quality.validate_source_event(frame))
    return [r["reason"] for r in rejected.collect()]


TELEMETRY = """kind string, event_id string, race_id string, simulation_time_us bigint,
    track_progress double, race_position int, track_status string, speed_kmh double,
    fuel_kg double"""
GOOD = ("telemetry", "e", "r", 0, 0.5, 1, "green", 100.0, 50.0)


@pytest.mark.parametrize(
    ("position", "value", "reason"),
    [
        (1, "", quality.NO_IDENTITY),
        (2, None, quality.NO_IDENTITY),
        (0, "state", quality.NOT_A_SOURCE),
        (3, -1, quality.BAD_CLOCK),
        (3, None, quality.BAD_CLOCK),
        (4, 1.0, quality.BAD_POSITION),
        (4, float("nan"), quality.BAD_POSITION),
        (5, 0, quality.BAD_POSITION),
        (6, "red", quality.BAD_TRACK_STATUS),
        (7, 380.5, quality.BAD_SPEED_OR_FUEL),
        (8, 110.002, quality.BAD_SPEED_OR_FUEL),
    ],
)
def test_source_event_reasons(spark, position, value, reason):
    row = list(GOOD)
    row[position] = value
    assert first_reason(spark.createDataFrame([tuple(row)], TELEMETRY)) == [reason]


def test_good_source_event_has_no_reason(spark):
    frame = spark.createDataFrame([GOOD, (*GOOD[:8], 110.001)], TELEMETRY)
    assert first_reason(frame) == []
    accepted = projections.validated_events(quality.validate_source_event(frame))
    assert {r["kind"] for r in accepted.collect()} == {"validated"}


def test_timing_needs_a_time_at_a_sector_line(spark):
    schema = """kind string, event_id string, race_id string, simulation_time_us bigint,
        lap_elapsed_ms bigint, segment_time_ms bigint, race_position int, sector int,
        sector_time_ms bigint"""
    rows = [
        ("timing", "a", "r", 1, 1, 1, 1, 0, None),
        ("timing", "b", "r", 1, 1, 1, 1, 2, None),
        ("timing", "c", "r", 1, 1, 1, 1, 4, 9),
        ("timing", "d", "r", 1, -1, 1, 1, 0, None),
        ("timing", "e", "r", 1, 1, 1, 0, 0, None),
    ]
    _, rejected = quality.split_rejected(
        quality.validate_source_event(spark.createDataFrame(rows, schema))
    )
    assert {r["event_id"]: r["reason"] for r in rejected.collect()} == {
        "b": quality.NO_SECTOR_TIME,
        "c": quality.BAD_SECTOR,
        "d": quality.NEGATIVE_SPLIT,
        "e": quality.BAD_SPLIT_POSITION,
    }


def test_dead_letter_of_an_unreadable_record(spark):
    rejected = spark.createDataFrame(
        [("telemetry", 3, 77, None, None), ("timing", 1, 2, "r", "x" * 3000)],
        "topic string, kafka_partition int, kafka_offset bigint, race_id string, reason string",
    )
    letters = {r["event_id"]: r for r in quality.dead_letter(rejected).collect()}
    empty = letters["erro:telemetry:3:77"]
    assert (empty["race_id"], empty["reason"]) == ("desconhecida", "Evento vazio")
    assert len(letters["erro:timing:1:2"]["reason"]) == 2000
    assert set(rejected.sparkSession.createDataFrame([], schemas.event_schema("dead_letter")).columns) == set(
        empty.asDict()
    )


def test_unknown_telemetry_field_is_refused(spark, data):
    from pitwall.plans.adapters import Tables

    rows = Tables(spark, data)("telemetry_contract")
    checked = quality.validate_telemetry_contract(rows)
    with_extra = checked.filter("frontend_x IS NOT NULL")
    assert with_extra.filter(~F.array_contains("reasons", "unknown field frontend_x")).count() == 0
    late = checked.filter("track_progress >= 1").filter(~F.array_contains("reasons", "track_progress"))
    assert late.count() == 0


def test_own_track_is_valid_and_broken_ones_are_not(spark):
    def reasons(**changes):
        track = fn.track_column({**fn.INTERLAGOS, **changes})
        return quality.validate_track(spark.range(1).select(track.alias("track"))).first()["reasons"]

    assert reasons() == []
    assert reasons(length_m=float("inf")) == ["length_m"]
    assert reasons(fuel_reference_laps=1.5) == ["fuel_reference_laps"]
    assert "sector ends" in reasons(sector_ends=[0.5, 1.0])
    assert reasons(checkpoints=[0.2, 0.1]) == ["checkpoints order"]
    assert reasons(checkpoints=[0.34]) == ["shared line"]
    assert reasons(corners=[[0.1, 0.2, 5.0], [0.15, 0.3, 5.0]]) == ["corners"]
    assert reasons(corners=[[0.1, 0.2]]) == ["corners"]
    assert reasons(tire_grip_factors={"soft": 1.0}) == ["tire grip"]
    assert reasons(pit_box=0.1) == ["pit order"]


def test_archive_checks(spark):
    rows = [
        (dt.datetime(2024, 1, 1), "t", 0, 1, None, bytearray(b"x"), None, dt.date(2024, 1, 1)),
        (dt.datetime(2024, 1, 1), "t", 0, 2, None, bytearray(b"x"), None, dt.date(2024, 1, 1)),
    ]
    good = spark.createDataFrame(rows, schemas.ENVELOPE)
    assert archive.check_archive(good) == {"registros": 2, "topicos": 1}
    with pytest.raises(ValueError, match="duplicate"):
        archive.check_archive(good.union(good))
    with pytest.raises(ValueError, match="metadata"):
        archive.check_archive(good.withColumn("avro_envelope", F.lit(None).cast("binary")))
    with pytest.raises(ValueError, match="missing"):
        archive.check_archive(good.drop("event_key"))
    with pytest.raises(ValueError, match="no events"):
        archive.check_archive(good.limit(0))


def test_retention_refuses_short_ages_and_large_batches(spark):
    nothing = spark.createDataFrame([], "race_id string")
    for days, limit in ((7, 10), (30, 0), (30, 100_001)):
        with pytest.raises(ValueError):
            lifecycle.retention_candidates(nothing, nothing, nothing, F.lit(None), days, limit)


def test_retention_of_one_eligible_race(spark):
    old, now = dt.datetime(2024, 1, 1), dt.datetime(2024, 3, 1)
    races = spark.createDataFrame(
        [("old", "finished", old, old), ("active", "running", old, None),
         ("pending", "finished", old, old), ("latest", "finished", now, old)],
        "race_id string, status string, started_at timestamp, finished_at timestamp",
    )
    events = spark.createDataFrame(
        [(f"e-{r}", r, old, "{\"a\":1}") for r in ("old", "active", "pending", "latest")],
        "event_id string, race_id string, received_at timestamp, payload string",
    )
    outbox = spark.createDataFrame([("pending",)], "race_id string")

    def candidates(rows):
        return lifecycle.retention_candidates(rows, races, outbox, F.lit(now), 30, 100)

    assert [r["event_id"] for r in candidates(events).collect()] == ["e-old"]
    kept = lifecycle.retention_apply(events, candidates(events))
    assert kept.count() == 4
    assert candidates(kept).count() == 0


def test_topics_are_unique_and_route_every_kind(spark):
    assert len(set(schemas.TOPICS.values())) == len(schemas.TOPICS) == 10
    events = spark.createDataFrame(
        [("lap", "CAR-01", "r"), ("state", "", "r"), ("control", None, "r")],
        "kind string, car_id string, race_id string",
    )
    routed = {(r["topic"], r["key"]) for r in broker.event_sink(events).collect()}
    assert routed == {("lap_completed", "CAR-01"), ("state", "r"), ("control", "r")}
    for kind in schemas.TOPICS:
        assert schemas.event_schema(kind).names[:3] == ["kind", "event_id", "race_id"]
        assert set(schemas.DEFAULTS[kind]) <= set(schemas.event_schema(kind).names)


def test_broker_options_and_missing_connector(spark):
    options = broker.broker_options("host:1", 7, ["a", "b"])
    assert options["subscribe"] == "a,b"
    assert options["failOnDataLoss"] == "true"
    assert options["maxOffsetsPerTrigger"] == "7"
    assert options["includeHeaders"] == "true"
    with pytest.raises(Exception, match="(?i)kafka"):
        broker.broker_source(spark, "host:1", 100)


def test_schema_evolution(spark):
    old = spark.createDataFrame([("e",)], "event_id string")
    row = decode.schema_evolution_fill(old, schemas.DEFAULTS["telemetry"]).first()
    assert (row["track_status"], row["time_penalty_seconds"]) == ("green", 0)


def test_decoding_needs_a_registry(spark):
    with pytest.raises(ValueError, match="no writer schema"):
        decode.decode_by_writer_schema(spark.range(1), "lap_completed", {}, "a int")


def test_texts(spark):
    def one(column):
        return spark.range(1).select(column).first()[0]

    assert one(fn.country_flag(F.lit("br"))) == "🇧🇷"
    assert [one(fn.country_flag(F.lit(c))) for c in ("", "B", "BRA", "B1", "ÇA")] == [""] * 5
    assert one(fn.country_flag(F.lit(None).cast("string"))) == ""
    assert one(fn.format_gap(F.lit(None).cast("bigint"))) == "--:--.---"
    assert one(fn.format_gap(F.lit(61_005))) == "+1:01.005"
    assert one(fn.format_lap_time(F.lit(90_000))) == "1:30.000"
    assert one(fn.format_lap_time(F.lit(999.6))) == "0:00.1000"
    assert one(fn.format_lap_time(F.lit(float("nan")))) == "—"
    assert one(fn.team_label(F.lit("TEAM-A-03"))) == "Equipe A3"
    assert one(fn.team_label(F.lit("TEAM-D-03"))) == "TEAM-D-03"
    lines = one(fn.track_lines(fn.track_column()))
    assert len(lines) == 18
    assert [line[1] for line in lines][:4] == ["P01", "P02", "P03", "P04"]
    assert lines[-1][1:] == ("SF", 3)
    assert one(fn.lap_time_estimate(F.lit(820.0), F.lit(75.0), F.lit(330.0), F.lit("medium"), F.lit(0))) == 90_000
    assert one(fn.lap_time_estimate(F.lit(820.0), F.lit(75.0), F.lit(330.0), F.lit("soft"), F.lit(-1))) is None


def test_telemetry_phases(spark):
    samples = spark.createDataFrame(
        [(4309.0 * 2.8, 300.0, 0.0, 3.0, 4.0), (0.0, 10.0, 0.2, 0.0, 0.0), (1.0, 10.0, 0.0, None, None)],
        "distance_m double, speed_kmh double, brake double, g_longitudinal double, g_lateral double",
    )
    rows = fn.telemetry_features(samples).collect()
    assert [r["driving_phase"] for r in rows] == ["corner", "braking", "straight"]
    assert (rows[0]["lap"], rows[0]["sector"], rows[0]["gear"], rows[0]["g_horizontal"]) == (3, 3, 8, 5.0)
    assert rows[2]["g_horizontal"] is None


@pytest.mark.parametrize("clock", [float("nan"), float("inf"), -1.0])
def test_clocks_are_finite_and_not_negative(spark, clock):
    rows = [("incident", "e", "r", 1.0, 1, 0), ("incident", "e", "r", clock, 1, 0)]
    columns = """kind string, event_id string, race_id string, simulation_time_us double, lap int,
        penalty_seconds int"""
    checked = quality.validate_source_event(spark.createDataFrame(rows, columns)).collect()
    assert [r["reasons"] for r in checked] == [[], [quality.BAD_CLOCK]]


def test_absent_and_fractional_fields_break_the_telemetry_contract(spark):
    frame = spark.createDataFrame([(2.5, 3.0, float("inf"))], "gear double, lap double, rpm double")
    reasons = quality.validate_telemetry_contract(frame).first()["reasons"]
    assert {"gear", "rpm", "track_progress", "speed_kmh"} <= set(reasons)
    assert "lap" not in reasons


def test_dedup_needs_an_order(spark):
    from pitwall.operators import dedup

    with pytest.raises(ValueError, match="ordering"):
        dedup.dedup_event_id(spark.createDataFrame([("e",)], "event_id string"))

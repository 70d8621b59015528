"""Laps from crossings, split colours, gaps and order, against brute force."""

from __future__ import annotations

import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from pitwall.functions import track_column
from pitwall.operators import crossings, gaps, laps, order, timing

SCHEMA = """event_id string, race_id string, car_id string, team_id string, lap int,
    checkpoint_id string, sector int, lap_elapsed_ms bigint, segment_time_ms bigint,
    sector_time_ms bigint, pit_lap boolean, neutralized boolean, valid boolean,
    simulation_time_us bigint"""
LINES = [("P01", 0), ("S1", 1), ("P02", 0), ("S2", 2), ("P03", 0), ("SF", 3)]


def race(seed=1, cars=6, laps_=8, hot=False):
    """Crossings of one race (and a few of another), with invalid and neutralised ones."""
    rng = random.Random(seed)
    rows = []
    for race_id, n in (("race-hot", cars), ("race-b", 2)):
        for c in range(n):
            clock = c * 900
            for lap in range(1, laps_ + 1):
                elapsed, since_sector = 0, 0
                for point, sector in LINES:
                    segment = rng.randint(9_000, 12_000)
                    elapsed, since_sector = elapsed + segment, since_sector + segment
                    clock += segment
                    neutral = rng.random() < 0.03
                    rows.append(
                        (f"{race_id}:{c}:{lap}:{point}", race_id, f"CAR-{c:02d}", f"T{c % 3}",
                         lap, point, sector, elapsed, segment,
                         since_sector if sector else None, lap == 3 and c == 1, neutral,
                         rng.random() > 0.1 and not neutral, clock * 1000)
                    )
                    if sector:
                        since_sector = 0
    return rows


@pytest.fixture(scope="module")
def rows():
    return race()


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).cache()


NAMES = [part.split()[0] for part in SCHEMA.split(",")]


def as_dicts(rows):
    return [dict(zip(NAMES, row)) for row in rows]


def test_complete_laps_do_not_depend_on_order_or_replays(spark, rows, frame):
    expected = {}
    for r in as_dicts(rows):
        lap = expected.setdefault((r["race_id"], r["car_id"], r["lap"]), {"n": False})
        lap["n"] = lap["n"] or r["neutralized"]
        if r["checkpoint_id"] == "SF":
            lap["time"], lap["ok"] = r["lap_elapsed_ms"], r["valid"]
    again = list(rows) + rows[::5]
    random.Random(3).shuffle(again)
    for source in (frame, spark.createDataFrame(again, SCHEMA)):
        got = {
            (r["race_id"], r["car_id"], r["lap"]): r for r in laps.complete_laps(source).collect()
        }
        assert got.keys() == expected.keys()
        for key, lap in expected.items():
            assert got[key]["lap_time_ms"] == lap["time"] == sum(got[key]["sectors_ms"])
            assert got[key]["neutralized"] == lap["n"]
            assert got[key]["valid"] == (lap["ok"] and not lap["n"])


def test_lap_without_a_sector_is_not_complete(frame):
    missing = frame.filter("NOT (lap = 2 AND checkpoint_id = 'S1')")
    assert laps.complete_laps(missing).filter("lap = 2").count() == 0


def test_current_lap_stops_at_the_target(spark, frame):
    targets = spark.createDataFrame([("race-hot", 8)], "race_id string, target_laps int")
    done = laps.complete_laps(frame, targets)
    last = done.filter("lap = 8").select("race_id", "current_lap").distinct().collect()
    assert {(r[0], r[1]) for r in last} == {("race-hot", 8), ("race-b", 9)}


@pytest.mark.parametrize("slice_us", [7_000_000, 60_000_000, 10**12])
def test_split_progression_equals_brute_force_for_any_slice(rows, frame, slice_us):
    race_best, own_best, expected = {}, {}, {}
    ordered = sorted(
        as_dicts(rows), key=lambda r: (r["simulation_time_us"], r["car_id"], r["lap"])
    )
    for r in ordered:
        point = (r["race_id"], r["checkpoint_id"])
        own = (*point, r["car_id"])
        time, best, mine = r["segment_time_ms"], race_best.get(point), own_best.get(own)
        if not r["valid"] or r["pit_lap"]:
            color = "gray"
        elif best is None or time <= best:
            color = "purple"
        elif mine is None or time < mine:
            color = "green"
        else:
            color = "yellow"
        expected[r["event_id"]] = (color, None if mine is None else time - mine)
        if color != "gray":
            race_best[point] = min(time, best if best is not None else time)
            own_best[own] = min(time, mine if mine is not None else time)
    got = {
        r["event_id"]: (r["color"], r["delta_ms"])
        for r in timing.split_progression(frame, slice_us).collect()
    }
    assert got == expected


def test_pace_is_the_half_even_median_of_the_last_clean_laps(spark):
    times = [91_000, 90_000, 90_001, 95_000, 96_000, 97_001, 97_002]
    rows = [("r", "c", i + 1, t, True, i == 3) for i, t in enumerate(times)]
    frame = spark.createDataFrame(
        rows, "race_id string, car_id string, lap int, lap_time_ms bigint, valid boolean, pit_lap boolean"
    )
    clean = [t for i, t in enumerate(times) if i not in (0, 3)][-5:]
    assert laps.clean_pace(frame).first()["pace_ms"] == round(median(clean))
    assert laps.clean_pace(frame, 2).first()["pace_ms"] == round(median(clean[-2:]))


def test_gaps_share_a_reference_and_rise_with_position(spark, monkeypatch):
    from pitwall.operators import ranges

    cars, laps_ = 9, 5
    rows = []
    for c in range(cars):
        for lap in range(1, laps_ + 1):
            for i, (point, sector) in enumerate(LINES):
                at = (lap * 60_000 + i * 9_000 + c * 731) * 1000 + c
                # At the last line two cars cross out of order, so it is not usable.
                if lap == laps_ and point == "SF" and c == 1:
                    at += 10_000_000
                rows.append((f"{c}:{lap}:{point}", "r", f"CAR-{c:02d}", "T", lap, point, sector,
                             i * 9_000, 9_000, 1 if sector else None, False, False, True, at))
    frame = spark.createDataFrame(rows, SCHEMA)
    ranked = spark.createDataFrame(
        [("r", f"CAR-{c:02d}", c + 1, laps_ - c % 2, 400_000_000 + c) for c in range(cars)],
        """race_id string, car_id string, race_position int, laps_completed int,
           simulation_time_us bigint""",
    )
    results = []
    for block in (2, 512):
        monkeypatch.setattr(ranges, "POSITION_SLICE", block)
        results.append([tuple(r) for r in gaps.gaps(frame, ranked).orderBy("race_position").collect()])
    assert results[0] == results[1]
    got = gaps.gaps(frame, ranked).orderBy("race_position").collect()
    assert {r["gap_reference"] for r in got} == {"5:P03"}
    assert [r["gap_to_leader_ms"] for r in got] == [731 * c for c in range(cars)]
    assert [r["interval_to_ahead_ms"] for r in got] == [None] + [731] * (cars - 1)
    assert [r["laps_behind"] for r in got] == [c % 2 for c in range(cars)]
    # A car that crossed nothing leaves no usable reference.
    alone = ranked.withColumn("car_id", F.regexp_replace("car_id", "CAR-08", "CAR-99"))
    none = gaps.gaps(frame, alone).collect()
    assert {(r["gap_reference"], r["gap_to_leader_ms"], r["gap_reference_age_ms"]) for r in none} == {
        ("", None, None)
    }


def test_running_order_counts_penalties(spark):
    frames = spark.createDataFrame(
        [("r", 1, "A", 5000.0, 100.0), ("r", 1, "B", 5000.0, 102.0), ("r", 1, "C", 5000.0, None),
         ("r", 1, "D", 4000.0, 99.0)],
        "race_id string, snapshot_id int, car_id string, distance_m double, finished_at double",
    )
    penalties = spark.createDataFrame(
        [("r", "A", 5)], "race_id string, car_id string, penalty_seconds bigint"
    )
    ranked = order.running_order(frames, penalties).orderBy("position").collect()
    assert [r["car_id"] for r in ranked] == ["B", "A", "C", "D"]


@pytest.mark.parametrize("width", [1, 2, 512])
def test_frames_carry_absent_cars_over_slices(spark, width):
    samples = [
        ("r", 1, "A", 1, 11), ("r", 1, "B", 2, 12),
        ("r", 2, "B", 1, 22),
        ("r", 5, "A", 2, 51), ("r", 5, "B", 1, 52),
        ("r", 6, "A", 1, 61),
    ]
    frames = spark.createDataFrame(
        samples, "race_id string, snapshot_id int, car_id string, race_position int, v int"
    )
    entered = spark.createDataFrame([("r", "A"), ("r", "B")], "race_id string, car_id string")
    got = {
        (r["snapshot_id"], r["car_id"]): (r["complete"], r["stale"], r["race_position"], r["v"])
        for r in order.frames_batch(frames, entered, width).collect()
    }
    assert got == {
        (1, "A"): (True, False, 1, 11), (1, "B"): (True, False, 2, 12),
        (2, "A"): (False, True, 1, 11), (2, "B"): (False, False, 2, 22),
        (5, "A"): (True, False, 2, 51), (5, "B"): (True, False, 1, 52),
        (6, "A"): (False, False, 2, 61), (6, "B"): (False, True, 1, 52),
    }
    moves = order.position_changes(frames, width).filter("car_id = 'B'").orderBy("snapshot_id")
    assert [(r["race_position"], r["previous_position"]) for r in moves.collect()] == [
        (2, None), (1, 2), (1, 1),
    ]


@pytest.mark.parametrize("width", [3, 1000])
def test_revisions_number_a_hot_race_over_slices(spark, width):
    events = [("r", f"e{i:03d}", (i * 7) % 50) for i in range(50)] + [("s", "x", 4)]
    frame = spark.createDataFrame(
        events, "race_id string, event_id string, simulation_time_us bigint"
    )
    got = {r["event_id"]: r["revision"] for r in order.event_revision(frame, slice_us=width).collect()}
    ordered = sorted(events[:50], key=lambda e: (e[2], e[1]))
    assert got == {e[1]: i for i, e in enumerate(ordered, 1)} | {"x": 1}


@pytest.mark.parametrize("slice_us", [1_500_000, 10**9])
def test_a_step_may_pass_several_lines(spark, slice_us):
    samples = spark.createDataFrame(
        [("r", "c", 0, 0.0), ("r", "c", 1_000_000, 4309.0 * 0.05), ("r", "c", 2_000_000, 4309.0 * 1.05)],
        "race_id string, car_id string, simulation_time_us bigint, distance_m double",
    )
    got = crossings.crossing_times(samples, track_column(), slice_us).orderBy("crossing_us").collect()
    assert [(r["lap"], r["checkpoint_id"]) for r in got][:1] == [(1, "P01")]
    assert len(got) == 1 + 18
    finish = next(r for r in got if r["checkpoint_id"] == "SF")
    assert (finish["lap"], finish["crossing_us"]) == (1, 1_950_000)


@pytest.mark.parametrize("slice_us", [5, 1000])
def test_neutralised_crossings_with_an_open_period(spark, slice_us):
    marks = spark.createDataFrame(
        [("r", "safety_car_started", 10), ("r", "safety_car_ended", 20),
         ("r", "safety_car_started", 40), ("s", "time_penalty", 1)],
        "race_id string, reason string, simulation_time_us bigint",
    )
    seen = spark.createDataFrame(
        [("r", t) for t in (9, 10, 15, 20, 39, 40, 999)] + [("s", 15)],
        "race_id string, simulation_time_us bigint",
    )
    inside = crossings.neutralized_crossings(seen, marks, slice_us).collect()
    assert sorted(r["simulation_time_us"] for r in inside) == [10, 15, 40, 999]

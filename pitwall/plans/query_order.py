"""Running order, frame and revision queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitwall.operators import lifecycle, order
from pitwall.plans.registry import query

PENALTIES = """SELECT race_id, car_id, CAST(sum(penalty_seconds) AS BIGINT) AS penalty_seconds
    FROM incidents WHERE penalty_status = 'applied' GROUP BY race_id, car_id"""


@query("penalty_totals", PENALTIES)
def _(t):
    return lifecycle.penalty_totals(t("incidents"))


@query(
    "running_order",
    f"""SELECT f.race_id, f.snapshot_id, f.car_id, CAST(row_number() OVER (
               PARTITION BY f.race_id, f.snapshot_id ORDER BY f.distance_m DESC,
               f.finished_at + coalesce(p.penalty_seconds, 0) ASC NULLS LAST, f.car_id) AS INT)
               AS position
        FROM frames f LEFT JOIN ({PENALTIES}) p
          ON p.race_id = f.race_id AND p.car_id = f.car_id""",
)
def _(t):
    penalties = lifecycle.penalty_totals(t("incidents"))
    return order.running_order(t("frames"), penalties).select(
        "race_id", "snapshot_id", "car_id", "position"
    )


@query(
    "display_order",
    """SELECT race_id, snapshot_id, car_id, CAST(row_number() OVER (
              PARTITION BY race_id, snapshot_id
              ORDER BY distance_m DESC, race_position, car_id) AS INT) AS display_position
       FROM frames""",
)
def _(t):
    return order.display_order(t("frames")).select(
        "race_id", "snapshot_id", "car_id", "display_position"
    )


@query(
    "lap_ranking",
    """SELECT race_id, snapshot_id, car_id, CAST(row_number() OVER (
              PARTITION BY race_id, snapshot_id ORDER BY lap + track_progress DESC, car_id)
              AS INT) AS lap_rank FROM frames""",
)
def _(t):
    return order.lap_ranking(t("frames")).select("race_id", "snapshot_id", "car_id", "lap_rank")


@query(
    "leader_gap_by_distance",
    """SELECT f.race_id, f.snapshot_id, f.car_id, CAST(floor(greatest(0.0,
              (l.lap - 1 + l.track_progress) - (f.lap - 1 + f.track_progress)) * 90000 + 0.5)
              AS BIGINT) AS leader_gap_ms
       FROM frames f JOIN frames l ON l.race_id = f.race_id AND l.snapshot_id = f.snapshot_id
        AND l.race_position = 1""",
)
def _(t):
    return order.leader_gap_by_distance(t("frames")).select(
        "race_id", "snapshot_id", "car_id", "leader_gap_ms"
    )


@query(
    "position_changes",
    """SELECT race_id, car_id, snapshot_id, race_position, previous_position,
              previous_position - race_position AS places_gained
       FROM (SELECT *, lag(race_position) OVER (PARTITION BY race_id, car_id
                    ORDER BY snapshot_id) AS previous_position FROM frames) p""",
)
def _(t):
    return order.position_changes(t("frames"))


_EXPECTED = "SELECT race_id, count(*) AS n FROM race_participants GROUP BY race_id"


@query(
    "frame_completeness",
    f"""SELECT f.race_id, f.snapshot_id, count(DISTINCT f.car_id) AS present_cars,
               e.n AS expected_cars, e.n - count(DISTINCT f.car_id) AS missing_cars,
               e.n = count(DISTINCT f.car_id) AS complete
        FROM frames f JOIN ({_EXPECTED}) e ON e.race_id = f.race_id
        GROUP BY f.race_id, f.snapshot_id, e.n""",
)
def _(t):
    return order.frame_completeness(t("frames"), t("race_participants"))


@query(
    "frame_position_check",
    f"""SELECT f.race_id, f.snapshot_id, e.n AS expected_cars,
               (count(DISTINCT f.race_position) = e.n AND min(f.race_position) = 1
                AND max(f.race_position) = e.n) AS ok
        FROM frames f JOIN ({_EXPECTED}) e ON e.race_id = f.race_id
        GROUP BY f.race_id, f.snapshot_id, e.n HAVING count(DISTINCT f.car_id) = e.n""",
)
def _(t):
    return order.frame_position_check(t("frames"), t("race_participants"))


@query(
    "latest_complete_frame",
    """SELECT race_id, car_id, snapshot_id, race_position, distance_m FROM (
         SELECT *, row_number() OVER (PARTITION BY race_id, car_id
                                      ORDER BY snapshot_id DESC) AS rn FROM frames) d
       WHERE rn = 1""",
)
def _(t):
    return order.latest_complete_frame(t("frames")).select(
        "race_id", "car_id", "snapshot_id", "race_position", "distance_m"
    )


FRAMES_BATCH = f"""SELECT race_id, snapshot_id, car_id, complete, stale,
    coalesce(settled, first_position) AS race_position, laps_completed
    FROM (SELECT g.race_id, g.snapshot_id, g.car_id, g.complete, f.car_id IS NULL AS stale,
                 last_value(CASE WHEN g.complete THEN f.race_position END IGNORE NULLS) OVER w
                   AS settled,
                 first_value(f.race_position IGNORE NULLS) OVER w AS first_position,
                 last_value(f.laps_completed IGNORE NULLS) OVER w AS laps_completed
          FROM (SELECT s.race_id, s.snapshot_id, p.car_id, s.c = e.n AS complete
                FROM (SELECT race_id, snapshot_id, count(*) AS c FROM frames
                      GROUP BY race_id, snapshot_id) s
                JOIN race_participants p ON p.race_id = s.race_id
                JOIN ({_EXPECTED}) e ON e.race_id = s.race_id) g
          LEFT JOIN frames f ON f.race_id = g.race_id AND f.snapshot_id = g.snapshot_id
               AND f.car_id = g.car_id
          WINDOW w AS (PARTITION BY g.race_id, g.car_id ORDER BY g.snapshot_id
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) q
    WHERE laps_completed IS NOT NULL"""


@query("frames_batch", FRAMES_BATCH)
def _(t):
    return order.frames_batch(t("frames"), t("race_participants")).select(
        "race_id", "snapshot_id", "car_id", "complete", "stale", "race_position", "laps_completed"
    )


@query(
    "on_track_cars",
    """SELECT race_id, snapshot_id, car_id, car_status FROM frames WHERE car_status <> 'retired'""",
)
def _(t):
    return order.on_track_cars(t("frames")).select(
        "race_id", "snapshot_id", "car_id", "car_status"
    )


@query(
    "event_revision",
    """SELECT event_id, race_id, CAST(row_number() OVER (PARTITION BY race_id
              ORDER BY simulation_time_us, event_id) AS BIGINT) AS revision FROM telemetry""",
)
def _(t):
    return order.event_revision(t("telemetry")).select("event_id", "race_id", "revision")


@query(
    "state_document",
)
def _(t):
    from pitwall.operators.projections import state_document

    return state_document(order.frames_batch(t("frames"), t("race_participants")))


@query(
    "flatten_state_cars",
    f"""SELECT race_id, snapshot_id AS frame_snapshot_id, car_id, race_position, laps_completed
        FROM ({FRAMES_BATCH}) f WHERE complete""",
)
def _(t):
    from pitwall.operators.projections import flatten_state_cars, state_document

    state = state_document(order.frames_batch(t("frames"), t("race_participants")))
    return flatten_state_cars(state).select(
        "race_id", "frame_snapshot_id", "car_id", "race_position",
        F.col("laps_completed"),
    )

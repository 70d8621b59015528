"""Split, sector, gap and crossing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitwall.functions import INTERLAGOS, track_column, track_lines
from pitwall.operators import crossings, gaps, timing
from pitwall.plans.registry import query

_OK = "valid AND NOT pit_lap"


@query(
    "checkpoint_bests",
    f"""SELECT 'personal' AS scope, race_id, car_id AS subject, checkpoint_id,
               min(segment_time_ms) AS best_ms
        FROM timing WHERE {_OK} GROUP BY race_id, car_id, checkpoint_id
        UNION ALL
        SELECT 'team', race_id, team_id, checkpoint_id, min(segment_time_ms)
        FROM timing WHERE {_OK} GROUP BY race_id, team_id, checkpoint_id
        UNION ALL
        SELECT 'race', race_id, '', checkpoint_id, min(segment_time_ms)
        FROM timing WHERE {_OK} GROUP BY race_id, checkpoint_id""",
)
def _(t):
    return timing.checkpoint_bests(t("timing"))


SECTOR_BESTS = f"""SELECT race_id, car_id,
    min(sector_time_ms) FILTER (WHERE sector = 1) AS s1_ms,
    min(sector_time_ms) FILTER (WHERE sector = 2) AS s2_ms,
    min(sector_time_ms) FILTER (WHERE sector = 3) AS s3_ms
    FROM timing WHERE {_OK} AND sector > 0 GROUP BY race_id, car_id"""


@query("sector_bests", SECTOR_BESTS)
def _(t):
    return timing.sector_bests(t("timing")).drop("sector_best_ms")


@query(
    "theoretical_lap",
    f"SELECT race_id, car_id, s1_ms + s2_ms + s3_ms AS theoretical_lap_ms FROM ({SECTOR_BESTS}) b",
)
def _(t):
    return timing.theoretical_lap(timing.sector_bests(t("timing")))


_LATEST = """SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY race_id, car_id, checkpoint_id ORDER BY lap DESC) AS rn FROM timing) d
    WHERE rn = 1"""


@query(
    "latest_split",
    f"SELECT race_id, car_id, checkpoint_id, lap, segment_time_ms, valid FROM ({_LATEST}) l",
)
def _(t):
    return timing.latest_split(t("timing")).select(
        "race_id", "car_id", "checkpoint_id", "lap", "segment_time_ms", "valid"
    )


SPLITS = f"""SELECT l.race_id, l.car_id, l.team_id, l.checkpoint_id, l.lap, l.segment_time_ms,
    l.lap_elapsed_ms, p.b AS best_personal_ms, tm.b AS best_team_ms, r.b AS best_race_ms,
    l.segment_time_ms - p.b AS delta_ms,
    CASE WHEN NOT (l.valid AND NOT l.pit_lap) THEN 'gray' WHEN l.segment_time_ms <= r.b THEN 'purple'
         WHEN l.segment_time_ms <= p.b THEN 'green' ELSE 'yellow' END AS color,
    (l.valid AND NOT l.pit_lap) AS valid
    FROM ({_LATEST}) l
    LEFT JOIN (SELECT race_id, car_id, checkpoint_id, min(segment_time_ms) AS b FROM timing
               WHERE {_OK} GROUP BY 1, 2, 3) p
      ON p.race_id = l.race_id AND p.car_id = l.car_id AND p.checkpoint_id = l.checkpoint_id
    LEFT JOIN (SELECT race_id, team_id, checkpoint_id, min(segment_time_ms) AS b FROM timing
               WHERE {_OK} GROUP BY 1, 2, 3) tm
      ON tm.race_id = l.race_id AND tm.team_id = l.team_id AND tm.checkpoint_id = l.checkpoint_id
    LEFT JOIN (SELECT race_id, checkpoint_id, min(segment_time_ms) AS b FROM timing
               WHERE {_OK} GROUP BY 1, 2) r
      ON r.race_id = l.race_id AND r.checkpoint_id = l.checkpoint_id"""


@query("splits_with_bests", SPLITS)
def _(t):
    return timing.splits_with_bests(t("timing"))


@query(
    "split_color",
    f"""SELECT t.event_id, CASE WHEN NOT (t.valid AND NOT t.pit_lap) THEN 'gray'
               WHEN t.segment_time_ms <= r.b THEN 'purple'
               WHEN t.segment_time_ms <= p.b THEN 'green' ELSE 'yellow' END AS color
        FROM timing t
        LEFT JOIN (SELECT race_id, car_id, checkpoint_id, min(segment_time_ms) AS b FROM timing
                   WHERE {_OK} GROUP BY 1, 2, 3) p
          ON p.race_id = t.race_id AND p.car_id = t.car_id AND p.checkpoint_id = t.checkpoint_id
        LEFT JOIN (SELECT race_id, checkpoint_id, min(segment_time_ms) AS b FROM timing
                   WHERE {_OK} GROUP BY 1, 2) r
          ON r.race_id = t.race_id AND r.checkpoint_id = t.checkpoint_id""",
)
def _(t):
    from pitwall.functions import split_color

    crossings_ = t("timing")
    bests = timing.checkpoint_bests(crossings_)
    own = bests.filter("scope = 'personal'").select(
        "race_id", "checkpoint_id", F.col("subject").alias("car_id"), F.col("best_ms").alias("own")
    )
    race = bests.filter("scope = 'race'").select(
        "race_id", "checkpoint_id", F.col("best_ms").alias("race")
    )
    joined = crossings_.join(own, ["race_id", "checkpoint_id", "car_id"], "left").join(
        race, ["race_id", "checkpoint_id"], "left"
    )
    color = split_color(
        timing.counts_for_records(), F.col("segment_time_ms"), F.col("own"), F.col("race")
    )
    return joined.select("event_id", color.alias("color"))


@query(
    "split_progression",
    """SELECT event_id, race_id, car_id, checkpoint_id, lap, segment_time_ms,
              CASE WHEN NOT ok THEN 'gray'
                   WHEN race_best IS NULL OR segment_time_ms <= race_best THEN 'purple'
                   WHEN own_best IS NULL OR segment_time_ms < own_best THEN 'green'
                   ELSE 'yellow' END AS color, segment_time_ms - own_best AS delta_ms
       FROM (SELECT *, min(CASE WHEN ok THEN segment_time_ms END) OVER (
                 PARTITION BY race_id, checkpoint_id
                 ORDER BY simulation_time_us, car_id, lap, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS race_best,
               min(CASE WHEN ok THEN segment_time_ms END) OVER (
                 PARTITION BY race_id, car_id, checkpoint_id
                 ORDER BY simulation_time_us, lap, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS own_best
             FROM (SELECT *, (valid AND NOT pit_lap) AS ok FROM timing) a) b""",
)
def _(t):
    return timing.split_progression(t("timing")).select(
        "event_id", "race_id", "car_id", "checkpoint_id", "lap", "segment_time_ms", "color",
        "delta_ms",
    )


_LINE_VALUES = ", ".join(
    [f"(CAST({p} AS DOUBLE), 'P{i:02d}', 0)" for i, p in enumerate(INTERLAGOS["checkpoints"], 1)]
    + [f"(CAST({p} AS DOUBLE), 'S{i}', {i})" for i, p in enumerate(INTERLAGOS["sector_ends"][:2], 1)]
    + ["(CAST(1.0 AS DOUBLE), 'SF', 3)"]
)
LINES_SQL = f"(VALUES {_LINE_VALUES}) AS k(fraction, checkpoint_id, sector)"


def lines_frame(spark):
    """Timing lines of the circuit as a table."""
    return spark.range(1).select(F.inline(track_lines(track_column())))


@query(
    "splits_by_track_position",
    f"""SELECT race_id, car_id, checkpoint_id, segment_time_ms, line_position,
               CAST(row_number() OVER (PARTITION BY race_id, car_id
                    ORDER BY line_position, checkpoint_id) AS INT) AS line_rank
        FROM (SELECT s.race_id, s.car_id, s.checkpoint_id, s.segment_time_ms,
                     coalesce(k.fraction, 2.0) AS line_position
              FROM ({SPLITS}) s LEFT JOIN {LINES_SQL} ON k.checkpoint_id = s.checkpoint_id) p""",
)
def _(t):
    splits = timing.splits_with_bests(t("timing"))
    return timing.splits_by_track_position(splits, lines_frame(t.spark)).select(
        "race_id", "car_id", "checkpoint_id", "segment_time_ms", "line_position", "line_rank"
    )


@query(
    "reference_window_state",
    """SELECT t.event_id, t.race_id, t.car_id, t.lap, t.checkpoint_id FROM timing t
       JOIN (SELECT race_id, max(lap) AS m FROM timing GROUP BY race_id) x
         ON x.race_id = t.race_id WHERE t.lap >= x.m - 2""",
)
def _(t):
    return timing.recent_laps(t("timing")).select(
        "event_id", "race_id", "car_id", "lap", "checkpoint_id"
    )


_POINTS = """SELECT race_id, lap, checkpoint_id, min(simulation_time_us) AS leader_us,
    max(simulation_time_us) AS last_us
    FROM (SELECT t.race_id, t.lap, t.checkpoint_id, t.simulation_time_us,
                 lag(t.simulation_time_us) OVER (PARTITION BY t.race_id, t.lap, t.checkpoint_id
                     ORDER BY o.race_position) AS before_us, f.n
          FROM timing_cut t
          JOIN (SELECT race_id, max(lap) AS m FROM timing_cut GROUP BY race_id) x
            ON x.race_id = t.race_id AND t.lap >= x.m - 2
          JOIN order_cut o ON o.race_id = t.race_id AND o.car_id = t.car_id
          JOIN (SELECT race_id, count(*) AS n FROM order_cut GROUP BY race_id) f
            ON f.race_id = t.race_id) c
    GROUP BY race_id, lap, checkpoint_id, n
    HAVING count(*) = n AND bool_and(before_us IS NULL OR before_us <= simulation_time_us)"""

_REFERENCE = f"""SELECT race_id, lap, checkpoint_id, leader_us, last_us
    FROM (SELECT *, row_number() OVER (PARTITION BY race_id
                 ORDER BY leader_us DESC, lap DESC, checkpoint_id DESC) AS rn FROM ({_POINTS}) p) r
    WHERE rn = 1"""


@query("gap_reference", _REFERENCE)
def _(t):
    return gaps.gap_reference(t("timing_cut"), t("order_cut"))


GAPS = f"""SELECT o.race_id, o.car_id, o.race_position,
    CAST(round_even((t.simulation_time_us - r.leader_us) / 1000, 0) AS BIGINT) AS gap_to_leader_ms,
    CAST(round_even((t.simulation_time_us - lag(t.simulation_time_us) OVER (
        PARTITION BY o.race_id ORDER BY o.race_position)) / 1000, 0) AS BIGINT)
        AS interval_to_ahead_ms,
    coalesce(concat(CAST(r.lap AS STRING), ':') || r.checkpoint_id, '') AS gap_reference,
    CASE WHEN r.race_id IS NOT NULL THEN
        greatest(0, CAST(round_even((f.now_us - r.last_us) / 1000, 0) AS BIGINT)) END
        AS gap_reference_age_ms,
    CAST(greatest(0, f.leader_laps - o.laps_completed) AS BIGINT) AS laps_behind
    FROM order_cut o
    JOIN (SELECT race_id, max(simulation_time_us) AS now_us,
                 arg_min(laps_completed, race_position) AS leader_laps
          FROM order_cut GROUP BY race_id) f ON f.race_id = o.race_id
    LEFT JOIN ({_REFERENCE}) r ON r.race_id = o.race_id
    LEFT JOIN timing_cut t ON t.race_id = r.race_id AND t.car_id = o.car_id AND t.lap = r.lap
         AND t.checkpoint_id = r.checkpoint_id"""


@query("gaps", GAPS)
def _(t):
    return gaps.gaps(t("timing_cut"), t("order_cut"))


@query(
    "laps_behind",
    """SELECT race_id, car_id, race_position,
              CAST(greatest(0, first_value(laps_completed) OVER (PARTITION BY race_id
                   ORDER BY race_position) - laps_completed) AS BIGINT) AS laps_behind
       FROM final_state""",
)
def _(t):
    return gaps.laps_behind(t("final_state"))


@query(
    "crossing_times",
    f"""SELECT race_id, car_id, CAST(g.i + 1 AS INT) AS lap, k.checkpoint_id, k.sector,
               CAST(round_even(from_us + ((g.i + k.fraction) * 4309.0 - from_m)
                    / (distance_m - from_m) * (simulation_time_us - from_us), 0) AS BIGINT)
                 AS crossing_us
        FROM (SELECT race_id, car_id, simulation_time_us, distance_m,
                     lag(simulation_time_us) OVER w AS from_us, lag(distance_m) OVER w AS from_m
              FROM telemetry
              WINDOW w AS (PARTITION BY race_id, car_id ORDER BY simulation_time_us)) s,
             unnest(range(CAST(floor(from_m / 4309.0) AS BIGINT),
                          CAST(floor(distance_m / 4309.0) AS BIGINT) + 1)) AS g(i)
        CROSS JOIN {LINES_SQL}
        WHERE from_m < (g.i + k.fraction) * 4309.0 AND (g.i + k.fraction) * 4309.0 <= distance_m""",
)
def _(t):
    return crossings.crossing_times(t("telemetry"), INTERLAGOS)


@query(
    "neutralized_crossings",
    """SELECT DISTINCT t.event_id, t.race_id, t.car_id, t.lap, t.checkpoint_id
       FROM timing t
       JOIN (SELECT race_id, reason, simulation_time_us AS from_us,
                    lead(simulation_time_us) OVER (PARTITION BY race_id
                         ORDER BY simulation_time_us, reason) AS to_us
             FROM incidents WHERE reason IN ('safety_car_started', 'safety_car_ended')) p
         ON p.race_id = t.race_id AND p.reason = 'safety_car_started'
        AND t.simulation_time_us >= p.from_us
        AND (p.to_us IS NULL OR t.simulation_time_us < p.to_us)""",
)
def _(t):
    return crossings.neutralized_crossings(t("timing"), t("incidents")).select(
        "event_id", "race_id", "car_id", "lap", "checkpoint_id"
    )


@query(
    "pit_lane_durations",
    """SELECT race_id, car_id, stop_number,
              max(CASE WHEN phase = 'exit' THEN pit_stop_time_ms END)
                - max(CASE WHEN phase = 'entry' THEN pit_stop_time_ms END) AS pit_lane_ms,
              max(CASE WHEN phase = 'service_finished' THEN pit_stop_time_ms END)
                - max(CASE WHEN phase = 'service_started' THEN pit_stop_time_ms END) AS service_ms,
              max(fuel_added_kg) AS fuel_added_kg, bool_or(phase = 'exit') AS completed
       FROM pitstops GROUP BY race_id, car_id, stop_number""",
)
def _(t):
    return crossings.pit_lane_durations(t("pitstops"))

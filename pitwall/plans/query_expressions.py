"""Scalar and nested-column expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitwall import functions as fn
from pitwall.plans.query_gold import FLAG_SQL
from pitwall.plans.query_timing import LINES_SQL
from pitwall.plans.registry import query


@query(
    "country_flag",
    f"SELECT car_id, driver_country_code, {FLAG_SQL.format('driver_country_code')} AS flag FROM car_config",
)
def _(t):
    code = F.col("driver_country_code")
    return t("car_config").select("car_id", code, fn.country_flag(code).alias("flag"))


@query(
    "format_gap",
    """SELECT event_id, CASE WHEN gap IS NULL THEN '--:--.---' ELSE
              concat('+', CAST(gap // 60000 AS STRING), ':',
                     lpad(CAST(gap % 60000 // 1000 AS STRING), 2, '0'), '.',
                     lpad(CAST(gap % 1000 AS STRING), 3, '0')) END AS gap_text
       FROM (SELECT event_id, CASE WHEN valid THEN simulation_time_us // 1000 END AS gap
             FROM timing) g""",
)
def _(t):
    gap = F.when(F.col("valid"), F.floor(F.col("simulation_time_us") / 1000))
    return t("timing").select("event_id", fn.format_gap(gap).alias("gap_text"))


@query(
    "format_lap_time",
    """SELECT event_id, CASE WHEN ms IS NULL THEN '—' ELSE
              concat(CAST(CAST(floor(ms / 60000) AS BIGINT) AS STRING), ':',
                     lpad(CAST(CAST(floor(ms % 60000 / 1000) AS BIGINT) AS STRING), 2, '0'), '.',
                     CASE WHEN floor(ms % 1000 + 0.5) >= 1000 THEN '1000' ELSE
                     lpad(CAST(CAST(floor(ms % 1000 + 0.5) AS BIGINT) AS STRING), 3, '0') END)
              END AS lap_text
       FROM (SELECT event_id, CASE WHEN valid THEN CAST(lap_time_ms AS DOUBLE) / 2 + 0.25 END AS ms
             FROM laps) l""",
)
def _(t):
    ms = F.when(F.col("valid"), F.col("lap_time_ms") / 2 + F.lit(0.25))
    return t("laps").select("event_id", fn.format_lap_time(ms).alias("lap_text"))


@query(
    "team_label",
    """SELECT event_id, team_id, CASE WHEN regexp_matches(team_id, '^TEAM-([ABC])-([0-9]+)$')
              THEN concat('Equipe ', regexp_extract(team_id, '^TEAM-([ABC])-([0-9]+)$', 1),
                   CAST(CAST(regexp_extract(team_id, '^TEAM-([ABC])-([0-9]+)$', 2) AS INT) AS STRING))
              ELSE team_id END AS label
       FROM (SELECT event_id, CASE WHEN valid THEN team_id ELSE concat(team_id, 'x') END AS team_id
             FROM laps) l""",
)
def _(t):
    named = F.when(F.col("valid"), F.col("team_id")).otherwise(
        F.concat(F.col("team_id"), F.lit("x"))
    )
    laps = t("laps").select("event_id", named.alias("team_id"))
    return laps.withColumn("label", fn.team_label(F.col("team_id")))


@query(
    "medal",
    """SELECT race_id, car_id, race_position,
              CASE race_position WHEN 1 THEN 'ouro' WHEN 2 THEN 'prata' WHEN 3 THEN 'bronze' END
                AS medal FROM final_state""",
)
def _(t):
    position = F.col("race_position")
    return t("final_state").select("race_id", "car_id", position, fn.medal(position).alias("medal"))


@query(
    "trophy",
    """SELECT race_id, car_id, race_position, CASE WHEN race_position <= 3 THEN '🏆' END AS trophy
       FROM final_state""",
)
def _(t):
    position = F.col("race_position")
    return t("final_state").select(
        "race_id", "car_id", position, fn.trophy(position).alias("trophy")
    )


@query(
    "event_date",
    "SELECT event_id, CAST(ts AS DATE) AS event_date_utc FROM events",
)
def _(t):
    return t("events").select("event_id", fn.event_date(F.col("ts")).alias("event_date_utc"))


@query(
    "track_lines",
    f"""SELECT o.race_id, o.car_id, k.fraction, k.checkpoint_id, k.sector
        FROM final_state o CROSS JOIN {LINES_SQL}""",
)
def _(t):
    lines = F.inline(fn.track_lines(fn.track_column()))
    return t("final_state").select("race_id", "car_id", lines)


_CORNERS = ", ".join(
    f"(CAST({start} AS DOUBLE), CAST({end} AS DOUBLE), CAST({radius} AS DOUBLE))"
    for start, end, radius in fn.INTERLAGOS["corners"]
)
CORNERS_SQL = f"(VALUES {_CORNERS}) AS c(c_start, c_end, radius)"


@query(
    "corner_radius_at",
    f"""SELECT event_id, track_progress, radius FROM telemetry LEFT JOIN {CORNERS_SQL}
        ON c_start <= track_progress % 1 AND track_progress % 1 < c_end""",
)
def _(t):
    radius = fn.corner_radius_at(fn.track_column(), F.col("track_progress"))
    return t("telemetry").select("event_id", "track_progress", radius.alias("radius"))


@query(
    "corner_speed_limit",
    f"""SELECT event_id, round(least(min(speed_kmh), min(sqrt(
               2.8 * 1.0 * 9.80665 * abs(radius) + 2 * 22.0 *
               CASE WHEN c_start <= track_progress AND track_progress < c_end THEN 0.0
                    ELSE ((c_start - track_progress) % 1 + 1) % 1 * 4309.0 END))), 6) AS speed_limit
        FROM telemetry CROSS JOIN {CORNERS_SQL} GROUP BY event_id""",
)
def _(t):
    limit = fn.corner_speed_limit(
        fn.track_column(), F.col("track_progress"), F.col("speed_kmh")
    )
    return t("telemetry").select("event_id", F.round(limit, 6).alias("speed_limit"))


@query(
    "grip_lookup",
    """SELECT car_id, tire_compound, CASE tire_compound WHEN 'soft' THEN 1.01 WHEN 'medium' THEN 1.0
              WHEN 'hard' THEN 0.99 ELSE 0.98 END::DOUBLE AS grip FROM car_config""",
)
def _(t):
    grip = fn.grip_lookup(fn.track_column()["tire_grip_factors"], F.col("tire_compound"))
    return t("car_config").select("car_id", "tire_compound", grip.alias("grip"))


@query(
    "telemetry_features",
    """SELECT event_id, progress AS track_progress,
              CAST(greatest(0, floor(distance_m / 4309.0)) AS INT) AS laps_completed,
              CAST(1 + (progress >= 0.34)::INT + (progress >= 0.76)::INT AS INT) AS sector,
              CAST(greatest(1, least(8, floor(speed_kmh / 42) + 1)) AS INT) AS gear,
              CAST(1000 + round_even(speed_kmh % 42 / 42 * 5000, 0) AS INT) AS rpm,
              CASE WHEN brake > 0 THEN 'braking' WHEN coalesce(g_lateral, 0) <> 0 THEN 'corner'
                   ELSE 'straight' END AS driving_phase,
              sqrt(g_longitudinal * g_longitudinal + g_lateral * g_lateral) AS g_horizontal
       FROM (SELECT *, (distance_m / 4309.0) % 1 AS progress FROM telemetry) s""",
)
def _(t):
    return fn.telemetry_features(t("telemetry")).select(
        "event_id", "track_progress", "laps_completed", "sector", "gear", "rpm", "driving_phase",
        "g_horizontal",
    )


@query(
    "lap_time_estimate",
    """SELECT car_id, age, CASE WHEN tire_compound <> 'slick' THEN greatest(60000,
              CAST(round_even(90000.0::DOUBLE + ((car_weight_kg - 820.0) * 4.0
                   + (driver_weight_kg - 75.0) * 3.0) + (330.0 - top_speed_kmh) * 18.0
                   + CASE tire_compound WHEN 'soft' THEN -250 WHEN 'hard' THEN 300 ELSE 0 END
                   + age * 15.0, 0) AS BIGINT)) END AS estimate_ms
       FROM (SELECT *, CAST(car_weight_kg AS INT) % 30 AS age FROM car_config) c""",
)
def _(t):
    cars = t("car_config").withColumn("age", F.col("car_weight_kg").cast("int") % 30)
    estimate = fn.lap_time_estimate(
        F.col("car_weight_kg"),
        F.col("driver_weight_kg"),
        F.col("top_speed_kmh"),
        F.col("tire_compound"),
        F.col("age"),
    )
    return cars.select("car_id", "age", estimate.alias("estimate_ms"))

"""Adapter views: the event tables the operators expect, derived from the shared tables.

Each view is plain SQL that Spark and DuckDB accept unchanged, except for fan-out over a short
literal list, which is a generator in Spark and a join with VALUES in DuckDB.  The views are test
inputs; operators take DataFrames and know nothing about them.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from pitwall.sources.storage import COMPRESSION, scratch, shuffles_dropped

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# view -> (column names, rows) used as {fan:...} inside the view texts
_FANS = {
    "lines": (
        ("checkpoint_id", "sector", "cum", "prev_cum", "sector_cum"),
        (
            ("P01", 0, 150, 0, 0), ("S1", 1, 340, 150, 0), ("P02", 0, 550, 340, 340),
            ("S2", 2, 760, 550, 340), ("P03", 0, 900, 760, 760), ("SF", 3, 1000, 900, 760),
        ),
    ),
    "revisions": (("revision",), ((1,), (2,))),
    "sequences": (("seq",), ((1,), (2,))),
}

_RACE = "concat('race-', CAST(CAST(floor({0} / 300) AS BIGINT) AS STRING))"
_CAR = "concat('CAR-', lpad(CAST({0} % 20 + 1 AS STRING), 2, '0'))"
_RACE_NUMBER = "CAST(substr(race_id, 6) AS BIGINT)"

_VIEWS = {
    # lap facts with replays: several rows per event id, with other content and offset
    "laps_raw": f"""
        SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS event_id,
               {_RACE.format('l_orderkey')} AS race_id, {_CAR.format('l_suppkey')} AS car_id,
               concat('TEAM-A-0', CAST(l_suppkey % 20 % 5 + 1 AS STRING)) AS team_id,
               CAST(floor(l_extendedprice) AS BIGINT) AS lap_time_ms,
               l_returnflag <> 'R' AS valid, (l_linestatus = 'F' AND l_linenumber = 1) AS pit_lap,
               l_discount >= 0.095 AS neutralized, l_shipdate AS event_time, l_orderkey,
               l_linenumber, CAST(l_orderkey % 6 AS INT) AS kafka_partition,
               (CAST(floor(l_orderkey / 6) AS BIGINT) * 8 + l_linenumber) * 10500000
                 + CAST(floor(l_extendedprice * 100) AS BIGINT) AS kafka_offset,
               CAST(floor(l_orderkey / 100) AS INT) AS batch_id
        FROM lineitem""",
    # one row per event id, lap number per race and car
    "laps": """
        SELECT event_id, race_id, car_id, team_id, lap_time_ms, valid, pit_lap, neutralized,
               event_time, kafka_partition, kafka_offset, batch_id,
               CAST(row_number() OVER (PARTITION BY race_id, car_id
                                       ORDER BY l_orderkey, l_linenumber) AS INT) AS lap
        FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY kafka_partition,
                     kafka_offset, event_time, car_id, valid, pit_lap, neutralized) AS rn
              FROM laps_raw) d
        WHERE rn = 1""",
    # six timing lines per lap
    "timing": """
        SELECT concat(event_id, ':', checkpoint_id) AS event_id, race_id, car_id, team_id, lap,
               checkpoint_id, sector, lap_elapsed_ms,
               lap_elapsed_ms - prev_line_ms AS segment_time_ms,
               CASE WHEN sector > 0 THEN lap_elapsed_ms - prev_sector_ms END AS sector_time_ms,
               pit_lap, (neutralized AND checkpoint_id = 'P02') AS neutralized,
               (valid AND NOT (neutralized AND checkpoint_id = 'P02')) AS valid,
               CAST(lap_elapsed_ms % 21 AS INT) AS race_position,
               (start_ms + lap_elapsed_ms) * 1000 AS simulation_time_us
        FROM (SELECT l.event_id, l.race_id, l.car_id, l.team_id, l.lap, l.pit_lap, l.neutralized,
                     l.valid, c.checkpoint_id, c.sector,
                     CAST(floor(l.lap_time_ms * c.cum / 1000) AS BIGINT) AS lap_elapsed_ms,
                     CAST(floor(l.lap_time_ms * c.prev_cum / 1000) AS BIGINT) AS prev_line_ms,
                     CAST(floor(l.lap_time_ms * c.sector_cum / 1000) AS BIGINT) AS prev_sector_ms,
                     l.start_ms
              FROM (SELECT *, CAST(coalesce(sum(lap_time_ms) OVER (PARTITION BY race_id, car_id
                           ORDER BY lap ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                           AS BIGINT) AS start_ms FROM laps) l {fan:lines c}) t""",
    # crossings with a second report of every sector line under another event id
    "timing_resent": """
        SELECT * FROM timing
        UNION ALL
        SELECT concat(event_id, ':again') AS event_id, race_id, car_id, team_id, lap, checkpoint_id,
               sector, lap_elapsed_ms, segment_time_ms, sector_time_ms, pit_lap, neutralized,
               valid, race_position, simulation_time_us
        FROM timing WHERE sector > 0""",
    # one telemetry sample per race, car and snapshot
    "frames": """
        SELECT concat(event_id, ':frame') AS event_id, race_id, car_id, team_id,
               lap AS snapshot_id, lap AS laps_completed, lap, simulation_time_us,
               CAST(lap * 4309 + simulation_time_us % 7 AS DOUBLE) AS distance_m,
               CAST(simulation_time_us % 997 AS DOUBLE) / 1000 AS track_progress,
               CASE WHEN lap_elapsed_ms % 40 = 0 THEN 'retired' ELSE 'racing' END AS car_status,
               CASE WHEN lap >= 40 THEN CAST(simulation_time_us AS DOUBLE) / 1000000 END AS finished_at,
               CAST(row_number() OVER (PARTITION BY race_id, lap
                                       ORDER BY simulation_time_us, car_id) AS INT) AS race_position
        FROM timing WHERE checkpoint_id = 'SF'""",
    "race_participants": "SELECT DISTINCT race_id, car_id FROM laps",
    # pit phases with replays
    "pitstops": f"""
        SELECT CAST(o_orderkey AS STRING) AS event_id, {_RACE.format('o_orderkey')} AS race_id,
               {_CAR.format('o_custkey')} AS car_id, CAST(o_custkey % 3 + 1 AS INT) AS stop_number,
               CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'entry'
                    WHEN '2' THEN 'service_started' WHEN '3' THEN 'service_finished'
                    ELSE 'exit' END AS phase,
               CAST(o_orderkey % 60 AS INT) AS lap, o_totalprice / 10000 AS fuel_added_kg,
               CAST(floor(o_totalprice) AS BIGINT) AS pit_stop_time_ms
        FROM orders""",
    # archived broker records
    "envelopes": """
        SELECT ts AS kafka_timestamp, event_type AS topic, CAST(user_id % 6 AS INT) AS kafka_partition,
               event_id AS kafka_offset, CAST(user_id AS STRING) AS event_key, props AS payload,
               CAST(ts AS DATE) AS event_date_utc
        FROM events""",
    # the same with every purchase archived twice
    "envelopes_replay": """
        SELECT * FROM envelopes UNION ALL SELECT * FROM envelopes WHERE topic = 'purchase'""",
    # online summary with revisions, some of them wrong on purpose
    "online_analytics": """
        SELECT race_id, car_id, team_id, r.revision,
               CASE WHEN r.revision = 1 THEN 0 ELSE n END AS lap_count,
               CASE WHEN r.revision = 1 THEN NULL
                    ELSE b + (CASE WHEN car_id = 'CAR-03' THEN 1 ELSE 0 END) END AS best_lap_time_ms,
               CASE WHEN r.revision = 1 THEN NULL ELSE w END AS worst_lap_time_ms
        FROM (SELECT race_id, car_id, min(team_id) AS team_id, count(*) AS n, min(lap_time_ms) AS b,
                     max(lap_time_ms) AS w
              FROM laps WHERE valid GROUP BY race_id, car_id) a {fan:revisions r}""",
    # race lifecycle; one race in five is still running
    "control": f"""
        SELECT race_id, CASE WHEN s.seq = 1 THEN 'running' ELSE 'finished' END AS status,
               s.seq AS source_sequence, CAST(30 + {_RACE_NUMBER} % 40 AS INT) AS target_laps
        FROM (SELECT DISTINCT race_id FROM laps) r {{fan:sequences s}}
        WHERE s.seq = 1 OR {_RACE_NUMBER} % 5 <> 4""",
    "race_targets": "SELECT race_id, target_laps FROM control WHERE source_sequence = 1",
    # entrants
    "cars": f"""
        SELECT {_CAR.format('s_suppkey')} AS car_id,
               concat('DRV-', lpad(CAST(min(s_suppkey % 20 + 1) AS STRING), 2, '0')) AS driver_id,
               min(s_name) AS driver_name,
               concat('TEAM-A-0', CAST(min(s_suppkey % 20 % 5 + 1) AS STRING)) AS team_id,
               min(upper(substr(n_name, 1, 2))) AS driver_country_code
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        GROUP BY {_CAR.format('s_suppkey')}""",
    # newest frame per car with the counters the gold table falls back to
    "final_state": f"""
        SELECT f.race_id, f.car_id, f.team_id, c.driver_id, c.driver_name, c.driver_country_code,
               f.laps_completed, f.snapshot_id, f.distance_m, f.finished_at,
               CAST(row_number() OVER (PARTITION BY f.race_id ORDER BY f.distance_m DESC,
                    f.simulation_time_us, f.car_id) AS INT) AS race_position,
               l.b AS best_lap_time_ms, l.w AS worst_lap_time_ms,
               CAST(f.laps_completed % 4 AS INT) AS pit_stops,
               CASE WHEN CAST(substr(f.race_id, 6) AS BIGINT) % 5 <> 4 THEN 'finished'
                    ELSE 'running' END AS race_status
        FROM (SELECT *, row_number() OVER (PARTITION BY race_id, car_id
                                           ORDER BY snapshot_id DESC) AS rn FROM frames) f
        JOIN (SELECT race_id, car_id, min(lap_time_ms) AS b, max(lap_time_ms) AS w
              FROM laps GROUP BY race_id, car_id) l
          ON l.race_id = f.race_id AND l.car_id = f.car_id
        LEFT JOIN cars c ON c.car_id = f.car_id WHERE f.rn = 1""",
    # telemetry samples with out-of-range values on purpose
    "telemetry": f"""
        SELECT CAST(event_id AS STRING) AS event_id, 'telemetry' AS kind,
               concat('race-', CAST(user_id % 5 AS STRING)) AS race_id,
               {_CAR.format('user_id')} AS car_id, ts AS event_time,
               event_id * 1000000 AS simulation_time_us, value AS speed_kmh, value / 4 AS fuel_kg,
               CAST(event_id % 1001 AS DOUBLE) / 1000 AS track_progress,
               CAST(user_id % 20 AS INT) AS race_position,
               CASE event_type WHEN 'error' THEN 'red' WHEN 'signup' THEN 'safety_car'
                    ELSE 'green' END AS track_status,
               CAST(event_id AS DOUBLE) * 37.5 AS distance_m,
               CAST(CASE WHEN event_type = 'click' THEN 0.5 ELSE 0.0 END AS DOUBLE) AS brake,
               value / 200 - 1 AS g_longitudinal,
               CASE WHEN event_type <> 'view' THEN value / 300 END AS g_lateral
        FROM events""",
    # telemetry in the versioned contract, with a few broken fields
    "telemetry_contract": f"""
        SELECT CAST(event_id AS STRING) AS event_id, 'race.telemetry.v3' AS event_type,
               CASE WHEN event_type = 'error' THEN 2 ELSE 3 END AS schema_version,
               ts AS event_time, ts AS produced_at,
               concat('race-', CAST(user_id % 5 AS STRING)) AS race_id,
               {_CAR.format('user_id')} AS car_id,
               concat('DRV-', lpad(CAST(user_id % 20 + 1 AS STRING), 2, '0')) AS driver_id,
               value * 3 AS speed_kmh, CAST(event_id % 10 AS INT) AS gear,
               CAST(floor(value * 60) AS INT) AS rpm, value / 4 AS fuel_kg,
               480 + value AS car_weight_kg, CAST(event_id % 60 AS INT) AS lap,
               CAST(event_id % 3 + 1 AS INT) AS sector, value * 40 AS lap_distance_m,
               CAST(event_id % 1001 AS DOUBLE) / 1000 AS track_progress,
               CAST(user_id % 20 AS INT) AS race_position, value / 150 AS throttle,
               CAST(0 AS DOUBLE) AS brake,
               CASE event_type WHEN 'view' THEN 'slick' WHEN 'click' THEN 'soft'
                    ELSE 'hard' END AS tire_compound,
               CAST(event_id % 30 AS INT) AS tire_age_laps, 'on_track' AS pit_status,
               'straight' AS driving_phase, CAST(floor(value * 1000) AS BIGINT) AS current_lap_time_ms,
               CASE WHEN event_type <> 'signup' THEN CAST(floor(value * 1000) AS BIGINT) - 500 END
                 AS last_lap_time_ms,
               CAST(NULL AS BIGINT) AS best_lap_time_ms, value / 2 AS elapsed_race_seconds,
               60 AS target_laps, 'running' AS race_status,
               CASE WHEN event_type <> 'signup' THEN value - 1 END AS tire_pressure_psi,
               CAST(user_id % 3 AS INT) AS overtaking_lane,
               CASE WHEN event_type = 'purchase' THEN 1 END AS frontend_x
        FROM events""",
    # safety-car boundaries and time penalties
    "incidents": """
        SELECT concat(event_id, ':sc') AS event_id, race_id, '' AS car_id,
               CASE WHEN snapshot_id IN (5, 20) THEN 'safety_car_started'
                    ELSE 'safety_car_ended' END AS reason,
               snapshot_id AS lap, 0 AS penalty_seconds, 'none' AS penalty_status, simulation_time_us
        FROM frames WHERE race_position = 1 AND snapshot_id IN (5, 7, 20, 22)
        UNION ALL
        SELECT concat(event_id, ':pen') AS event_id, race_id, car_id, 'time_penalty' AS reason,
               snapshot_id AS lap,
               CASE snapshot_id % 3 WHEN 0 THEN 5 WHEN 1 THEN 10 ELSE 20 END AS penalty_seconds,
               CASE WHEN snapshot_id = 43 THEN 'planned' ELSE 'applied' END AS penalty_status,
               simulation_time_us
        FROM frames WHERE race_position = 4 AND snapshot_id % 10 = 3""",
    # races, discrete events and outbox
    "races": f"""
        SELECT {_RACE.format('o_orderkey')} AS race_id,
               CASE WHEN CAST(floor(o_orderkey / 300) AS BIGINT) % 5 <> 4 THEN 'finished'
                    ELSE 'running' END AS status,
               min(o_orderdate) AS started_at, max(o_orderdate) AS finished_at
        FROM orders GROUP BY floor(o_orderkey / 300), {_RACE.format('o_orderkey')}""",
    "stream_events": """
        SELECT event_id, race_id, 'lap' AS kind, car_id, event_time AS received_at,
               lap_time_ms * lap AS simulation_time_us,
               CASE WHEN lap_time_ms % 50 = 0 THEN '{}'
                    ELSE concat('{"lap":', CAST(lap AS STRING), '}') END AS payload
        FROM laps""",
    "outbox": """
        SELECT kafka_offset AS id, event_id, race_id FROM laps
        WHERE lap <= 2 AND neutralized AND NOT valid""",
    # planned scenarios, some invalid, some repeated
    "incident_plan": f"""
        SELECT race_id, CASE lap_time_ms % 3 WHEN 0 THEN 'collision' WHEN 1 THEN 'tire_puncture'
                        ELSE 'time_penalty' END AS incident_type, lap, car_id,
               CASE WHEN lap_time_ms % 3 = 0 OR lap_time_ms % 11 = 0
                    THEN {_CAR.format('lap_time_ms')} ELSE '' END AS second_car_id,
               CASE WHEN lap_time_ms % 3 = 2 OR lap_time_ms % 13 = 0
                    THEN CAST(lap_time_ms % 25 AS INT) ELSE 0 END AS penalty_seconds
        FROM laps WHERE lap <= 3""",
    # set-up rows, some out of bounds
    "car_config": """
        SELECT concat('CAR-', CAST(s_suppkey AS STRING)) AS car_id,
               CAST(400 + floor(abs(s_acctbal) / 15) AS DOUBLE) AS car_weight_kg,
               CAST(40 + s_suppkey % 120 AS DOUBLE) AS driver_weight_kg,
               CAST(240 + s_suppkey * 7 % 150 AS DOUBLE) AS top_speed_kmh,
               CASE s_suppkey % 5 WHEN 0 THEN 'soft' WHEN 1 THEN 'medium' WHEN 2 THEN 'hard'
                    WHEN 3 THEN 'wet' ELSE 'slick' END AS tire_compound,
               CASE s_nationkey % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C'
                    ELSE 'D' END AS strategy,
               CASE WHEN s_nationkey % 6 = 0 THEN 'br' WHEN s_nationkey % 6 = 1 THEN ''
                    ELSE upper(substr(n_name, 1, 2)) END AS driver_country_code
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    # race state at the last lap every car reached
    "cut_lap": """
        SELECT race_id, min(m) AS lap
        FROM (SELECT race_id, car_id, max(lap) AS m FROM laps GROUP BY race_id, car_id) x
        GROUP BY race_id""",
    "timing_cut": """
        SELECT t.* FROM timing t JOIN cut_lap c ON c.race_id = t.race_id WHERE t.lap <= c.lap""",
    "order_cut": """
        SELECT f.* FROM frames f JOIN cut_lap c ON c.race_id = f.race_id AND f.snapshot_id = c.lap""",
    # producer events of four kinds as wide rows
    "source_events": """
        SELECT kind, event_id, race_id, car_id, simulation_time_us, track_progress, race_position,
               track_status, speed_kmh, fuel_kg, CAST(NULL AS BIGINT) AS lap_elapsed_ms,
               CAST(NULL AS BIGINT) AS segment_time_ms, CAST(NULL AS INT) AS sector,
               CAST(NULL AS BIGINT) AS sector_time_ms, CAST(NULL AS INT) AS lap,
               CAST(NULL AS BIGINT) AS pit_stop_time_ms, CAST(NULL AS INT) AS penalty_seconds
        FROM telemetry
        UNION ALL
        SELECT 'timing', event_id, race_id, car_id, simulation_time_us, NULL, race_position, NULL,
               NULL, NULL, lap_elapsed_ms, segment_time_ms, sector, sector_time_ms, lap, NULL, NULL
        FROM timing
        UNION ALL
        SELECT CASE WHEN phase = 'entry' THEN 'pit' ELSE 'pitstop' END, event_id, race_id, car_id,
               pit_stop_time_ms - 20000, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, lap,
               pit_stop_time_ms - 30000, NULL
        FROM pitstops
        UNION ALL
        SELECT 'incident', event_id, race_id, car_id, simulation_time_us, NULL, NULL, NULL, NULL,
               NULL, NULL, NULL, NULL, NULL, lap, NULL, penalty_seconds - 10
        FROM incidents""",
    # track settings derived from parts; most break some rule
    "track_setups": """
        SELECT p_partkey, CAST(p_size AS DOUBLE) * 100 - 500 AS length_m,
               CAST(p_partkey % 40 + 10 AS DOUBLE) / 100 AS first_end,
               CAST(p_partkey % 30 + 45 AS DOUBLE) / 100 AS second_end,
               CAST(p_size AS DOUBLE) / 50 AS first_point,
               CAST(p_partkey % 97 AS DOUBLE) / 97 AS second_point,
               CAST(p_partkey % 11 AS DOUBLE) / 20 AS corner_start,
               CAST(p_size % 13 AS DOUBLE) / 20 AS corner_end,
               CAST(p_partkey % 9 AS DOUBLE) - 1 AS radius,
               CAST(p_size AS DOUBLE) / 50 AS pit_exit
        FROM part""",
}


# The same views as Spark derives them: timing lines are spread out from laps that know their start,
# so that only laps are stored and a line is as cheap as a column, and what a view leaves out is
# left out before the lines are spread.  The rows are those of the texts above.
_START = re.search(r"\(SELECT \*, CAST\(coalesce\(sum.*? FROM laps\)", _VIEWS["timing"], re.S).group()
_LAP = """event_id, race_id, car_id, team_id, lap_time_ms, valid, pit_lap, neutralized, event_time,
    kafka_partition, kafka_offset, batch_id, lap"""
_AT_CUT = """(SELECT t.* FROM timing t JOIN cut_lap c ON c.race_id = t.race_id AND c.lap = t.lap) t
    WHERE"""
_SPARK_VIEWS = {
    "laps_raw": _VIEWS["laps_raw"],
    "lap_starts": _START.replace("FROM laps", f"FROM ({_VIEWS['laps']}) l")[1:-1],
    **_VIEWS,
    "laps": f"SELECT {_LAP} FROM lap_starts",
    "timing": _VIEWS["timing"].replace(_START, "lap_starts"),
    # The position in the frame is not used, so no frame is sorted.
    "final_state": _VIEWS["final_state"].replace("FROM frames", f"FROM ({_VIEWS['frames']}) f"),
    "timing_cut": _VIEWS["timing"].replace(
        _START,
        "(SELECT s.* FROM lap_starts s JOIN cut_lap c ON c.race_id = s.race_id AND s.lap <= c.lap)",
    ),
    "order_cut": _VIEWS["frames"].replace("FROM timing WHERE", f"FROM {_AT_CUT}"),
}


def _fan(name: str, alias: str, for_spark: bool) -> str:
    columns, rows = _FANS[name]
    literals = [", ".join(repr(value) for value in row) for row in rows]
    if for_spark:
        structs = ", ".join(f"struct({row})" for row in literals)
        return f"LATERAL VIEW inline(array({structs})) {alias} AS {', '.join(columns)}"
    values = ", ".join(f"({row})" for row in literals)
    return f"CROSS JOIN (VALUES {values}) AS {alias}({', '.join(columns)})"


def _text(view: str, for_spark: bool) -> str:
    views = _SPARK_VIEWS if for_spark else _VIEWS
    return re.sub(
        r"\{fan:(\w+) (\w+)\}",
        lambda match: _fan(match.group(1), match.group(2), for_spark),
        views[view],
    )


@cache
def _needed(sql: str) -> tuple[str, ...]:
    """Views a statement uses, directly or through other views, in definition order."""
    found: set[str] = set()
    pending = [sql]
    while pending:
        words = set(re.findall(r"[a-z_]+", pending.pop()))
        for view in words & (set(_VIEWS) - found):
            found.add(view)
            pending.append(_VIEWS[view])
    return tuple(view for view in _VIEWS if view in found)


def with_views(sql: str) -> str:
    """A DuckDB statement with the views it uses in front."""
    chain = [f"{view} AS ({_text(view, False)})" for view in _needed(sql)]
    body = sql.strip()
    if not chain:
        return body
    if body.upper().startswith("WITH "):
        body = body[5:]
        return f"WITH {', '.join(chain)}, {body}"
    return f"WITH {', '.join(chain)} {body}"


# Event tables that are written once per session and data folder, as an ingest job would; the
# operators then read stored columns instead of deriving the events anew.
STORED = ("lap_starts", "frames", "final_state", "cut_lap", "order_cut")
_stored: dict[tuple[str, str, str], str] = {}


class Tables:
    """Base tables and adapter views of one data folder as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __call__(self, name: str) -> DataFrame:
        """DataFrame of a base table or an adapter view."""
        if name in TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        if name in STORED:
            return self.spark.read.parquet(self._path(name))
        return self._derive(name)

    def _path(self, view: str) -> str:
        """Folder of a stored view under the shared root; written on first use."""
        key = (self.spark.sparkContext.applicationId, self.folder, view)
        if key not in _stored:
            path = scratch(self.spark, f"table-{view}")
            with shuffles_dropped(self.spark):
                self._derive(view).write.option("compression", COMPRESSION).parquet(path)
            _stored[key] = path
        return _stored[key]

    def _derive(self, name: str) -> DataFrame:
        """Plan of a view over base tables and stored views."""
        chain: dict[str, str] = {}
        pending = [name]
        while pending:
            view = pending.pop()
            if view in STORED and view != name:
                chain[view] = f"SELECT * FROM parquet.`{self._path(view)}`"
                continue
            chain[view] = _text(view, True)
            words = set(re.findall(r"[a-z_]+", _SPARK_VIEWS[view]))
            pending += [other for other in words & set(_SPARK_VIEWS) if other not in chain and other != view]
        used = set(re.findall(r"[a-z_]+", " ".join(_SPARK_VIEWS[v] for v in chain if v not in STORED or v == name)))
        base = [
            f"{table} AS (SELECT * FROM parquet.`{self.folder}/{table}.parquet`)"
            for table in TABLES
            if table in used
        ]
        views = [f"{view} AS ({chain[view]})" for view in _SPARK_VIEWS if view in chain]
        return self.spark.sql(f"WITH {', '.join(base + views)} SELECT * FROM {name}")

"""Lap statistics, deduplication and lap completion queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitwall.operators import dedup, laps
from pitwall.plans.registry import query

_FIRST = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id
    ORDER BY kafka_partition, kafka_offset) AS rn FROM {0}) d WHERE rn = 1"""
_VALID_FIRST = _FIRST.format("(SELECT * FROM laps_raw WHERE valid) v")

_PLAIN_LAP = ["event_id", "race_id", "car_id", "lap_time_ms", "valid", "kafka_offset"]


@query(
    "dedup_event_id",
    f"""SELECT event_id, race_id, car_id, lap_time_ms, valid, kafka_offset
        FROM ({_FIRST.format('laps_raw')}) u""",
)
def _(t):
    return dedup.dedup_event_id(t("laps_raw")).select(*_PLAIN_LAP)


@query(
    "dedup_offset",
    """SELECT DISTINCT topic, kafka_partition, kafka_offset, kafka_timestamp, payload
       FROM envelopes_replay""",
)
def _(t):
    return dedup.dedup_offset(t("envelopes_replay")).select(
        "topic", "kafka_partition", "kafka_offset", "kafka_timestamp", "payload"
    )


@query(
    "dedup_timing_key",
    """SELECT event_id, race_id, car_id, lap, checkpoint_id, lap_elapsed_ms FROM (
         SELECT *, row_number() OVER (PARTITION BY race_id, car_id, lap, checkpoint_id
                                      ORDER BY simulation_time_us, event_id) AS rn
         FROM timing_resent) d WHERE rn = 1""",
)
def _(t):
    return dedup.dedup_timing_key(t("timing_resent")).select(
        "event_id", "race_id", "car_id", "lap", "checkpoint_id", "lap_elapsed_ms"
    )


@query(
    "dedup_pit_stop",
    "SELECT DISTINCT race_id, car_id, stop_number FROM pitstops WHERE phase = 'exit'",
)
def _(t):
    return dedup.dedup_pit_stop(t("pitstops"))


@query(
    "duplicate_incident_plan",
    """SELECT race_id, incident_type, lap,
              CASE WHEN incident_type = 'collision' THEN
                concat(least(car_id, second_car_id), ':', greatest(car_id, second_car_id))
                ELSE car_id END AS cars, CAST(count(*) AS BIGINT) AS copies
       FROM incident_plan GROUP BY 1, 2, 3, 4 HAVING count(*) > 1""",
)
def _(t):
    return dedup.duplicate_incident_plan(t("incident_plan"))


@query(
    "lap_performance",
    f"""SELECT race_id, car_id, count(lap_time_ms) AS voltas_validas,
               min(lap_time_ms) AS melhor_volta_ms, max(lap_time_ms) AS pior_volta_ms,
               avg(lap_time_ms) AS media_volta_ms
        FROM ({_VALID_FIRST}) u GROUP BY race_id, car_id""",
)
def _(t):
    return laps.lap_performance(t("laps_raw"))


VALID_STATS = f"""SELECT race_id, car_id, min(lap_time_ms) AS best_lap_time_ms,
    max(lap_time_ms) AS worst_lap_time_ms, avg(lap_time_ms) AS average_lap_time_ms,
    CAST(sum(lap_time_ms) AS BIGINT) AS sum_lap_time_ms, count(*) AS valid_lap_count
    FROM ({_VALID_FIRST}) u GROUP BY race_id, car_id"""


@query("valid_lap_stats", VALID_STATS)
def _(t):
    return laps.valid_lap_stats(t("laps_raw"))


PARTIALS = """SELECT race_id, car_id, batch_id, count(*) AS completed_lap_count,
    CAST(sum(CASE WHEN valid THEN 1 ELSE 0 END) AS BIGINT) AS valid_lap_count,
    min(CASE WHEN valid THEN lap_time_ms END) AS best_lap_time_ms,
    max(CASE WHEN valid THEN lap_time_ms END) AS worst_lap_time_ms,
    CAST(sum(CASE WHEN valid THEN lap_time_ms ELSE 0 END) AS BIGINT) AS sum_lap_time_ms
    FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY batch_id, event_id
            ORDER BY kafka_partition, kafka_offset) AS rn FROM laps_raw) d WHERE rn = 1) u
    GROUP BY race_id, car_id, batch_id"""


@query("lap_window_partials", PARTIALS)
def _(t):
    return laps.lap_window_partials(t("laps_raw"))


@query(
    "merge_lap_partials",
    f"""SELECT race_id, car_id, completed_lap_count, valid_lap_count, best_lap_time_ms,
               worst_lap_time_ms, sum_lap_time_ms,
               CASE WHEN valid_lap_count > 0
                    THEN CAST(sum_lap_time_ms AS DOUBLE) / valid_lap_count END AS average_lap_time_ms
        FROM (SELECT race_id, car_id,
                     CAST(sum(completed_lap_count) AS BIGINT) AS completed_lap_count,
                     CAST(sum(valid_lap_count) AS BIGINT) AS valid_lap_count,
                     min(best_lap_time_ms) AS best_lap_time_ms,
                     max(worst_lap_time_ms) AS worst_lap_time_ms,
                     CAST(sum(sum_lap_time_ms) AS BIGINT) AS sum_lap_time_ms
              FROM ({PARTIALS}) p GROUP BY race_id, car_id) m""",
)
def _(t):
    return laps.merge_lap_partials(laps.lap_window_partials(t("laps_raw")))


PIT_COUNTS = """SELECT race_id, car_id, count(DISTINCT stop_number) AS pit_stop_count
    FROM pitstops WHERE phase = 'exit' GROUP BY race_id, car_id"""


@query("pit_stop_counts", PIT_COUNTS)
def _(t):
    return laps.pit_stop_counts(t("pitstops"))


@query(
    "fact_lap_counts",
    """SELECT race_id, car_id, count(DISTINCT event_id) AS fact_lap_count
       FROM laps_raw GROUP BY race_id, car_id""",
)
def _(t):
    return laps.fact_lap_counts(t("laps_raw"))


@query(
    "race_finish_gate",
    """SELECT race_id, count(*) AS cars,
              CAST(sum(CASE WHEN race_status = 'finished' THEN 1 ELSE 0 END) AS BIGINT)
                AS finished_cars,
              bool_and(race_status = 'finished') AS ready
       FROM final_state GROUP BY race_id""",
)
def _(t):
    return laps.race_finish_gate(t("final_state"))


COMPLETE = """SELECT f.race_id, f.car_id, f.team_id, f.lap, f.event_id, f.race_position,
    f.simulation_time_us, f.lap_elapsed_ms AS lap_time_ms, f.pit_lap, n.neutralized,
    (f.valid AND NOT n.neutralized) AS valid, s1.sector_time_ms AS s1_ms,
    s2.sector_time_ms AS s2_ms, f.sector_time_ms AS s3_ms
    FROM timing f
    JOIN timing s1 ON s1.race_id = f.race_id AND s1.car_id = f.car_id AND s1.lap = f.lap
         AND s1.sector = 1
    JOIN timing s2 ON s2.race_id = f.race_id AND s2.car_id = f.car_id AND s2.lap = f.lap
         AND s2.sector = 2
    JOIN (SELECT race_id, car_id, lap, bool_or(neutralized) AS neutralized FROM timing
          GROUP BY race_id, car_id, lap) n
      ON n.race_id = f.race_id AND n.car_id = f.car_id AND n.lap = f.lap
    WHERE f.checkpoint_id = 'SF'"""


@query(
    "complete_laps",
    f"""SELECT l.*, CAST(least(l.lap + 1, r.target_laps) AS INT) AS current_lap
        FROM ({COMPLETE}) l JOIN race_targets r ON r.race_id = l.race_id""",
)
def _(t):
    done = laps.complete_laps(t("timing_resent"), t("race_targets"))
    sectors = [F.col("sectors_ms")[i].alias(f"s{i + 1}_ms") for i in range(3)]
    return done.select("*", *sectors).drop("sectors_ms")


SUMMARY = """SELECT race_id, car_id,
    arg_max(lap_time_ms, lap) FILTER (WHERE valid) AS last_lap_time_ms,
    min(lap_time_ms) FILTER (WHERE valid) AS best_lap_time_ms,
    max(lap_time_ms) FILTER (WHERE valid) AS worst_lap_time_ms,
    CAST(count(*) FILTER (WHERE valid) AS INT) AS lap_count FROM laps GROUP BY race_id, car_id"""


@query("car_lap_summary", SUMMARY)
def _(t):
    return laps.car_lap_summary(t("laps"))


PACE = """SELECT race_id, car_id, CAST(round_even(median(lap_time_ms), 0) AS BIGINT) AS pace_ms
    FROM (SELECT *, row_number() OVER (PARTITION BY race_id, car_id ORDER BY lap DESC) AS rn
          FROM laps WHERE valid AND NOT pit_lap AND lap > 1) x
    WHERE rn <= 5 GROUP BY race_id, car_id"""


@query("clean_pace", PACE)
def _(t):
    return laps.clean_pace(t("laps"))


@query(
    "sector_sum_check",
    f"""SELECT race_id, car_id, lap, lap_time_ms, s1_ms + s2_ms + s3_ms AS sector_sum_ms
        FROM ({COMPLETE}) l
        WHERE abs(s1_ms + s2_ms + s3_ms - lap_time_ms) > 1
           OR lap_time_ms <= 50000 OR lap_time_ms >= 200000""",
)
def _(t):
    checked = laps.sector_sum_check(laps.complete_laps(t("timing")))
    return checked.select("race_id", "car_id", "lap", "lap_time_ms", "sector_sum_ms")

"""Classification, parity, coverage, lifecycle and session queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitwall.operators import gold, laps, lifecycle, projections, timing
from pitwall.plans.query_laps import PACE, PARTIALS, PIT_COUNTS, SUMMARY, VALID_STATS
from pitwall.plans.query_timing import GAPS, SECTOR_BESTS, SPLITS
from pitwall.plans.registry import query

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_FLAGS = "".join(chr(0x1F1E6 + i) for i in range(26))
FLAG_SQL = f"""CASE WHEN regexp_matches({{0}}, '^[A-Za-z]{{{{2}}}}$')
    THEN translate(upper({{0}}), '{_LETTERS}', '{_FLAGS}') ELSE '' END"""
MEDAL_SQL = "CASE position WHEN 1 THEN 'ouro' WHEN 2 THEN 'prata' WHEN 3 THEN 'bronze' END"


def _flag(column: str) -> str:
    return FLAG_SQL.format(column)


CLASSIFICATION = f"""SELECT race_id, car_id, driver_id, driver_name, driver_country_code, team_id,
    position, best_lap_time_ms, worst_lap_time_ms, average_lap_time_ms, valid_lap_count,
    pit_stop_count, {MEDAL_SQL} AS podium_medal, {_flag('driver_country_code')} AS country_flag,
    CASE WHEN position <= 3 THEN '🏆' END AS trophy
    FROM (SELECT s.race_id, s.car_id, s.driver_id, s.driver_name, s.driver_country_code, s.team_id,
                 s.race_position AS position,
                 coalesce(v.best_lap_time_ms, s.best_lap_time_ms) AS best_lap_time_ms,
                 coalesce(v.worst_lap_time_ms, s.worst_lap_time_ms) AS worst_lap_time_ms,
                 v.average_lap_time_ms, v.valid_lap_count,
                 CAST(greatest(coalesce(p.pit_stop_count, 0), coalesce(s.pit_stops, 0)) AS INT)
                   AS pit_stop_count
          FROM final_state s
          LEFT JOIN ({VALID_STATS}) v ON v.race_id = s.race_id AND v.car_id = s.car_id
          LEFT JOIN ({PIT_COUNTS}) p ON p.race_id = s.race_id AND p.car_id = s.car_id) c"""


def classified(t):
    """Classification of every race of the shared tables."""
    return gold.classification(
        t("final_state"), laps.valid_lap_stats(t("laps_raw")), laps.pit_stop_counts(t("pitstops"))
    )


@query("classification", CLASSIFICATION)
def _(t):
    return classified(t)


@query("classification_order", CLASSIFICATION)
def _(t):
    return gold.classification_order(classified(t))


@query(
    "podium",
    f"""SELECT race_id, car_id, driver_name, position, podium_medal, trophy
        FROM ({CLASSIFICATION}) c WHERE position <= 3""",
)
def _(t):
    return gold.podium(classified(t))


@query("gold_summary_json")
def _(t):
    return gold.gold_summary_json(classified(t))


@query("gold_summary_read", CLASSIFICATION)
def _(t):
    summaries = gold.gold_summary_json(classified(t))
    return gold.gold_summary_read(summaries).select(F.explode("classification").alias("c")).select(
        "c.*"
    )


_COVERED = f"""SELECT s.race_id,
    (bool_and(coalesce(p.n, 0) = s.laps_completed AND coalesce(f.n, 0) = s.laps_completed)
     AND sum(coalesce(p.n, 0)) > 0 AND sum(coalesce(f.n, 0)) > 0) AS covered
    FROM final_state s
    LEFT JOIN (SELECT race_id, car_id, sum(completed_lap_count) AS n FROM ({PARTIALS}) x
               GROUP BY race_id, car_id) p ON p.race_id = s.race_id AND p.car_id = s.car_id
    LEFT JOIN (SELECT race_id, car_id, count(*) AS n FROM laps GROUP BY race_id, car_id) f
      ON f.race_id = s.race_id AND f.car_id = s.car_id
    GROUP BY s.race_id"""


def _coverage(t):
    partials = laps.merge_lap_partials(laps.lap_window_partials(t("laps_raw")))
    return gold.incremental_coverage(t("final_state"), partials, t("laps"))


@query("incremental_coverage", _COVERED)
def _(t):
    return _coverage(t)


@query(
    "lap_source_choice",
    f"""SELECT l.event_id, l.race_id, l.car_id, l.lap_time_ms, 'incremental' AS lap_source
        FROM laps l JOIN ({_COVERED}) c ON c.race_id = l.race_id AND c.covered
        UNION ALL
        SELECT r.event_id, r.race_id, r.car_id, r.lap_time_ms, 'raw' FROM laps_raw r
        WHERE r.race_id NOT IN (SELECT race_id FROM ({_COVERED}) d WHERE covered)""",
)
def _(t):
    columns = ["event_id", "race_id", "car_id", "lap_time_ms", "kafka_partition", "kafka_offset"]
    chosen = gold.lap_source_choice(
        _coverage(t), t("laps").select(*columns), t("laps_raw").select(*columns)
    )
    return chosen.drop("kafka_partition", "kafka_offset")


_BRONZE = ["topic", "kafka_partition", "kafka_offset", "event_id", "race_id"]


@query(
    "bronze_union",
    f"""SELECT 'pitstop' AS topic, 0 AS kafka_partition, pit_stop_time_ms AS kafka_offset, event_id,
               race_id FROM pitstops
        UNION ALL
        SELECT 'lap_completed', r.kafka_partition, r.kafka_offset, r.event_id, r.race_id
        FROM laps_raw r
        WHERE r.race_id NOT IN (SELECT race_id FROM ({_COVERED}) d WHERE covered)
        UNION ALL
        SELECT 'lap_completed', l.kafka_partition, l.kafka_offset, l.event_id, l.race_id
        FROM laps l JOIN ({_COVERED}) c ON c.race_id = l.race_id AND c.covered""",
)
def _(t):
    lap_topic = F.lit("lap_completed").alias("topic")
    stops = t("pitstops").select(
        F.lit("pitstop").alias("topic"),
        F.lit(0).alias("kafka_partition"),
        F.col("pit_stop_time_ms").alias("kafka_offset"),
        "event_id",
        "race_id",
    )
    decoded = stops.unionByName(t("laps_raw").select(lap_topic, *_BRONZE[1:]))
    stored = t("laps").select(lap_topic, *_BRONZE[1:])
    return gold.bronze_union(decoded, stored, _coverage(t))


_ONLINE = """SELECT race_id, car_id, revision, lap_count AS voltas_consumer,
    best_lap_time_ms AS melhor_consumer_ms, worst_lap_time_ms AS pior_consumer_ms
    FROM online_analytics"""


def _online(t):
    return t("online_analytics").select(
        "race_id",
        "car_id",
        "revision",
        F.col("lap_count").alias("voltas_consumer"),
        F.col("best_lap_time_ms").alias("melhor_consumer_ms"),
        F.col("worst_lap_time_ms").alias("pior_consumer_ms"),
    )


@query("latest_analytics", f"SELECT * FROM ({_ONLINE}) o WHERE revision = 2")
def _(t):
    return gold.latest_analytics(_online(t))


PARITY = f"""SELECT race_id, car_id, voltas_validas, melhor_volta_ms, pior_volta_ms, media_volta_ms,
    revision, voltas_consumer, melhor_consumer_ms, pior_consumer_ms,
    (voltas_validas IS NOT DISTINCT FROM voltas_consumer
     AND melhor_volta_ms IS NOT DISTINCT FROM melhor_consumer_ms
     AND pior_volta_ms IS NOT DISTINCT FROM pior_consumer_ms) AS paridade
    FROM (SELECT race_id, car_id, valid_lap_count AS voltas_validas,
                 best_lap_time_ms AS melhor_volta_ms, worst_lap_time_ms AS pior_volta_ms,
                 average_lap_time_ms AS media_volta_ms FROM ({VALID_STATS}) v) b
    FULL JOIN (SELECT * FROM ({_ONLINE}) o WHERE revision = 2) n USING (race_id, car_id)"""


def _parity(t):
    return gold.consumer_parity(
        laps.lap_performance(t("laps_raw")), gold.latest_analytics(_online(t))
    )


@query("consumer_parity", PARITY)
def _(t):
    return _parity(t)


@query(
    "parity_summary",
    f"""SELECT count(car_id) AS carros, count(paridade) AS comparados,
               CAST(count(*) FILTER (WHERE paridade) AS BIGINT) AS coincidentes,
               CAST(count(*) FILTER (WHERE NOT paridade) AS BIGINT) AS divergentes
        FROM ({PARITY}) p""",
)
def _(t):
    return gold.parity_summary(_parity(t))


@query(
    "race_status",
    """SELECT race_id, arg_max(status, source_sequence) AS status,
              bool_or(status = 'finished') AS finished FROM control GROUP BY race_id""",
)
def _(t):
    return lifecycle.race_status(t("control"))


@query(
    "pending_races",
    """SELECT DISTINCT race_id FROM control WHERE status = 'finished'
       AND race_id NOT IN (SELECT race_id FROM incidents WHERE car_id = 'CAR-05')""",
)
def _(t):
    done = t("incidents").filter("car_id = 'CAR-05'").select("race_id").distinct()
    return lifecycle.pending_races(t("control"), done)


@query(
    "latest_race",
    "SELECT * FROM races ORDER BY started_at DESC, race_id DESC LIMIT 1",
)
def _(t):
    return lifecycle.latest_race(t("races"))


@query(
    "outbox_pending",
    """SELECT o.id, o.event_id, o.race_id FROM outbox o
       WHERE NOT EXISTS (SELECT 1 FROM laps l WHERE l.kafka_offset = o.id AND l.team_id = 'TEAM-A-01')
       ORDER BY o.id, o.event_id LIMIT 300""",
)
def _(t):
    delivered = t("laps").filter("team_id = 'TEAM-A-01'").select(F.col("kafka_offset").alias("id"))
    return lifecycle.outbox_pending(t("outbox"), delivered)


_CUTOFF = "TIMESTAMP '2001-10-01 00:00:00'"
RETENTION_CANDIDATES = f"""SELECT e.event_id, e.race_id, e.received_at, e.payload
    FROM stream_events e JOIN races r ON r.race_id = e.race_id
    WHERE r.status IN ('finished', 'stopped', 'failed')
      AND r.finished_at < {_CUTOFF} - INTERVAL 30 DAY AND e.received_at < {_CUTOFF} - INTERVAL 30 DAY
      AND e.payload <> '{{}}'
      AND r.race_id <> (SELECT race_id FROM races ORDER BY started_at DESC, race_id DESC LIMIT 1)
      AND NOT EXISTS (SELECT 1 FROM outbox o WHERE o.race_id = r.race_id)
    ORDER BY e.received_at, e.event_id LIMIT 100000"""


def retention_candidates(t):
    return lifecycle.retention_candidates(
        t("stream_events"),
        t("races"),
        t("outbox"),
        F.lit("2001-10-01 00:00:00").cast("timestamp_ntz"),
        days=30,
        limit=lifecycle.LARGEST_RETENTION_BATCH,
    )


@query("retention_candidates", RETENTION_CANDIDATES)
def _(t):
    return retention_candidates(t).select("event_id", "race_id", "received_at", "payload")


@query(
    "retention_apply",
    f"""SELECT e.event_id, e.race_id, CASE WHEN c.event_id IS NOT NULL THEN '{{}}'
               ELSE e.payload END AS payload
        FROM stream_events e LEFT JOIN ({RETENTION_CANDIDATES}) c ON c.event_id = e.event_id""",
)
def _(t):
    return lifecycle.retention_apply(t("stream_events"), retention_candidates(t)).select(
        "event_id", "race_id", "payload"
    )


@query(
    "race_results_upsert",
    """SELECT race_id, car_id, race_position,
              CASE WHEN race_status = 'running' THEN laps_completed + 1 ELSE laps_completed END
                AS laps_completed FROM final_state""",
)
def _(t):
    columns = ["race_id", "car_id", "race_position", "laps_completed"]
    rerun = t("final_state").filter("race_status = 'running'")
    new = rerun.withColumn("laps_completed", F.col("laps_completed") + 1).select(*columns)
    return lifecycle.race_results_upsert(t("final_state").select(*columns), new)


@query(
    "available_cars_at_lap",
    """SELECT p.race_id, p.car_id FROM race_participants p WHERE NOT EXISTS (
         SELECT 1 FROM incident_plan i WHERE i.race_id = p.race_id
            AND i.incident_type = 'collision' AND i.lap <= 1
            AND (i.car_id = p.car_id OR i.second_car_id = p.car_id))""",
)
def _(t):
    return lifecycle.available_cars_at_lap(t("race_participants"), t("incident_plan"), 1)


@query(
    "session_snapshot",
    """SELECT race_id, s.snapshot_id AS last_snapshot, a.revision, c.status
       FROM (SELECT race_id, max(snapshot_id) AS snapshot_id FROM frames GROUP BY race_id) s
       FULL JOIN (SELECT race_id, max(revision) AS revision FROM online_analytics
                  GROUP BY race_id) a USING (race_id)
       FULL JOIN (SELECT race_id, arg_max(status, source_sequence) AS status FROM control
                  GROUP BY race_id) c USING (race_id)""",
)
def _(t):
    state = t("frames").select("race_id", "snapshot_id", F.col("snapshot_id").alias("state_sequence"))
    analytics = t("online_analytics").select("race_id", "revision")
    return lifecycle.session_snapshot(state, analytics, t("control")).select(
        "race_id",
        F.col("state.snapshot_id").alias("last_snapshot"),
        "analytics.revision",
        "control.status",
    )


@query(
    "coalesced_analytics",
    """SELECT race_id, revision, event_id FROM (
         SELECT race_id, lap AS revision, event_id, row_number() OVER (PARTITION BY race_id
                ORDER BY lap DESC, event_id) AS rn FROM laps) d WHERE rn = 1""",
)
def _(t):
    batch = t("laps").select("race_id", F.col("lap").alias("revision"), "event_id")
    return lifecycle.coalesced_analytics(batch)


@query(
    "latest_wins_view",
    """SELECT race_id, state_sequence FROM (SELECT race_id, max(simulation_time_us)
         AS state_sequence FROM frames GROUP BY race_id) d""",
)
def _(t):
    frames = t("frames").select("race_id", F.col("simulation_time_us").alias("state_sequence"))
    return lifecycle.latest_wins_view(frames)


@query(
    "car_dimension_join",
    """SELECT l.event_id, l.race_id, l.car_id, c.driver_name, c.team_id AS car_team_id,
              c.driver_country_code FROM laps l LEFT JOIN cars c ON c.car_id = l.car_id""",
)
def _(t):
    facts = t("laps").select("event_id", "race_id", "car_id")
    return lifecycle.car_dimension_join(facts, t("cars"))


_ANALYTICS = f"""SELECT g.*, l.last_lap_time_ms, l.best_lap_time_ms, l.worst_lap_time_ms,
    coalesce(l.lap_count, 0) AS lap_count, p.pace_ms, b.s1_ms, b.s2_ms, b.s3_ms,
    b.s1_ms + b.s2_ms + b.s3_ms AS theoretical_lap_ms
    FROM ({GAPS}) g
    LEFT JOIN ({SUMMARY}) l ON l.race_id = g.race_id AND l.car_id = g.car_id
    LEFT JOIN ({PACE}) p ON p.race_id = g.race_id AND p.car_id = g.car_id
    LEFT JOIN ({SECTOR_BESTS}) b ON b.race_id = g.race_id AND b.car_id = g.car_id"""


@query("car_analytics", _ANALYTICS.replace("FROM timing WHERE", "FROM timing_cut WHERE"))
def _(t):
    cars = projections.car_analytics(t("timing_cut"), t("laps"), t("order_cut"))
    sectors = [F.col("sector_best_ms")[i].alias(f"s{i + 1}_ms") for i in range(3)]
    return cars.select("*", *sectors).drop("sector_best_ms")


def _documents(t):
    cars = projections.car_analytics(t("timing_cut"), t("laps"), t("order_cut"))
    return projections.analytics_document(cars, timing.splits_with_bests(t("timing_cut")))


@query("analytics_document")
def _(t):
    return _documents(t)


@query(
    "flatten_analytics_cars",
    f"""SELECT g.race_id, 1 AS revision, g.car_id, coalesce(l.lap_count, 0) AS voltas_consumer,
               l.best_lap_time_ms AS melhor_consumer_ms, l.worst_lap_time_ms AS pior_consumer_ms
        FROM order_cut g LEFT JOIN ({SUMMARY}) l
          ON l.race_id = g.race_id AND l.car_id = g.car_id""",
)
def _(t):
    return projections.flatten_analytics_cars(_documents(t).withColumn("revision", F.lit(1)))


@query(
    "team_summary",
    "SELECT race_id, team_id, car_id, lap_count FROM online_analytics WHERE revision = 2",
)
def _(t):
    return projections.team_summary(gold.latest_analytics(t("online_analytics"))).select(
        "race_id", "team_id", "car_id", "lap_count"
    )


@query(
    "participants_of_race",
    "SELECT race_id, car_id, 'TEAM-A-01' AS team_id FROM race_participants",
)
def _(t):
    entered = (
        t("race_participants")
        .withColumn("p", F.struct("car_id", F.lit("TEAM-A-01").alias("team_id")))
        .groupBy("race_id")
        .agg(F.collect_list("p").alias("participants"))
    )
    opening = entered.withColumn("source_sequence", F.lit(1))
    closing = opening.withColumn("participants", F.filter("participants", lambda p: F.lit(False)))
    control = opening.unionByName(closing.withColumn("source_sequence", F.lit(2)))
    return projections.participants_of_race(control)


@query(
    "derived_event_identity",
    """SELECT concat(event_id, ':lap') AS event_id, race_id, car_id, 'lap' AS kind,
              1 AS schema_version, simulation_time_us, lap_elapsed_ms AS lap_time_ms
       FROM timing WHERE checkpoint_id = 'SF'""",
)
def _(t):
    finish = t("timing").filter("checkpoint_id = 'SF'")
    return projections.derived_event_identity(
        finish, "lap", F.lit("lap"), F.col("lap_elapsed_ms").alias("lap_time_ms")
    )


@query(
    "lap_history",
    """SELECT event_id, race_id, car_id, simulation_time_us, payload FROM stream_events
       WHERE kind = 'lap' AND payload <> '{}'""",
)
def _(t):
    return projections.lap_history(t("stream_events"), "lap").select(
        "event_id", "race_id", "car_id", "simulation_time_us", "payload"
    )

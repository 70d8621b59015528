"""Source, sink and decoding queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pitwall.operators import lifecycle, projections
from pitwall.plans.registry import query
from pitwall.schemas import topic_catalog
from pitwall.sources import broker, decode, layers, storage


def _broker_rows(t):
    """Broker-shaped records of the event table."""
    return t("envelopes").select(
        F.col("event_key").cast("binary").alias("key"),
        F.col("payload").cast("binary").alias("value"),
        "topic",
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("kafka_timestamp").alias("timestamp"),
    )


@query(
    "envelope_projection",
    """SELECT kafka_timestamp, topic, kafka_partition, kafka_offset, event_key,
              payload AS body, event_date_utc FROM envelopes""",
)
def _(t):
    archived = projections.envelope_projection(_broker_rows(t))
    return archived.withColumn("event_key", F.col("event_key").cast("string")).withColumn(
        "body", F.col("avro_envelope").cast("string")
    ).drop("avro_envelope")


@query(
    "archive_scan",
    """SELECT topic, kafka_partition, kafka_offset, event_date_utc FROM envelopes
       WHERE topic IN ('click', 'error')
         AND event_date_utc BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""",
)
def _(t):
    archived = projections.envelope_projection(
        _broker_rows(t).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    )
    path = storage.scratch(t.spark, "archive")
    layers.layer_table_sink(archived, path, ("topic", "event_date_utc"))
    scan = layers.archive_scan(t.spark, path, ["click", "error"], ("2024-01-05", "2024-01-20"))
    return scan.select("topic", "kafka_partition", "kafka_offset", "event_date_utc")


@query(
    "committed_batch_scan",
    """SELECT event_id, race_id, batch_id FROM laps
       WHERE batch_id IN (SELECT batch_id FROM laps WHERE pit_lap)""",
)
def _(t):
    log = t("laps").filter("pit_lap").select("batch_id").distinct()
    return layers.committed_batch_scan(t("laps"), log).select("event_id", "race_id", "batch_id")


@query(
    "layer_table_sink",
    "SELECT race_id, car_id, laps_completed, race_status FROM final_state",
)
def _(t):
    path = storage.scratch(t.spark, "layer")
    states = t("final_state").select("race_id", "car_id", "laps_completed", "race_status")
    layers.layer_table_sink(states, path, ("race_status",))
    # A re-run of one partition replaces that partition and leaves the others alone.
    layers.layer_table_sink(states.filter("race_status = 'running'"), path, ("race_status",))
    return t.spark.read.parquet(path)


@query(
    "event_sink",
    """SELECT CASE kind WHEN 'telemetry' THEN 'telemetry' WHEN 'timing' THEN 'timing'
                        WHEN 'pitstop' THEN 'pitstop' WHEN 'incident' THEN 'incident' END AS topic,
              CASE WHEN car_id <> '' THEN car_id ELSE race_id END AS key, event_id AS value
       FROM source_events""",
)
def _(t):
    return broker.event_sink(t("source_events"), F.col("event_id"))


@query(
    "topic_catalog",
    """SELECT kind, kind AS topic, kind <> 'pit' AS is_source, count(*) AS events
       FROM source_events WHERE kind <> 'pit' GROUP BY kind""",
)
def _(t):
    counts = t("source_events").groupBy("kind").agg(F.count("*").alias("events"))
    return counts.join(topic_catalog(t.spark), "kind").select("kind", "topic", "is_source", "events")


_V1 = "event_id string, lap bigint"
_V2 = "event_id string, lap bigint, race_position int"
_READER = "event_id string, lap bigint, race_position int, neutralized boolean"


def _enveloped(t):
    """Lap facts as envelopes of two schema versions (and some of an unknown one)."""
    schema_id = (
        F.when(F.col("pit_lap"), F.lit(300)).when(F.col("valid"), F.lit(1)).otherwise(F.lit(258))
    )
    body = F.to_json(
        F.struct("event_id", F.col("lap").cast("bigint").alias("lap"),
                 (F.col("lap") % 20).alias("race_position"))
    )
    header = F.concat(F.lit("00"), F.lpad(F.hex(schema_id), 8, "0"))
    return t("laps").select(
        F.lit("lap_completed").alias("topic"),
        "kafka_partition",
        "kafka_offset",
        F.unhex(F.concat(header, F.hex(body))).alias("avro_envelope"),
    )


@query(
    "envelope_header",
    """SELECT kafka_offset, CASE WHEN pit_lap THEN 300 WHEN valid THEN 1 ELSE 258 END AS schema_id,
              concat('{"event_id":"', event_id, '","lap":', CAST(lap AS STRING),
                     ',"race_position":', CAST(lap % 20 AS STRING), '}') AS payload
       FROM laps""",
)
def _(t):
    rows = decode.envelope_header(_enveloped(t))
    return rows.select("kafka_offset", "schema_id", F.col("payload").cast("string").alias("payload"))


def _decoded(t):
    registry = {1: _V1, 258: _V2}
    return decode.decode_by_writer_schema(
        _enveloped(t), "lap_completed", registry, _READER, decode.json_decoder
    )


@query(
    "decode_by_writer_schema",
    """SELECT kafka_offset, schema_id, CASE WHEN schema_id <> 300 THEN event_id END AS event_id,
              CASE WHEN schema_id <> 300 THEN CAST(lap AS BIGINT) END AS lap,
              CASE WHEN schema_id = 258 THEN lap % 20 END AS race_position
       FROM (SELECT *, CASE WHEN pit_lap THEN 300 WHEN valid THEN 1 ELSE 258 END AS schema_id
             FROM laps) l""",
)
def _(t):
    return _decoded(t).select(
        "kafka_offset", "schema_id", "evento.event_id", "evento.lap", "evento.race_position"
    )


@query(
    "schema_evolution_fill",
    """SELECT CASE WHEN NOT pit_lap THEN event_id END AS event_id,
              CASE WHEN valid OR pit_lap THEN 0 ELSE lap % 20 END AS race_position,
              false AS neutralized, 1 AS current_lap
       FROM laps""",
)
def _(t):
    # Rows that no writer schema reads get the defaults too: nothing is cut from the result.
    events = _decoded(t).select("evento.*")
    defaults = {"race_position": 0, "neutralized": False, "current_lap": 1}
    return decode.schema_evolution_fill(events, defaults).select("event_id", *defaults)


@query(
    "decode_failures",
    f"""SELECT event_id, CASE WHEN event_type = 'error' THEN '{decode.UNREADABLE}' END AS reason,
               CASE WHEN event_type <> 'error' THEN
                 CAST(json_extract(props, '$.k') AS INT) END AS k FROM events""",
)
def _(t):
    broken = F.when(F.col("event_type") == "error", F.lit("{broken")).otherwise(F.col("props"))
    rows = t("events").withColumn("payload", broken)
    return decode.decode_failures(rows, "k int").select("event_id", "reason", "evento.k")


@query(
    "bronze_projection",
    """SELECT 'lap_completed' AS topic, kafka_partition, kafka_offset, event_id, race_id,
              event_time FROM laps_raw""",
)
def _(t):
    decoded = t("laps_raw").select(
        F.lit("lap_completed").alias("topic"),
        F.col("event_time").alias("kafka_timestamp"),
        "kafka_partition",
        "kafka_offset",
        F.lit(None).cast("binary").alias("avro_envelope"),
        F.struct("event_id", "race_id", "event_time").alias("evento"),
    )
    return projections.bronze_projection(decoded).drop("kafka_timestamp", "avro_envelope")


@query(
    "silver_lap_projection",
    """SELECT event_id, race_id, car_id, lap, lap_time_ms, valid, pit_lap, kafka_partition,
              kafka_offset FROM laps""",
)
def _(t):
    event = [c for c in projections.SILVER_LAPS if not c.startswith("kafka_")]
    rows = t("laps").withColumn("sectors_ms", F.array("lap_time_ms")).withColumn(
        "race_position", F.lit(0)
    )
    decoded = rows.select("kafka_partition", "kafka_offset", F.struct(*event).alias("evento"))
    return projections.silver_lap_projection(decoded).drop(
        "sectors_ms", "race_position", "event_time"
    )


@query(
    "stream_throughput",
    """SELECT topic, window_start, count(*) AS events, count(*) / 120 AS event_rate,
              count(*) FILTER (WHERE payload = '{"k": 9}') / 120 AS error_rate
       FROM (SELECT topic, payload, time_bucket(INTERVAL 30 SECOND, kafka_timestamp,
                    TIMESTAMP '1970-01-01') - to_seconds(30 * g.i) AS window_start
             FROM envelopes CROSS JOIN (VALUES (0), (1), (2), (3)) AS g(i)) w
       GROUP BY topic, window_start""",
)
def _(t):
    return lifecycle.stream_throughput(t("envelopes"), F.col("payload") == '{"k": 9}')


@query(
    "outbox_backlog",
    """SELECT slot, CAST(queued AS BIGINT) AS queued, CAST(sent AS BIGINT) AS sent,
              CAST(sum(queued - sent) OVER (ORDER BY slot) AS BIGINT) AS backlog
       FROM (SELECT slot, sum(q) AS queued, sum(s) AS sent
             FROM (SELECT time_bucket(INTERVAL 30 SECOND, ts, TIMESTAMP '1970-01-01') AS slot,
                          1 AS q, 0 AS s FROM events
                   UNION ALL
                   SELECT time_bucket(INTERVAL 30 SECOND, ts + to_seconds(user_id % 300),
                                      TIMESTAMP '1970-01-01'), 0, 1
                   FROM events WHERE event_type <> 'error') m GROUP BY slot) t""",
)
def _(t):
    events = t("events")
    outbox = events.select(F.col("event_id").alias("id"), F.col("ts").alias("queued_at"))
    late = F.col("ts") + F.make_dt_interval(secs=F.col("user_id") % 300)
    sent = events.filter("event_type <> 'error'").select(
        F.col("event_id").alias("id"), late.alias("delivered_at")
    )
    return lifecycle.outbox_backlog(outbox, sent)

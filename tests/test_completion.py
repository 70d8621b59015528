"""Lap completion by runs of triggers, and streams whose rows come out of order."""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import functions as F

from pitwall.plans import query_streams as q
from pitwall.plans import registry
from pitwall.sources import decode
from pitwall.streaming import completion

CROSSING = """race_id string, car_id string, lap int, checkpoint_id string, sector int,
    event_id string, lap_elapsed_ms bigint, sector_time_ms bigint, pit_lap boolean,
    neutralized boolean, valid boolean"""


def crossing(point, sector, event, elapsed, own, neutralized=False, lap=3):
    return ("r", "c", lap, point, sector, event, elapsed, own, False, neutralized, True)


def test_laps_come_together_over_triggers_and_are_corrected_late(spark, tmp_path):
    base = str(tmp_path)
    sink = completion.lap_completion_sink(base, fan=2)
    triggers = [
        [crossing("SF", 3, "f", 81_500, 27_000), crossing("SF", 3, "x", 9, 9, lap=4)],
        [crossing("S2", 2, "e", 54_500, None)],
        [crossing("S2", 2, "e", 54_500, 28_500)],
        [crossing("S1", 1, "d", 26_000, 26_000), crossing("S1", 1, "d", 26_000, 26_000)],
        [],
        [crossing("P02", 0, "b", 20_000, None, True), crossing("SF", 3, "a", 81_500, 27_000)],
    ]
    seen = []
    for number, rows in enumerate(triggers):
        batch = spark.createDataFrame(rows, CROSSING)
        sink(batch, number)
        sink(batch, number)
        laps = completion.completed_laps(spark, base, fan=2).collect()
        seen.append([(r.lap, r.event_id, r.lap_time_ms, r.s2_ms, r.valid) for r in laps])
    assert seen[:3] == [[], [], []]
    assert seen[3:5] == [[(3, "f", 81_500, 28_500, True)]] * 2
    assert seen[5] == [(3, "a", 81_500, 28_500, False)]
    # A merged run has one row a lap.
    merged = spark.read.parquet(f"{base}/{completion.PARTS}").filter("level = 2 AND slot = 0")
    assert sorted(r.lap for r in merged.collect()) == [3, 4]


def test_rows_out_of_order_come_once_each_without_a_shuffle(spark):
    rows = spark.range(4000).selectExpr("CAST(id AS STRING) AS event_id", "id")
    again, plans, batches = rows.filter("id % 3 = 0"), [], []
    stream = q._in_turn(SimpleNamespace(spark=spark), [rows, again], "turns")

    def sink(batch, _):
        plans.append(batch._jdf.queryExecution().executedPlan().toString())
        batches.append([r.id for r in batch.collect()])

    stream.writeStream.foreachBatch(sink).trigger(availableNow=True).start().awaitTermination()
    assert len(batches) == 4 and min(map(len, batches)) > 1000
    assert sorted(sum(batches, [])) == sorted([*range(4000), *range(0, 4000, 3)])
    assert not any("Exchange" in plan for plan in plans)


def test_a_payload_is_parsed_once_and_not_for_each_field(spark):
    reader = "event_id string, lap int, extra bigint"
    payload = decode.json_decoder(F.col("payload"), "event_id string, lap int", reader)
    rows = spark.createDataFrame([('{"event_id":"a","lap":3}',), ("{broken",), (None,)], "payload string")
    decoded = rows.withColumn("evento", payload)
    plan = decoded._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    values = [r.evento and tuple(r.evento) for r in decoded.collect()]
    assert values == [("a", 3, None), None, None]


def test_lap_records_come_in_few_triggers_whatever_the_table(spark, monkeypatch):
    laps = spark.range(0, 4000, 1, 50).selectExpr(
        "CAST(id AS STRING) AS event_id", "'r' AS race_id", "'c' AS car_id", "CAST(id AS INT) AS lap",
        "id AS lap_time_ms", "true AS valid", "false AS pit_lap", "timestamp '2024-01-01' AS event_time",
        "0 AS kafka_partition", "id AS kafka_offset",
    )
    commits = []
    monkeypatch.setattr(
        q.jobs, "lap_microbatch_sink", lambda *a: lambda batch, number: commits.append(batch.count())
    )
    tables = type("Tables", (), {"spark": spark, "__call__": lambda self, name: laps})()
    registry._load()
    registry._QUERIES["stream_lap_metrics"](tables)
    assert len(commits) == 8 and sum(commits) == 4000

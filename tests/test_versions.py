"""Tables of merged runs and keyed tables: versions, bounded folders, untouched files."""

from __future__ import annotations

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.operators import lifecycle, timing
from pitwall.plans import query_streams as q
from pitwall.plans.adapters import Tables
from pitwall.sources import storage
from pitwall.streaming import jobs, keyed, runs

NOTE = T.StructType(
    [T.StructField("race_id", T.StringType()), T.StructField("n", T.LongType())]
)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema).coalesce(1)


def folders(path, pattern):
    return sorted(str(p.relative_to(path)) for p in Path(path).glob(pattern))


def files(path):
    return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


@pytest.mark.parametrize("fan, levels", [(2, 1), (2, 3), (3, 2), (8, 4)])
def test_live_runs_hold_every_trigger_once_in_few_folders(fan, levels):
    for last in range(400):
        seen, count = [], 0
        for level, first, end in runs.live_ranges(last, fan, levels):
            seen.append(range(first, end))
            count += len(runs._slots(level, first, end, fan, levels))
        assert sorted(n for part in seen for n in part) == list(range(last + 1))
        assert count <= fan * levels + last // fan**levels + 1


def test_fifty_triggers_keep_folders_few_and_each_version_whole(spark):
    path = storage.scratch(spark, "runs")
    fan, levels, most = 3, 3, 0

    def numbers(version):
        rows = runs.read_runs(spark, path, NOTE, version, fan, levels)
        return sorted(row["n"] for row in rows.collect())

    for run in range(50):
        rows = [] if run == 7 else [(f"r{run % 4}", run * 2), (None, run * 2 + 1)]
        runs.append_run(frame(spark, rows, NOTE), path, run, ["race_id"], fan, levels)
        if run % 10 == 9:
            # A trigger repeated after a failure, merges included, changes nothing.
            runs.append_run(frame(spark, rows, NOTE), path, run, ["race_id"], fan, levels)
        most = max(most, len(folders(path, "level=*/slot=*")))
        if run in (8, 9, 26, 27, 28, 36, 49):
            expected = [n for n in range(2 * run + 2) if n // 2 != 7]
            assert numbers(run) == expected
            # The version before is whole while and after this trigger writes.
            assert numbers(run - 1) == [n for n in expected if n < 2 * run]
    assert most <= 2 * fan * levels + 50 // fan**levels
    assert numbers(-1) == []


def test_readers_of_runs_list_live_folders_only_and_skip_races(spark):
    path = storage.scratch(spark, "pruned-runs")
    for run in range(7):
        runs.append_run(frame(spark, [(f"r{run}", run)], NOTE), path, run, ["race_id"], 3, 2)
    table = runs.read_runs(spark, path, NOTE, 6, 3, 2)
    read = {Path(name).parent.name for name in table.inputFiles()}
    assert read
    kept = table.filter(F.col("race_id").between("r1", "r2"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    try:
        plan = kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = plan.split("PartitionFilters: [")[1]
    assert "level" in filters.split("]")[0] and "GreaterThanOrEqual(race_id,r1)" in filters
    assert sorted(r["n"] for r in kept.collect()) == [1, 2]


def test_lap_tables_stay_whole_over_many_triggers(spark, data):
    base = storage.scratch(spark, "many-triggers")
    records = q.lap_records(Tables(spark, data)).limit(60).cache()
    numbered = records.withColumn("part", F.pmod(F.xxhash64("offset", "key"), F.lit(9))).cache()
    sink = jobs.lap_microbatch_sink(q.decode_laps, base, fan=2)
    for number in range(9):
        # Batch numbers with gaps, as after triggers without laps; each is delivered twice.
        batch = numbered.filter(F.col("part") == number).drop("part")
        sink(batch, number * 3)
        sink(batch, number * 3)
    facts = jobs.lap_table(spark, base, jobs.LAP_FACTS, fan=2)
    distinct = records.select("key", "offset").distinct().count()
    assert facts.count() == facts.select("event_id").distinct().count() == distinct
    commits = jobs.lap_table(spark, base, jobs.LAP_COMMITS, fan=2)
    assert commits.agg(F.sum("received")).first()[0] == records.count()
    assert jobs.lap_table(spark, base, jobs.LAP_FACTS, -1, 2).count() == 0


STATES = T.StructType(
    [T.StructField("race_id", T.StringType()), T.StructField("state_sequence", T.LongType()),
     T.StructField("note", T.StringType())]
)


def test_latest_wins_table_follows_out_of_order_triggers(spark):
    path = storage.scratch(spark, "latest")
    draw = random.Random(4)
    seen, before = [], {}
    for batch_id in range(6):
        races = draw.sample("abcdefgh", 2)
        batch = [(draw.choice(races), draw.randrange(40), f"{batch_id}-{i}") for i in range(4)]
        batch.append((None, batch_id, "no race"))
        seen += batch
        touched = keyed.merge_batch(
            frame(spark, batch, STATES), path, ["race_id"], keyed.latest_wins(), batch_id, 32
        )
        current = keyed.read_table(spark, path, STATES)
        whole = lifecycle.latest_wins_view(frame(spark, seen, STATES))
        assert current.exceptAll(whole).count() == whole.exceptAll(current).count() == 0
        _, live = keyed.live_buckets(spark, path)
        now = {
            bucket: folders(f"{path}/rows", f"_bucket={bucket}/_place={place}/*.parquet")
            for bucket, (_, place) in live.items()
        }
        assert all(now[b] == before[b] for b in before if b not in touched)
        assert all(now[b] != before.get(b) for b in touched)
        before = now
    # Delivered again, or without rows: no bucket and no manifest is written.
    stamp = files(f"{path}/rows") | files(f"{path}/manifest")
    for rows, number in ((seen, 5), (seen, 3), ([], 6)):
        sink = keyed.keyed_sink(path, ["race_id"], keyed.latest_wins(), 32)
        sink(frame(spark, rows, STATES), number)
    assert files(f"{path}/rows") | files(f"{path}/manifest") == stamp
    assert len(folders(path, "manifest/slot=*")) == keyed.SLOTS


def test_rows_without_a_manifest_are_not_seen_and_places_are_cleared(spark):
    path = storage.scratch(spark, "torn")
    rows = [("a", 1, "x"), ("b", 1, "y")]
    keyed.merge_batch(frame(spark, rows, STATES), path, ["race_id"], keyed.latest_wins(), 0, 1)
    # A batch that failed after its rows, in the place the next version uses.
    torn = frame(spark, [("a", 9, "torn")], STATES).withColumns(
        {"_written": F.lit(1).cast("bigint"), "_bucket": F.lit(0), "_place": F.lit(1)}
    )
    torn.write.partitionBy("_bucket", "_place").mode("append").parquet(f"{path}/rows")
    assert {r["note"] for r in keyed.read_table(spark, path, STATES).collect()} == {"x", "y"}
    late = frame(spark, [("a", 2, "z")], STATES)
    keyed.merge_batch(late, path, ["race_id"], keyed.latest_wins(), 1, 1)
    assert {r["note"] for r in keyed.read_table(spark, path, STATES).collect()} == {"z", "y"}
    # A merge that keeps nothing leaves no old rows of the place behind.
    nothing = lambda stored, batch: batch.limit(0)
    for version in (2, 3, 4, 5):
        keyed.merge_batch(late, path, ["race_id"], nothing, version, 1)
        assert keyed.read_table(spark, path, STATES).count() == 0


CROSSINGS = T.StructType(
    [T.StructField("event_id", T.StringType()), T.StructField("race_id", T.StringType()),
     T.StructField("lap", T.IntegerType()), T.StructField("checkpoint_id", T.StringType())]
)


def test_reference_window_holds_three_laps_after_every_trigger(spark):
    path = storage.scratch(spark, "window")
    draw = random.Random(9)
    order = [
        (f"{race}{lap}{line}", race, lap, line)
        for lap in range(1, 10) for race in "xyz" for line in ("S1", "S2", "SF")
    ]
    order.sort(key=lambda row: row[2] + draw.random() * 5)
    order += order[:5] + [("no-lap", "x", None, "S1"), ("x9SF", "x", 9, "SF")]
    seen = []
    for number, start in enumerate(range(0, len(order), 18)):
        batch = order[start : start + 18]
        seen += batch
        keyed.merge_batch(
            frame(spark, batch, CROSSINGS), path, ["race_id"], keyed.reference_window(), number, 8
        )
        window = keyed.read_table(spark, path, CROSSINGS)
        whole = timing.recent_laps(frame(spark, seen, CROSSINGS)).distinct()
        whole = whole.select(*CROSSINGS.names)
        assert window.exceptAll(whole).count() == whole.exceptAll(window).count() == 0
        held = window.groupBy("race_id").agg(F.count_distinct("lap").alias("laps")).collect()
        assert all(row["laps"] <= 3 for row in held)


def test_retention_rewrites_touched_buckets_only(spark):
    schema = T.StructType.fromDDL("event_id string, race_id string, payload string")
    path = storage.scratch(spark, "retained")
    events = [(f"{race}{n}", race, f"p{n}") for race in "abcdefgh" for n in range(3)]
    stored = frame(spark, [*events, ("h0", "h", "again"), ("z", None, "n")], schema)
    keyed.merge_batch(stored, path, ["race_id"], keyed.added_rows, 0)
    before = files(f"{path}/rows")
    expired = stored.filter("race_id IN ('b', 'h') AND event_id <> 'b1'")
    blank = keyed.blank_payloads(lifecycle.BLANK)
    touched = keyed.merge_batch(expired, path, ["race_id"], blank, 1)
    assert 1 <= len(touched) <= 2
    table = keyed.read_table(spark, path, schema)
    expected = lifecycle.retention_apply(stored, expired).select(*schema.names)
    assert table.exceptAll(expected).count() == expected.exceptAll(table).count() == 0
    after = files(f"{path}/rows")
    assert all(after[name] == stamp for name, stamp in before.items())
    assert {name.split("_bucket=")[1].split("/")[0] for name in after.keys() - before.keys()} == {
        str(b) for b in touched
    }
    # A second run finds no candidate and writes nothing.
    left = expired.join(table.filter(F.col("payload") != lifecycle.BLANK), "event_id", "left_semi")
    assert keyed.merge_batch(left, path, ["race_id"], blank, 2) == []
    assert files(f"{path}/rows") == after

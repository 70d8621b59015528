"""Micro-batches of source events: each batch once, nothing kept, every record accounted for."""

from __future__ import annotations

import pytest
from pyspark.sql import DataFrame

from pitwall.operators import quality
from pitwall.sources.layers import read_layer
from pitwall.streaming import ingest

EVENT = """kind string, event_id string, race_id string, simulation_time_us bigint,
    track_progress double, race_position int, track_status string, speed_kmh double,
    fuel_kg double, lap_elapsed_ms bigint, segment_time_ms bigint, sector int,
    sector_time_ms bigint, lap int, pit_stop_time_ms bigint, penalty_seconds int,
    topic string, kafka_partition int, kafka_offset bigint"""


def events(spark, *rows):
    """Rows of ``(kind, event id, race, lap, offset)``; a pit stop before lap one is refused."""
    return spark.createDataFrame(
        [(k, e, r, 5, *[None] * 9, lap, 9, None, k, 0, o) for k, e, r, lap, o in rows], EVENT
    )


def counts(spark, base):
    rows = spark.read.parquet(f"{base}/{ingest.COMMITS}").orderBy("batch_id")
    return [tuple(r) for r in rows.select("received", "stored", "dead", "replayed").collect()]


@pytest.mark.parametrize("large", [0, 2_000_000])
def test_every_record_is_accounted_for(spark, tmp_path, monkeypatch, large):
    monkeypatch.setattr(ingest, "LARGE_BATCH", large)
    sink, base = ingest.ingest_sink(str(tmp_path)), str(tmp_path)
    first = events(spark, ("pitstop", "a", "r1", 1, 2), ("pitstop", "a", "r2", 2, 1),
                   ("pitstop", "b", "r1", 0, 3), ("pitstop", None, None, 1, 4))
    sink(first, 0)
    sink(events(spark, ("pitstop", "a", "r2", 9, 5), ("pitstop", "c", "r1", 3, 6)), 1)
    sink(first.limit(0), 2)
    assert counts(spark, base) == [(4, 1, 2, 1), (2, 1, 0, 1)]
    stored = ingest.stored_facts(spark, base, first.schema)
    assert sorted((r.event_id, r.lap) for r in stored.collect()) == [("a", 2), ("c", 3)]
    outbox = spark.read.parquet(f"{base}/{ingest.OUTBOX}")
    assert sorted(r.id for r in outbox.collect()) == ["pitstop:0:1", "pitstop:0:6"]
    reasons = spark.read.parquet(f"{base}/{ingest.DEAD_LETTERS}").select("reason").collect()
    assert sorted(r.reason for r in reasons) == [quality.BAD_PIT_STOP, quality.NO_IDENTITY]


def test_a_committed_batch_is_not_written_again_and_no_batch_is_kept(spark, tmp_path, monkeypatch):
    kept = []
    monkeypatch.setattr(DataFrame, "persist", lambda self, *a: kept.append(self) or self)
    sink, base = ingest.ingest_sink(str(tmp_path)), str(tmp_path)
    batch = events(spark, ("pitstop", "a", "r1", 1, 1), ("pitstop", "b", "r1", 1, 2))
    sink(batch, 0)
    files = set(tmp_path.rglob("*.parquet"))
    sink(batch, 0)
    assert set(tmp_path.rglob("*.parquet")) == files
    assert not kept
    assert counts(spark, base) == [(2, 2, 0, 0)]


def test_a_batch_that_failed_before_its_commit_is_done_again(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    batch = events(spark, ("pitstop", "a", "r1", 1, 1), ("pitstop", "b", "r2", 1, 2))
    monkeypatch.setattr(ingest, "COMMITS", "elsewhere")
    ingest.ingest_sink(base)(batch, 0)
    monkeypatch.undo()
    assert read_layer(spark, f"{base}/{ingest.COMMITS}", batch.schema).count() == 0
    ingest.ingest_sink(base)(batch, 0)
    assert counts(spark, base) == [(2, 2, 0, 0)]
    assert ingest.stored_facts(spark, base, batch.schema).count() == 2


def test_first_reason_is_that_of_the_list(spark):
    rows = events(spark, ("pitstop", "a", "r", 0, 1), ("pitstop", "", None, 0, 2),
                  ("timing", "t", "r", 1, 3), ("other", "o", "r", 1, 4), ("pit", "p", "r", 1, 5))
    checked = quality.validate_source_event(rows).withColumn(
        "first", quality.first_reason(quality.source_rules(rows))
    )
    assert all(r["first"] == (r.reasons[0] if r.reasons else None) for r in checked.collect())

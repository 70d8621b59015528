"""Layers of every finished race, built by one batch job over all pending races.

Each run writes its races under one ``run_id`` partition of every layer table and commits the run
last.  Readers see committed runs only, so a failed run leaves nothing visible and is simply
repeated; the number of folders grows with the runs, not with the races.  A run indexes the files
archived since the last one and then reads only the topic and day folders of pending races.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pitwall.operators import gold, laps, lifecycle
from pitwall.operators.order import latest_complete_frame
from pitwall.operators.projections import bronze_projection, flatten_state_cars
from pitwall.schemas import TOPICS
from pitwall.sources.decode import Decoder, avro_decoder, decode_by_writer_schema, split_decoded
from pitwall.sources.layers import archive_scan, read_layer
from pitwall.sources.storage import (
    CHECKPOINT_SETTING,
    COMPRESSION,
    shared_root,
    shuffles_dropped,
)
from pitwall.streaming.archive_index import (
    ARCHIVE,
    Contracts,
    days_of_races,
    index_archive,
    records_of_days,
)
from pitwall.streaming.jobs import LAP_COMMITS, LAP_FACTS, LAP_PARTIALS, LAP_WINDOWS, lap_table
from pitwall.streaming.runs import last_commit

log = logging.getLogger(__name__)

BRONZE_EVENTS = "bronze/events"
SILVER_LAPS = "silver/laps"
SILVER_STOPS = "silver/pit_stops"
SILVER_FINAL = "silver/final_telemetry"
GOLD_CLASSIFICATION = "gold/classification"
GOLD_SUMMARY = "gold/summary"
GOLD_COMMITS = "gold/commits"
GOLD_FAILURES = "gold/failures"

RUN = "run_id string"
SUMMARIES = f"race_id string, json string, {RUN}"
RUN_COMMITS = f"races bigint, {RUN}"
FAILURE = "part int, parts int, error string, failed_at timestamp"


def _checkpointed(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Cut a small, often used table from its lineage, in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        root = spark.sparkContext.getConf().get(CHECKPOINT_SETTING) or shared_root(spark)
        spark.sparkContext.setCheckpointDir(root)
    return df.checkpoint()


def _schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def read_committed(spark: SparkSession, base: str, table: str, schema: T.StructType) -> DataFrame:
    """Rows of a layer table from committed runs; ``schema`` ends with ``run_id``.

    If two runs have committed one race, the newer run counts.
    """
    commits = read_layer(spark, f"{base}/{GOLD_COMMITS}", _schema(RUN_COMMITS))
    rows = read_layer(spark, f"{base}/{table}", schema)
    seen = rows.join(commits.select("run_id"), "run_id", "left_semi")
    if "race_id" not in schema.names:
        return seen
    newest = seen.groupBy("race_id").agg(F.max("run_id").alias("run_id"))
    return seen.join(newest, ["race_id", "run_id"], "left_semi").select(*schema.names)


def read_summaries(spark: SparkSession, base: str) -> DataFrame:
    """Gold summaries of the races done so far: ``race_id, json``."""
    return read_committed(spark, base, GOLD_SUMMARY, _schema(SUMMARIES)).select("race_id", "json")


def read_classification(spark: SparkSession, base: str) -> DataFrame:
    """Gold classification of the races done so far."""
    schema = _schema(f"{gold.CLASSIFICATION}, {RUN}")
    return read_committed(spark, base, GOLD_CLASSIFICATION, schema).drop("run_id")


def _run_writer(spark: SparkSession, base: str) -> Callable[[DataFrame, str], DataFrame]:
    """Writer of one run: stores a table in the run's partition and reads it back."""
    run = f"{datetime.now(UTC):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"

    def write(df: DataFrame, table: str) -> DataFrame:
        path = f"{base}/{table}/run_id={run}"
        # Rows of a race lie together, a race of any size is split over several files.
        clustered = df.hint("rebalance", "race_id") if "race_id" in df.columns else df
        if "race_id" in df.columns:
            clustered = clustered.sortWithinPartitions("race_id")
        with shuffles_dropped(spark):
            clustered.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return write


def materialize_finished_races(
    spark: SparkSession,
    base: str,
    contracts: Contracts,
    decoder: Decoder = avro_decoder,
    part: tuple[int, int] = (0, 1),
) -> DataFrame:
    """Write bronze, silver and gold of every finished race that has no summary yet.

    A race whose cars are not all finished in the archive waits for the next run.  ``part`` limits
    the run to one of several parts of the races, by hash.  Returns the races written.
    """
    index_archive(spark, base, contracts, decoder)
    write = _run_writer(spark, base)

    def decode(archive: DataFrame, topic: str) -> DataFrame:
        registry, reader = contracts[topic]
        rows = decode_by_writer_schema(archive, topic, registry, reader, decoder)
        return split_decoded(rows)[0]

    def decoded(topic: str) -> DataFrame:
        return decode(records_of_days(spark, base, topic, days), topic)

    def events(topic: str, races: DataFrame) -> DataFrame:
        return decoded(topic).select("evento.*").join(races, "race_id", "left_semi")

    def incremental(table: str) -> DataFrame:
        # Merged runs are sorted by race, so the bounds skip most of their row groups.
        laps_of_all = lap_table(spark, base, table, lap_version)
        return laps_of_all.filter(F.col("race_id").between(*bounds)).join(
            ready, "race_id", "left_semi"
        )

    archived = archive_scan(spark, f"{base}/{ARCHIVE}", ["control"])
    controls = decode(archived, "control").select("evento.*")
    due = lifecycle.pending_races(controls, read_summaries(spark, base))
    number, parts = part
    pending = _checkpointed(
        spark, due.filter(F.pmod(F.xxhash64("race_id"), F.lit(parts)) == number)
    )
    days = days_of_races(spark, base, pending)
    newest = latest_complete_frame(
        flatten_state_cars(events("state", pending))
        .withColumn("snapshot_id", F.col("frame_snapshot_id"))
        .drop("frame_snapshot_id")
    )
    ready = _checkpointed(spark, laps.race_finish_gate(newest).filter("ready").select("race_id"))
    bounds = ready.agg(F.min("race_id"), F.max("race_id")).first()
    lap_version = last_commit(spark, f"{base}/{LAP_COMMITS}")[0]
    if ready.isEmpty():
        return ready
    final = write(newest.join(ready, "race_id", "left_semi"), SILVER_FINAL)

    facts = incremental(LAP_FACTS)
    merged = laps.merge_lap_partials(incremental(LAP_PARTIALS))
    coverage = _checkpointed(spark, gold.incremental_coverage(final, merged, facts))
    raw = decoded("lap_completed").select("kafka_partition", "kafka_offset", "evento.*")
    chosen = gold.lap_source_choice(coverage, facts, raw.join(ready, "race_id", "left_semi"))
    stored_laps = write(chosen, SILVER_LAPS)
    stops = write(events("pitstop", ready), SILVER_STOPS)
    bronze = _bronze(decoded, contracts).join(ready, "race_id", "left_semi")
    write(gold.bronze_union(bronze, incremental(LAP_WINDOWS), coverage), BRONZE_EVENTS)

    classified = write(
        gold.classification(final, laps.valid_lap_stats(stored_laps), laps.pit_stop_counts(stops)),
        GOLD_CLASSIFICATION,
    )
    summaries = write(gold.gold_summary_json(classified), GOLD_SUMMARY)
    write(summaries.agg(F.count("*").alias("races")), GOLD_COMMITS)
    return ready


def materialize_or_split(
    spark: SparkSession,
    base: str,
    contracts: Contracts,
    decoder: Decoder = avro_decoder,
    most_parts: int = 64,
) -> int:
    """Materialize what is due; where that fails, the halves of it, so that one broken race does
    not hold up the others.

    A part that still fails at ``most_parts`` is logged in a table and left for the next call, as
    its races stay pending.  Returns the number of parts left over.
    """
    open_parts, failed = [(0, 1)], 0
    while open_parts:
        number, parts = open_parts.pop()
        try:
            materialize_finished_races(spark, base, contracts, decoder, (number, parts))
        except Exception as error:
            log.exception("materialization of part %d of %d failed", number, parts)
            if 2 * parts <= most_parts:
                open_parts += [(number, 2 * parts), (number + parts, 2 * parts)]
                continue
            failed += 1
            row = (number, parts, str(error)[:2000], datetime.now(UTC))
            spark.createDataFrame([row], FAILURE).write.mode("append").parquet(
                f"{base}/{GOLD_FAILURES}"
            )
    return failed


def follow_finished_races(
    spark: SparkSession,
    base: str,
    contracts: Contracts,
    checkpoint: str,
    interval: str = "30 seconds",
    decoder: Decoder = avro_decoder,
    most_parts: int = 64,
) -> StreamingQuery:
    """Materialize races as the archive tells that they have finished.

    A clock stream starts a run at every interval, also without new control events, so that races
    whose last frames were late and parts that failed are tried again.  A run without pending races
    reads the new files and the control topic only.
    """

    def tick(_: DataFrame, __: int) -> None:
        materialize_or_split(spark, base, contracts, decoder, most_parts)

    return (
        spark.readStream.format("rate")
        .option("rowsPerSecond", 1)
        .option("numPartitions", 1)
        .load()
        .writeStream.foreachBatch(tick)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=interval)
        .start()
    )


def _bronze(decoded: Callable[[str], DataFrame], contracts: Contracts) -> DataFrame:
    """Minimum columns of every topic: a branch per topic, each over the folders of its days."""
    branches = [
        bronze_projection(decoded(topic)) for topic in TOPICS.values() if topic in contracts
    ]
    merged = branches[0]
    for branch in branches[1:]:
        merged = merged.unionByName(branch)
    return merged

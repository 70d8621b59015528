"""Ingest of source events: validation, dead letters, deduplication, facts and outbox.

One micro-batch goes through all steps and is committed as a whole.  Every record of it ends as a
stored fact, as a dead letter, or as a replay of a stored fact; the commit row counts the three.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.operators.dedup import BROKER_ORDER, dedup_event_id, unseen_events
from pitwall.operators.quality import dead_letter, first_reason, source_rules
from pitwall.sources.layers import committed_batch_scan, read_layer
from pitwall.sources.storage import COMPRESSION, shuffles_dropped

FACTS = "ingest/facts"
DEAD_LETTERS = "ingest/dead_letters"
OUTBOX = "ingest/outbox"
COMMITS = "ingest/commits"
COMMIT = "received bigint, stored bigint, dead bigint, replayed bigint, batch_id bigint"
#: Races are spread over so many folders; a batch reads the folders of its races only.
RACE_SLOTS = 64
IDENTITY = ("kind", "event_id")
#: Beyond so many rows a task's share of a folder is a file worth writing, and the rows of a batch
#: are shuffled once, for their identity, and not again for their folders.
LARGE_BATCH = 2_000_000


def stored_facts(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    """Facts of the committed micro-batches; ``schema`` is that of the source events."""
    layout = T.StructType(
        [*schema.fields, T.StructField("race_slot", T.IntegerType()),
         T.StructField("batch_id", T.LongType())]
    )
    facts = read_layer(spark, f"{base}/{FACTS}", layout)
    commits = read_layer(spark, f"{base}/{COMMITS}", T.StructType.fromDDL(COMMIT))
    return committed_batch_scan(facts, commits)


def ingest_sink(base: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function for wide source events with their broker position.

    A replay is known by kind and event id, however old the first copy is: the batch is compared
    with the stored facts of its races, not with a watermark.  A batch that Spark repeats replaces
    its own folders and is not compared with itself; one that is committed is not written again.

    The batch is read twice and not kept: once for the dead letters, which also counts it, and once
    for the facts.
    """

    def write(frame: DataFrame, table: str, *folders: str) -> None:
        with shuffles_dropped(frame.sparkSession):
            (
                frame.write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .option("compression", COMPRESSION)
                .partitionBy(*folders, "batch_id")
                .parquet(f"{base}/{table}")
            )

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        commits = read_layer(spark, f"{base}/{COMMITS}", T.StructType.fromDDL(COMMIT))
        if not commits.filter(F.col("batch_id") == batch_id).isEmpty():
            return
        number = F.lit(batch_id).cast("bigint").alias("batch_id")
        slot = F.pmod(F.xxhash64("race_id"), F.lit(RACE_SLOTS)).cast("int")
        events = batch.withColumns(
            {"race_slot": slot, "reason": first_reason(source_rules(batch))}
        )
        good = F.col("reason").isNull()
        seen = Observation()
        judged = events.observe(
            seen,
            F.count(F.lit(1)).alias("received"),
            F.count_if(~good).alias("dead"),
            F.collect_set("race_slot").alias("slots"),
        )
        write(dead_letter(judged.filter(~good)).select("*", number), DEAD_LETTERS)
        received, refused = seen.get["received"], seen.get["dead"]
        if not received:
            return
        earlier = stored_facts(spark, base, batch.schema).filter(
            F.col("race_slot").isin(seen.get["slots"]) & (F.col("batch_id") != batch_id)
        )
        once = dedup_event_id(events.filter(good).drop("reason"), BROKER_ORDER, ("kind",))
        fresh = unseen_events(once, earlier, IDENTITY).select(*batch.columns, "race_slot", number)
        if received - refused <= LARGE_BATCH:
            # Few files per folder, while a folder that holds much of the batch is split.
            fresh = fresh.hint("rebalance", "race_slot")
        write(fresh, FACTS, "race_slot")
        facts = spark.read.schema(fresh.schema).parquet(f"{base}/{FACTS}").filter(
            F.col("batch_id") == batch_id
        )
        position = F.concat_ws(":", "topic", "kafka_partition", "kafka_offset")
        write(facts.select(position.alias("id"), "kind", "event_id", "race_id", number), OUTBOX)
        stored = facts.count()
        counts = (received, stored, refused, received - stored - refused, batch_id)
        write(spark.createDataFrame([counts], COMMIT), COMMITS)

    return sink

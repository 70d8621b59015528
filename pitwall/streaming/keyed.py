"""Current rows by key, kept in buckets of which a micro-batch rewrites only those it touches.

A table is ``buckets`` folders by hash of the key, each with ``SLOTS`` places used in turn.  A
batch reads the live place of the buckets its rows fall into, merges, and writes the result to the
next place; then one small manifest names the live place of every bucket.  Untouched buckets keep
their files.  A reader goes by the newest manifest, so it sees whole batches only, and nothing has
to be deleted.  A repeated batch is known by its number; one that failed before its manifest is
done again from the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.operators.lifecycle import latest_wins_view
from pitwall.operators.ranges import keep_first, tie_break
from pitwall.operators.timing import recent_laps
from pitwall.sources.layers import read_layer
from pitwall.sources.storage import COMPRESSION, shuffles_dropped

BUCKETS = 64
SLOTS = 3
MANIFEST = "version bigint, bucket int, written bigint, place int, slot int"
LAYOUT = "_written bigint, _bucket int, _place int"

#: ``(stored rows of the touched buckets, rows of the batch) -> rows to keep``
Merge = Callable[[DataFrame, DataFrame], DataFrame]
Live = dict[int, tuple[int, int]]


def live_buckets(spark: SparkSession, path: str) -> tuple[int, Live]:
    """Version of the table, and for each bucket when and where its rows were written.

    The manifest has one row for each bucket that was ever written, ``SLOTS`` times.
    """
    rows = read_layer(spark, f"{path}/manifest", T.StructType.fromDDL(MANIFEST)).collect()
    version = max((row["version"] for row in rows), default=-1)
    return version, {
        row["bucket"]: (row["written"], row["place"]) for row in rows if row["version"] == version
    }


def _live_rows(live: Live) -> Column:
    """Rows of the live places; the folder conditions are constants, so other folders are pruned."""
    if not live:
        return F.lit(False)
    place = F.create_map(*[F.lit(x) for b, (_, p) in live.items() for x in (b, p)])
    written = F.create_map(*[F.lit(x) for b, (w, _) in live.items() for x in (b, w)])
    return (
        F.col("_bucket").isin(list(live))
        & (F.col("_place") == place[F.col("_bucket")])
        & (F.col("_written") == written[F.col("_bucket")])
    )


def _rows(spark: SparkSession, path: str, schema: T.StructType, live: Live) -> DataFrame:
    layout = T.StructType([*schema.fields, *T.StructType.fromDDL(LAYOUT).fields])
    stored = read_layer(spark, f"{path}/rows", layout)
    return stored.filter(_live_rows(live)).select(*schema.names)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of the newest version."""
    return _rows(spark, path, schema, live_buckets(spark, path)[1])


def _put(rows: DataFrame, path: str, *folders: str) -> None:
    with shuffles_dropped(rows.sparkSession):
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", COMPRESSION)
            .partitionBy(*folders)
            .parquet(path)
        )


def _laid_down(batch: DataFrame, path: str, version: int) -> DataFrame:
    """The batch as a table, so that it is computed once and lost executors cost nothing."""
    _put(
        batch.withColumns({"_written": F.lit(version).cast("bigint"), "_place": F.lit(0)}),
        f"{path}/batch",
        "_place",
    )
    layout = T.StructType([*batch.schema.fields, *T.StructType.fromDDL(LAYOUT).fields])
    stored = read_layer(batch.sparkSession, f"{path}/batch", layout)
    return stored.filter(F.col("_written") == version).select(*batch.columns)


def merge_batch(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    merge: Merge,
    version: int,
    buckets: int = BUCKETS,
) -> list[int]:
    """Merge one batch into the table and return the buckets written anew.

    ``merge`` must keep a row in its bucket, which holds all rows of its keys; rows it leaves out
    are gone with this version.  ``buckets`` must not change over the life of a table.
    """
    spark = batch.sparkSession
    newest, live = live_buckets(spark, path)
    if version <= newest:
        return []
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    batch = _laid_down(batch, path, version)
    touched = sorted(row[0] for row in batch.select(bucket).distinct().collect())
    if not touched:
        return []
    before = {b: live[b] for b in touched if b in live}
    kept = merge(_rows(spark, path, batch.schema, before), batch).select(*batch.columns)
    places = {b: (before[b][1] + 1) % SLOTS if b in before else 0 for b in touched}
    place = F.create_map(*[F.lit(x) for pair in places.items() for x in pair])
    placed = kept.withColumns(
        {"_written": F.lit(version).cast("bigint"), "_bucket": bucket, "_place": place[bucket]}
    )
    # Few files per bucket, while a bucket that holds much of the table is split.
    _put(placed.hint("rebalance", "_bucket"), f"{path}/rows", "_bucket", "_place")
    live = {**live, **{b: (version, p) for b, p in places.items()}}
    lines = [(version, b, written, p, version % SLOTS) for b, (written, p) in live.items()]
    _put(spark.createDataFrame(lines, MANIFEST).coalesce(1), f"{path}/manifest", "slot")
    return touched


def keyed_sink(
    path: str, keys: Sequence[str], merge: Merge, buckets: int = BUCKETS
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function around :func:`merge_batch`."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch, path, keys, merge, batch_id, buckets)

    return sink


def added_rows(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Every row, stored and new."""
    return stored.unionByName(batch)


def replace_rows(keys: Sequence[str]) -> Merge:
    """Rows of the batch take the place of stored rows of the same key (update mode)."""

    def merge(stored: DataFrame, batch: DataFrame) -> DataFrame:
        newest = keep_first(batch, keys, [tie_break(batch)])
        return stored.join(newest.select(*keys), list(keys), "left_anti").unionByName(newest)

    return merge


def latest_wins(sequence: str = "state_sequence") -> Merge:
    """One row per race; an event older than the stored one changes nothing.  Keyed by race."""

    def merge(stored: DataFrame, batch: DataFrame) -> DataFrame:
        return latest_wins_view(stored.unionByName(batch), sequence)

    return merge


def reference_window(laps: int = 3) -> Merge:
    """Crossings of the last ``laps`` laps of each race, each event once.  Keyed by race.

    A crossing leaves when the race moves on, by its newest lap and not by time: a race holds that
    many laps and no more, and a late crossing of an older lap does not come back.
    """

    def merge(stored: DataFrame, batch: DataFrame) -> DataFrame:
        # Old crossings go before the window sorts what is left.
        rows = recent_laps(stored.unionByName(batch), laps)
        return keep_first(rows, ["race_id", "event_id"], [tie_break(rows)])

    return merge


def blank_payloads(blank: str) -> Merge:
    """Stored rows whose event id is in the batch lose their payload; other rows stay.

    The batch has the columns of the table and adds no row.
    """

    def merge(stored: DataFrame, batch: DataFrame) -> DataFrame:
        marked = batch.select("race_id", "event_id").distinct().withColumn("_gone", F.lit(True))
        payload = F.when(F.col("_gone"), F.lit(blank)).otherwise(F.col("payload"))
        joined = stored.join(marked, ["race_id", "event_id"], "left")
        return joined.withColumn("payload", payload)

    return merge

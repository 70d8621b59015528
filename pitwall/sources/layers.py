"""Archive scan, committed micro-batches and idempotent layer tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.schemas import ENVELOPE


def archive_scan(
    spark: SparkSession,
    path: str,
    topics: Sequence[str] | None = None,
    dates: tuple[str, str] | None = None,
    schema: T.StructType = ENVELOPE,
) -> DataFrame:
    """Archived envelopes of some topics and days (both bounds included).

    Topic and date are partition columns, so other folders are not listed or read.
    """
    archive = spark.read.schema(schema).parquet(path)
    if topics is not None:
        archive = archive.filter(F.col("topic").isin(*topics))
    if dates is not None:
        first, last = dates
        archive = archive.filter(
            F.col("event_date_utc").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
        )
    return archive


def committed_batch_scan(facts: DataFrame, commit_log: DataFrame) -> DataFrame:
    """Facts of the micro-batches that were committed."""
    return facts.join(commit_log.select("batch_id").distinct(), "batch_id", "left_semi")


def layer_table_sink(df: DataFrame, path: str, keys: Sequence[str] = ("race_id",)) -> None:
    """Write a layer table so that a re-run replaces exactly the partitions it produces.

    Rows are rebalanced by the partition columns first: few files per partition, and a partition
    that holds much of the table is split over several tasks.
    """
    balanced = df.hint("rebalance", *keys)
    (
        balanced.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def read_layer(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A layer table, or an empty table of its schema when nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)

"""Readiness of streaming queries from samples of their progress."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

SAMPLE = """query_id string, sampled_at double, active boolean, busy boolean, batch_id bigint,
    input_rows bigint, batch_ms bigint"""


def progress_sample(query: StreamingQuery, at: float) -> tuple:
    """One row of ``SAMPLE``: what a query shows of itself at ``at`` seconds."""
    last = query.lastProgress
    batch = None if last is None else last["batchId"]
    rows = 0 if last is None else last["numInputRows"]
    spent = 0 if last is None else last["durationMs"].get("triggerExecution", 0)
    return query.id, at, query.isActive, query.status["isTriggerActive"], batch, rows, spent


def query_health(samples: DataFrame, limit_seconds: float) -> DataFrame:
    """Every sample with ``busy_seconds`` and ``ready``.

    A stretch is a run of consecutive busy samples of a query that show the same finished batch,
    so one micro-batch is at work all the time. A query is ready while it is active and its stretch
    has lasted ``limit_seconds`` at most; an idle query stays ready however long it waits. Samples
    of one query at one time are ordered by batch.
    """
    order = Window.partitionBy("query_id").orderBy("sampled_at", F.col("batch_id").asc_nulls_first())
    goes_on = (
        F.col("busy")
        & F.lag("busy", 1, False).over(order)
        & F.col("batch_id").eqNullSafe(F.lag("batch_id").over(order))
    )
    marked = samples.withColumn("_new", F.when(goes_on, 0).otherwise(1))
    numbered = marked.withColumn("_stretch", F.sum("_new").over(order))
    began = F.min("sampled_at").over(Window.partitionBy("query_id", "_stretch"))
    busy_seconds = F.when(F.col("busy"), F.col("sampled_at") - began).otherwise(0.0)
    return (
        numbered.withColumn("busy_seconds", busy_seconds)
        .withColumn("ready", F.col("active") & (F.col("busy_seconds") <= limit_seconds))
        .drop("_new", "_stretch")
    )

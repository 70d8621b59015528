"""Reading topics from and publishing events to the broker."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.schemas import TOPICS, topic_of


def broker_options(
    servers: str,
    max_offsets: int,
    topics: Sequence[str] = tuple(TOPICS.values()),
    starting: str = "earliest",
) -> dict[str, str]:
    """Source options: topics with headers, ``max_offsets`` a trigger in all, failing on lost offsets."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
        "failOnDataLoss": "true",
        "maxOffsetsPerTrigger": str(max_offsets),
        "includeHeaders": "true",
    }


def broker_source(
    spark: SparkSession,
    servers: str,
    max_offsets: int,
    topics: Sequence[str] = tuple(TOPICS.values()),
    starting: str = "earliest",
) -> DataFrame:
    """Stream of broker records; needs Spark's Kafka connector on the class path."""
    options = broker_options(servers, max_offsets, topics, starting)
    return spark.readStream.format("kafka").options(**options).load()


def partition_key(car_id: Column, race_id: Column) -> Column:
    """Broker key: the car where there is one, else the race."""
    return F.coalesce(F.when(car_id != "", car_id), race_id)


def event_sink(events: DataFrame, value: Column | None = None) -> DataFrame:
    """Events as broker records: topic of the kind, key, value (JSON of the row by default).

    The result goes to ``write`` or ``writeStream`` with ``format("kafka")``.
    """
    body = F.to_json(F.struct(*events.columns)) if value is None else value
    return events.select(
        topic_of(F.col("kind")).alias("topic"),
        partition_key(F.col("car_id"), F.col("race_id")).alias("key"),
        body.alias("value"),
    )

"""Batch job that checks the online summary against the archive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.operators import gold, laps
from pitwall.operators.projections import flatten_analytics_cars
from pitwall.sources.decode import Decoder, avro_decoder, decode_by_writer_schema, split_decoded
from pitwall.sources.layers import archive_scan
from pitwall.streaming.archive_index import ARCHIVE, Contracts

LAP_TOPIC = "lap_completed"
ANALYTICS_TOPIC = "analytics"
PERFORMANCE = "gold/lap_performance"
PARITY = "gold/consumer_parity"


def archive_parity(
    spark: SparkSession,
    base: str,
    contracts: Contracts,
    decoder: Decoder = avro_decoder,
    dates: tuple[str, str] | None = None,
) -> DataFrame:
    """Write lap statistics of the archive and their comparison with the online summary.

    Both tables are replaced as a whole.  Returns the counts of ``parity_summary`` and, in
    ``undecodable``, how many archived records of the two topics could not be read.  ``dates``
    limits the days of the archive (both bounds included).
    """
    archive = archive_scan(spark, f"{base}/{ARCHIVE}", [LAP_TOPIC, ANALYTICS_TOPIC], dates)

    def decoded(topic: str) -> tuple[DataFrame, DataFrame]:
        registry, reader = contracts[topic]
        return split_decoded(decode_by_writer_schema(archive, topic, registry, reader, decoder))

    (lap_rows, bad_laps), (summaries, bad_summaries) = decoded(LAP_TOPIC), decoded(ANALYTICS_TOPIC)
    performance = laps.lap_performance(
        lap_rows.select("evento.*", "kafka_partition", "kafka_offset")
    )
    online = flatten_analytics_cars(summaries.select("evento.*", "kafka_offset"))
    performance.write.mode("overwrite").parquet(f"{base}/{PERFORMANCE}")
    stored = spark.read.schema(performance.schema).parquet(f"{base}/{PERFORMANCE}")
    parity = gold.consumer_parity(stored, gold.latest_analytics(online))
    parity.write.mode("overwrite").parquet(f"{base}/{PARITY}")
    compared = spark.read.schema(parity.schema).parquet(f"{base}/{PARITY}")
    unread = bad_laps.count() + bad_summaries.count()
    return gold.parity_summary(compared).withColumn("undecodable", F.lit(unread).cast("bigint"))

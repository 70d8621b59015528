"""Integrity checks of the envelope archive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.schemas import ENVELOPE

REQUIRED_VALUES = ("kafka_timestamp", "topic", "kafka_partition", "kafka_offset", "avro_envelope")
OFFSET = ["topic", "kafka_partition", "kafka_offset"]


def archive_required_columns(archive: DataFrame) -> list[str]:
    """Required archive columns that are missing (schema only, no job)."""
    return sorted(set(ENVELOPE.names) - set(archive.columns))


def _lacks_metadata(archive: DataFrame) -> Column:
    missing = F.lit(False)
    for name in REQUIRED_VALUES:
        if name in archive.columns:
            missing = missing | F.col(name).isNull()
    return missing


def archive_null_metadata(archive: DataFrame) -> DataFrame:
    """Number of rows without the broker metadata every record must have."""
    return archive.agg(F.count_if(_lacks_metadata(archive)).alias("rows_without_metadata"))


def archive_duplicate_offsets(archive: DataFrame) -> DataFrame:
    """Broker positions stored more than once."""
    return archive.groupBy(*OFFSET).agg(F.count("*").alias("copies")).filter("copies > 1")


def archive_summary(archive: DataFrame) -> DataFrame:
    """Rows, topics, duplicate positions and rows without metadata, in one pass."""
    positions = archive.groupBy(*OFFSET).agg(
        F.count("*").alias("copies"),
        F.count_if(_lacks_metadata(archive)).alias("lacking"),
    )
    return positions.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).cast("bigint").alias("registros"),
        F.countDistinct("topic").alias("topicos"),
        F.count_if(F.col("copies") > 1).alias("duplicate_offsets"),
        F.coalesce(F.sum("lacking"), F.lit(0)).cast("bigint").alias("rows_without_metadata"),
    )


def check_archive(archive: DataFrame) -> dict[str, int]:
    """Run the archive checks; raise if a column, a value or every record is missing.

    Only the one-row summary reaches the driver.
    """
    missing = archive_required_columns(archive)
    if missing:
        raise ValueError(f"archive columns missing: {missing}")
    summary = archive_summary(archive).first().asDict()
    if summary["rows_without_metadata"]:
        raise ValueError("archive rows without required metadata")
    if summary["duplicate_offsets"]:
        raise ValueError(f"{summary['duplicate_offsets']} duplicate offsets in the archive")
    if not summary["registros"]:
        raise ValueError("the archive holds no events yet")
    return {"registros": summary["registros"], "topicos": summary["topicos"]}

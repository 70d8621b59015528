"""Classification, coverage of the incremental path, parity and the race summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.functions.text import country_flag, medal, trophy
from pitwall.operators.dedup import dedup_event_id
from pitwall.operators.laps import fact_lap_counts
from pitwall.operators.ranges import keep_first, tie_break

CAR = ["race_id", "car_id"]
IDENTITY = ["driver_id", "driver_name", "driver_country_code", "team_id"]
# Fixed value: race identifiers accepted by the summary lookup.
RACE_ID = "^[A-Za-z0-9_-]+$"

# Columns of the gold table, in order.
CLASSIFICATION = """race_id string, car_id string, driver_id string, driver_name string,
    driver_country_code string, team_id string, position int, best_lap_time_ms bigint,
    worst_lap_time_ms bigint, average_lap_time_ms double, valid_lap_count bigint,
    pit_stop_count int, podium_medal string, country_flag string, trophy string"""


def classification(
    final_state: DataFrame, lap_stats: DataFrame, pit_counts: DataFrame
) -> DataFrame:
    """Final classification of every race: state, lap statistics, pit stops and podium.

    Best and worst lap fall back to the counters of the car's state, which include invalid laps.
    """
    base = final_state.select(
        *CAR,
        *IDENTITY,
        F.col("race_position").cast("int").alias("position"),
        F.col("best_lap_time_ms").cast("bigint").alias("_state_best"),
        F.col("worst_lap_time_ms").cast("bigint").alias("_state_worst"),
        F.col("pit_stops").cast("int").alias("_state_stops"),
    )
    stats = lap_stats.select(
        *CAR, "best_lap_time_ms", "worst_lap_time_ms", "average_lap_time_ms", "valid_lap_count"
    )
    stops = F.greatest(F.col("pit_stop_count"), F.col("_state_stops"))
    return (
        base.join(stats, CAR, "left")
        .join(pit_counts, CAR, "left")
        .select(
            *CAR,
            *IDENTITY,
            "position",
            F.coalesce("best_lap_time_ms", "_state_best").alias("best_lap_time_ms"),
            F.coalesce("worst_lap_time_ms", "_state_worst").alias("worst_lap_time_ms"),
            "average_lap_time_ms",
            "valid_lap_count",
            F.coalesce(stops, F.lit(0)).cast("int").alias("pit_stop_count"),
            medal(F.col("position")).alias("podium_medal"),
            country_flag(F.col("driver_country_code")).alias("country_flag"),
            trophy(F.col("position")).alias("trophy"),
        )
    )


def classification_order(classified: DataFrame) -> DataFrame:
    """Classification sorted for display: race by race, by position and car."""
    return classified.orderBy("race_id", "position", "car_id")


def podium(classified: DataFrame, n: int = 3) -> DataFrame:
    """First ``n`` positions with medal and trophy."""
    return classified.filter(F.col("position") <= n).select(
        *CAR,
        "driver_name",
        "position",
        medal(F.col("position")).alias("podium_medal"),
        trophy(F.col("position")).alias("trophy"),
    )


def incremental_coverage(
    final_state: DataFrame, partials: DataFrame, facts: DataFrame
) -> DataFrame:
    """Per race: whether incremental facts and partials cover every car's final lap count."""
    counts = (
        final_state.select(*CAR, F.col("laps_completed").cast("bigint").alias("laps_completed"))
        .join(partials.select(*CAR, "completed_lap_count"), CAR, "left")
        .join(fact_lap_counts(facts), CAR, "left")
    )
    completed = F.coalesce("completed_lap_count", F.lit(0))
    stored = F.coalesce("fact_lap_count", F.lit(0))
    match = (completed == F.col("laps_completed")) & (stored == F.col("laps_completed"))
    return counts.groupBy("race_id").agg(
        (F.bool_and(match) & (F.sum(completed) > 0) & (F.sum(stored) > 0)).alias("covered")
    )


def lap_source_choice(
    coverage: DataFrame, facts: DataFrame, raw_laps: DataFrame
) -> DataFrame:
    """Lap facts per race: incremental ones where they cover the race, raw ones elsewhere."""
    covered = coverage.filter("covered").select("race_id")
    incremental = dedup_event_id(facts).join(covered, "race_id", "left_semi")
    raw = raw_laps.join(covered, "race_id", "left_anti")
    shared = [name for name in facts.columns if name in raw_laps.columns]
    return (
        incremental.select(*shared)
        .withColumn("lap_source", F.lit("incremental"))
        .unionByName(raw.select(*shared).withColumn("lap_source", F.lit("raw")))
    )


def bronze_union(
    decoded: DataFrame, incremental_laps: DataFrame, coverage: DataFrame
) -> DataFrame:
    """Minimum columns of every topic; laps of covered races come from the incremental path."""
    covered = coverage.filter("covered").select("race_id")
    is_lap = F.col("topic") == "lap_completed"
    others = decoded.filter(~is_lap)
    raw_laps = decoded.filter(is_lap).join(covered, "race_id", "left_anti")
    stored = dedup_event_id(incremental_laps).join(covered, "race_id", "left_semi")
    columns = decoded.columns
    return (
        others.unionByName(raw_laps.select(*columns)).unionByName(stored.select(*columns))
    )


def latest_analytics(online: DataFrame) -> DataFrame:
    """Newest revision of the online summary per race and car; of equal ones the last offset."""
    return keep_first(online, CAR, [F.col("revision").desc(), tie_break(online).desc()])


def consumer_parity(stats: DataFrame, online: DataFrame) -> DataFrame:
    """Batch statistics beside the online summary, with their null-safe equality."""
    pairs = [
        ("voltas_validas", "voltas_consumer"),
        ("melhor_volta_ms", "melhor_consumer_ms"),
        ("pior_volta_ms", "pior_consumer_ms"),
    ]
    equal: Column = F.lit(True)
    for ours, theirs in pairs:
        equal = equal & F.col(ours).eqNullSafe(F.col(theirs))
    return stats.join(online, CAR, "full").withColumn("paridade", equal)


def parity_summary(parity: DataFrame) -> DataFrame:
    """Cars, compared, equal and diverging pairs as one row (zeros for empty input)."""
    return parity.agg(
        F.count("car_id").alias("carros"),
        F.count("paridade").alias("comparados"),
        F.count_if(F.col("paridade")).alias("coincidentes"),
        F.count_if(~F.col("paridade")).alias("divergentes"),
    )


def gold_summary_json(classified: DataFrame) -> DataFrame:
    """One JSON document per race: ``{race_id, classification: [...]}`` in final order.

    A document lists the entrants of one race; it is built by aggregation, not on the driver.
    """
    names = [name for name in classified.columns if name != "race_id"]
    ordered = [F.col("position"), F.col("car_id")]
    rest = [F.col(name) for name in names if name not in ("position", "car_id")]
    rows = F.sort_array(F.collect_list(F.struct(*ordered, *rest)))
    options = {"ignoreNullFields": "false"}
    return (
        classified.groupBy("race_id")
        .agg(rows.alias("_rows"))
        .select(
            "race_id",
            F.to_json(
                F.struct(
                    "race_id",
                    F.transform(
                        "_rows",
                        lambda row: F.struct(
                            F.col("race_id"), *[row[name].alias(name) for name in names]
                        ),
                    ).alias("classification"),
                ),
                options,
            ).alias("json"),
        )
    )


def gold_summary_read(summaries: DataFrame, race_id: str | None = None) -> DataFrame:
    """Parsed summaries whose key is well formed and equals the race inside the document."""
    document = F.from_json(
        "json", f"race_id string, classification array<struct<{_struct_fields()}>>"
    )
    rows = summaries if race_id is None else summaries.filter(F.col("race_id") == race_id)
    return (
        rows.filter(F.col("race_id").rlike(RACE_ID))
        .withColumn("_document", document)
        .filter(F.col("_document.race_id") == F.col("race_id"))
        .select("race_id", F.col("_document.classification").alias("classification"))
    )


def _struct_fields() -> str:
    fields = [part.strip().split() for part in CLASSIFICATION.split(",")]
    return ", ".join(f"{name}: {kind}" for name, kind in fields)

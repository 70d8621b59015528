"""Splits, sector bests and records over timing crossings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitwall.functions.text import split_color
from pitwall.operators import ranges
from pitwall.operators.ranges import keep_first

CAR = ["race_id", "car_id"]


def counts_for_records() -> Column:
    """A crossing sets records when it is valid and not on a pit lap."""
    return F.col("valid") & ~F.col("pit_lap")


def _record_time() -> Column:
    return F.when(counts_for_records(), F.col("segment_time_ms"))


def checkpoint_bests(timing: DataFrame) -> DataFrame:
    """Best segment time per checkpoint at car, team and race level.

    Crossings are reduced once to car level; the other two levels come from that small table.
    """
    car_level = timing.groupBy("race_id", "car_id", "team_id", "checkpoint_id").agg(
        F.min(_record_time()).alias("best_ms")
    )

    def level(scope: str, subject: Column) -> Column:
        return F.struct(F.lit(scope).alias("scope"), subject.alias("subject"))

    levels = F.array(
        level("personal", F.col("car_id")),
        level("team", F.col("team_id")),
        level("race", F.lit("")),
    )
    return (
        car_level.filter(F.col("best_ms").isNotNull())
        .select("race_id", "checkpoint_id", "best_ms", F.explode(levels).alias("of"))
        .groupBy("race_id", "of.scope", "of.subject", "checkpoint_id")
        .agg(F.min("best_ms").alias("best_ms"))
    )


def sector_bests(timing: DataFrame) -> DataFrame:
    """Best time of each sector per car, as columns and as an array with gaps."""

    def best(number: int) -> Column:
        return F.min(F.when(F.col("sector") == number, F.col("sector_time_ms")))

    bests = (
        timing.filter(counts_for_records() & (F.col("sector") > 0))
        .groupBy(*CAR)
        .agg(*[best(number).alias(f"s{number}_ms") for number in (1, 2, 3)])
    )
    return bests.withColumn("sector_best_ms", F.array("s1_ms", "s2_ms", "s3_ms"))


def theoretical_lap(bests: DataFrame) -> DataFrame:
    """Sum of the three sector bests, null unless all exist."""
    total = F.col("s1_ms") + F.col("s2_ms") + F.col("s3_ms")
    return bests.select(*CAR, total.alias("theoretical_lap_ms"))


def latest_split(timing: DataFrame) -> DataFrame:
    """Crossing of the highest lap per car and checkpoint."""
    newest = [F.col("lap").desc(), F.col("simulation_time_us").desc(), F.col("event_id").desc()]
    return keep_first(timing, [*CAR, "checkpoint_id"], newest)


def splits_with_bests(timing: DataFrame) -> DataFrame:
    """Latest split per car and checkpoint, compared with personal, team and race bests.

    Input is deduplicated by logical key, so a car has one crossing per lap and checkpoint.
    Crossings are reduced to one row per car and checkpoint in a single pass; team and race
    bests are minima over that reduced table, whose groups hold the entrants of one race.
    """
    ok = counts_for_records()

    def newest(value: Column) -> Column:
        return F.max_by(value, F.col("lap"))

    # Numbers only, so the reduction is a hash aggregation without a sort of the crossings.
    reduced = timing.groupBy(*CAR, "team_id", "checkpoint_id").agg(
        F.max("lap").alias("lap"),
        newest(F.col("segment_time_ms")).alias("segment_time_ms"),
        newest(F.col("lap_elapsed_ms")).alias("lap_elapsed_ms"),
        newest(ok).alias("valid"),
        F.min(_record_time()).alias("best_team_ms"),
    )
    # A car that changed team keeps one split row but adds to the best of each of its teams.
    point = Window.partitionBy("race_id", "checkpoint_id")
    team = Window.partitionBy("race_id", "checkpoint_id", "team_id")
    own = Window.partitionBy("race_id", "checkpoint_id", "car_id")
    compared = (
        reduced.withColumn("best_race_ms", F.min("best_team_ms").over(point))
        .withColumn("best_personal_ms", F.min("best_team_ms").over(own))
        .withColumn("_last_lap", F.max("lap").over(own))
        .withColumn("best_team_ms", F.min("best_team_ms").over(team))
        .filter(F.col("lap") == F.col("_last_lap"))
    )
    time = F.col("segment_time_ms")
    return compared.select(
        *CAR,
        "team_id",
        "checkpoint_id",
        "lap",
        "segment_time_ms",
        "lap_elapsed_ms",
        "best_personal_ms",
        "best_team_ms",
        "best_race_ms",
        (time - F.col("best_personal_ms")).alias("delta_ms"),
        split_color(
            F.col("valid"), time, F.col("best_personal_ms"), F.col("best_race_ms")
        ).alias("color"),
        "valid",
    )


def split_progression(timing: DataFrame, slice_us: int = ranges.CLOCK_SLICE_US) -> DataFrame:
    """Colour and delta of every crossing at the moment it happened.

    Only strictly earlier crossings of the same race and checkpoint count, ordered by clock and
    then car.  The race is cut into clock slices (see :mod:`pitwall.operators.ranges`).
    """
    point = ["race_id", "checkpoint_id"]
    rows = ranges.with_slice(
        timing.withColumn("_record", _record_time()), "simulation_time_us", slice_us
    )
    own_minima = rows.groupBy(*point, "car_id", ranges.SLICE).agg(
        F.min("_record").alias("_record")
    )
    minimum = {"_record": (F.min("_record"), ranges.running_min)}
    own_seeds = ranges.carried(own_minima, [*point, "car_id"], minimum)
    race_seeds = ranges.carried(own_minima, point, minimum)
    merged = ranges.with_seeds(rows, own_seeds, race_seeds)

    order = [F.col("simulation_time_us"), F.col("car_id"), F.col("lap"), F.col("event_id")]
    race = ranges.slice_window(point, order).rowsBetween(Window.unboundedPreceding, -1)
    own = (
        Window.partitionBy(*point, ranges.SLICE, "car_id")
        .orderBy(F.col(ranges.IS_ROW), *order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    seen = merged.withColumn("_race_best", F.min("_record").over(race)).withColumn(
        "_own_best", F.min("_record").over(own)
    )
    time = F.col("segment_time_ms")
    color = (
        F.when(~counts_for_records(), F.lit("gray"))
        .when(F.col("_race_best").isNull() | (time <= F.col("_race_best")), F.lit("purple"))
        .when(F.col("_own_best").isNull() | (time < F.col("_own_best")), F.lit("green"))
        .otherwise(F.lit("yellow"))
    )
    coloured = seen.withColumn("color", color).withColumn("delta_ms", time - F.col("_own_best"))
    return ranges.drop_seeds(coloured, "_record", "_race_best", "_own_best")


def splits_by_track_position(splits: DataFrame, lines: DataFrame) -> DataFrame:
    """Splits with the rank of their line along the track; unknown lines come last.

    ``lines`` has ``fraction, checkpoint_id`` and is as short as the track has lines.
    """
    placed = splits.join(lines.select("checkpoint_id", "fraction"), "checkpoint_id", "left")
    placed = placed.withColumn("line_position", F.coalesce("fraction", F.lit(2.0)))
    along = Window.partitionBy(*CAR).orderBy("line_position", "checkpoint_id")
    return placed.withColumn("line_rank", F.row_number().over(along)).drop("fraction")


def recent_laps(timing: DataFrame, n: int = 3) -> DataFrame:
    """Crossings of the last ``n`` laps of each race: the window of the gap reference."""
    newest = timing.groupBy("race_id").agg(F.max("lap").alias("_newest_lap"))
    return (
        timing.join(newest, "race_id")
        .filter(F.col("lap") >= F.col("_newest_lap") - (n - 1))
        .drop("_newest_lap")
    )

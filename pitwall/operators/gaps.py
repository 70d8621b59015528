"""Gaps measured at one reference crossing shared by every car of a race.

The crossings of a point are grouped into blocks of consecutive positions, each a short sorted
array.  Order is checked inside a block by comparing it with its sorted self and between blocks
by their first and last times, so a point crossed by very many cars is spread over many tasks
and the crossings are shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitwall.operators import ranges
from pitwall.operators.timing import recent_laps

POINT = ["race_id", "lap", "checkpoint_id"]


def _to_ms(microseconds: Column) -> Column:
    return F.bround(microseconds / 1000, 0).cast("bigint")


def _blocks(timing: DataFrame, order: DataFrame) -> DataFrame:
    """Recent crossings of the ranked cars per point and block of positions.

    Positions of a race are unique and crossings are deduplicated, so a block holds at most
    ``POSITION_SLICE`` cars.
    """
    position = F.col("race_position").cast("int").alias("position")
    ranked = order.select("race_id", "car_id", position)
    crossings = (
        recent_laps(timing)
        .select(*POINT, "car_id", F.col("simulation_time_us").alias("at_us"))
        .join(ranked, ["race_id", "car_id"])
    )
    sliced = ranges.with_slice(crossings, "position", ranges.POSITION_SLICE)
    return sliced.groupBy(*POINT, ranges.SLICE).agg(
        F.sort_array(F.collect_list(F.struct("position", "car_id", "at_us"))).alias("cars"),
        F.count("*").alias("crossed"),
        F.min("at_us").alias("first_us"),
        F.max("at_us").alias("last_us"),
    )


def _field(order: DataFrame) -> DataFrame:
    """Per race: number of ranked cars, newest car clock and the leader's laps."""
    return order.groupBy("race_id").agg(
        F.count("*").alias("ranked_cars"),
        F.max("simulation_time_us").alias("now_us"),
        F.min_by("laps_completed", "race_position").alias("leader_laps"),
    )


def _reference_blocks(timing: DataFrame, order: DataFrame) -> DataFrame:
    """Blocks of the usable point with the latest leader time of each race."""
    point = Window.partitionBy(*POINT)
    earlier = point.orderBy(ranges.SLICE).rowsBetween(Window.unboundedPreceding, -1)
    times = F.transform("cars", lambda car: car["at_us"])
    follows = F.col("ahead_us").isNull() | (F.col("first_us") >= F.col("ahead_us"))
    usable = (
        _blocks(timing, order)
        .withColumn("ahead_us", F.max("last_us").over(earlier))
        .withColumn("_in_order", F.bool_and((times == F.array_sort(times)) & follows).over(point))
        .withColumn("_crossed", F.sum("crossed").over(point))
        .withColumn("leader_us", F.min("first_us").over(point))
        .withColumn("last_us", F.max("last_us").over(point))
        .filter("_in_order")
        .join(_field(order).select("race_id", "ranked_cars"), "race_id")
        .filter("_crossed = ranked_cars")
    )
    newest = Window.partitionBy("race_id").orderBy(
        F.col("leader_us").desc(), F.col("lap").desc(), F.col("checkpoint_id").desc()
    )
    return usable.withColumn("_rank", F.rank().over(newest)).filter("_rank = 1").drop("_rank")


def gap_reference(timing: DataFrame, order: DataFrame) -> DataFrame:
    """Reference crossing per race.

    Among the points of the last three laps that every ranked car crossed in position order, the
    one with the latest leader time; ties go to the highest lap, then checkpoint.
    """
    return _reference_blocks(timing, order).select(*POINT, "leader_us", "last_us").distinct()


def gaps(timing: DataFrame, order: DataFrame) -> DataFrame:
    """Gap to leader, interval to the car ahead and age of the reference, for every ranked car.

    Without a usable reference the numbers are null and the reference is empty.
    """
    car = F.posexplode("cars").alias("_index", "_car")
    listed = _reference_blocks(timing, order).select("*", car)
    at_us = F.col("_car.at_us")
    # In order, the car ahead is the previous one of the block, or the last of earlier blocks.
    ahead_us = F.when(
        F.col("_index") > 0, F.element_at("cars", F.col("_index"))["at_us"]
    ).otherwise(F.col("ahead_us"))
    at_reference = listed.select(
        "race_id",
        F.col("_car.car_id").alias("car_id"),
        F.concat_ws(":", F.col("lap").cast("string"), "checkpoint_id").alias("gap_reference"),
        "last_us",
        _to_ms(at_us - F.col("leader_us")).alias("gap_to_leader_ms"),
        _to_ms(at_us - ahead_us).alias("interval_to_ahead_ms"),
    )
    age = F.when(
        F.col("last_us").isNotNull(),
        F.greatest(F.lit(0).cast("bigint"), _to_ms(F.col("now_us") - F.col("last_us"))),
    )
    behind = F.greatest(F.lit(0), F.col("leader_laps") - F.col("laps_completed"))
    return (
        order.select("race_id", "car_id", "race_position", "laps_completed")
        .join(_field(order), "race_id")
        .join(at_reference, ["race_id", "car_id"], "left")
        .select(
            "race_id",
            "car_id",
            "race_position",
            "gap_to_leader_ms",
            "interval_to_ahead_ms",
            F.coalesce("gap_reference", F.lit("")).alias("gap_reference"),
            age.alias("gap_reference_age_ms"),
            behind.cast("bigint").alias("laps_behind"),
        )
    )


def laps_behind(order: DataFrame) -> DataFrame:
    """Laps each car is behind the leader of its race."""
    leader = order.groupBy("race_id").agg(
        F.min_by("laps_completed", "race_position").alias("leader_laps")
    )
    behind = F.greatest(F.lit(0), F.col("leader_laps") - F.col("laps_completed"))
    return order.join(leader, "race_id").select(
        "race_id", "car_id", "race_position", behind.cast("bigint").alias("laps_behind")
    )

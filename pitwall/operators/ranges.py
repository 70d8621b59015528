"""Order-dependent work on groups too large for one task.

A window over one race would send the whole race to one task.  Here the ordering column is cut
into fixed slices; what earlier slices contribute to a slice is a small aggregate table, and it
enters the slice as one *seed* row that sorts before all others.  The window then runs over
``keys + slice``, so a race is spread over as many tasks as it has slices, with one shuffle of
the rows, and the result equals that of the undivided window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

SLICE = "_slice"
IS_ROW = "_is_row"

# Default slice widths, in units of the ordering column.  A clock slice spans several laps, so the
# seed rows of a car are few beside its crossings; denser races may use narrower slices.
CLOCK_SLICE_US = 600_000_000
# Counting leaves one seed row per race and slice, so its slices can be narrow.
COUNT_SLICE_US = 10_000_000
SNAPSHOT_SLICE = 512
POSITION_SLICE = 512


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key.

    Spark limits each group to one row before the shuffle, so a key that holds a large part of
    the table sends only one row per map task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def tie_break(df: DataFrame) -> Column:
    """What decides between rows of one revision: the broker offset, else the row's content."""
    return F.col("kafka_offset") if "kafka_offset" in df.columns else F.xxhash64(*df.columns)


def keep_top(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows of each key, limited before the shuffle as in :func:`keep_first`."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def with_slice(df: DataFrame, column: str, width: int) -> DataFrame:
    """Add the slice number of every row."""
    return df.withColumn(SLICE, F.floor(F.col(column) / F.lit(width)).cast("bigint"))


def running_min(column: Column) -> Column:
    """Combine slice minima."""
    return F.min(column)


def running_max(column: Column) -> Column:
    """Combine slice maxima."""
    return F.max(column)


def running_sum(column: Column) -> Column:
    """Combine slice totals."""
    return F.sum(column)


def latest(column: Column) -> Column:
    """Combine slice values by the newest one known."""
    return F.last(column, ignorenulls=True)


def earliest(column: Column) -> Column:
    """Combine slice values by the oldest one known."""
    return F.first(column, ignorenulls=True)


def carried(
    sliced: DataFrame,
    keys: Sequence[str],
    parts: dict[str, tuple[Column, Callable[[Column], Column]]],
) -> DataFrame:
    """Seed rows: per key and slice, what all earlier slices contribute.

    ``parts`` maps a column of the rows to its aggregate within a slice and to the function that
    combines the values of consecutive slices.
    """
    totals = sliced.groupBy(*keys, SLICE).agg(
        *[aggregate.alias(name) for name, (aggregate, _) in parts.items()]
    )
    before = (
        Window.partitionBy(*keys)
        .orderBy(SLICE)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return totals.select(
        *keys,
        SLICE,
        *[combine(F.col(name)).over(before).alias(name) for name, (_, combine) in parts.items()],
    )


def with_seeds(sliced: DataFrame, *seeds: DataFrame) -> DataFrame:
    """Rows and seed rows in one set; seeds have ``_is_row = 0`` and sort first."""
    merged = sliced.withColumn(IS_ROW, F.lit(1))
    for seed in seeds:
        merged = merged.unionByName(seed.withColumn(IS_ROW, F.lit(0)), allowMissingColumns=True)
    return merged


def slice_window(keys: Sequence[str], order: Sequence[Column]) -> WindowSpec:
    """Ordered window within one slice, seeds first."""
    return Window.partitionBy(*keys, SLICE).orderBy(F.col(IS_ROW), *order)


def drop_seeds(df: DataFrame, *helpers: str) -> DataFrame:
    """Rows only, without helper columns."""
    return df.filter(F.col(IS_ROW) == 1).drop(IS_ROW, SLICE, *helpers)

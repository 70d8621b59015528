"""Frames assembled by set operations, with the state of live races in tables.

Each micro-batch is one job: Spark groups the samples to one row a frame, decides by windows over
those rows what becomes of every frame, and carries cars forward by windows over (race, car). No
race is collected in one Python task; what is ordered within a race is one row a frame.

The rules are those of a race that takes its snapshots in order of time. After each snapshot that
has new rows at most one frame is released: the snapshot itself if it is whole, else the newest
waiting frame that lags ``lag`` snapshots behind. A release drops older waiting frames, and of
those that wait at most the newest ``pending`` stay. From this follows, for each waiting frame f:

- it ends at the first later snapshot that is whole, or that is ``lag`` or more ahead;
- if that one is whole, f is superseded;
- else f is released as it is if no other frame lies between it and ``lag`` before that snapshot,
  and is superseded otherwise;
- it is crowded out earlier at the snapshot that makes ``pending`` newer frames wait.

State lies in two folders that are written in turn, so it stays as large as the live races: the
entrants, newest frame and counter of each race, the waiting frames, and the last word of each car.
The commit of a batch names its folder and comes last; a repeated batch starts from the state
before it and replaces its own output.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.operators.ranges import keep_first
from pitwall.sources.layers import read_layer
from pitwall.streaming.frames import CONFLICT, CROWDED, LATE, OUTPUT, SUPERSEDED

FRAMES = "frames"
COMMITS = "frame_commits"
STATE = "frame_state"
_SAMPLE = "struct<car_id: string, race_position: int, payload: string>"
RACES = """race_id string, entrants array<string>, last bigint, sequence bigint,
    touched_at timestamp"""
WAITING = f"race_id string, snapshot_id bigint, samples array<{_SAMPLE}>"
CARS = "race_id string, car_id string, race_position int, payload string"
COMMIT = "folder int, batch_id bigint"
FRAME = ["race_id", "snapshot_id"]


def _schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def is_whole(samples: Column, entrants: Column) -> Column:
    """True if the samples are those of the entrants, one each."""
    cars = F.transform(samples, lambda sample: sample["car_id"])
    return (
        (F.size(entrants) > 0)
        & (F.size(cars) == F.size(entrants))
        & (F.size(F.array_except(entrants, cars)) == 0)
    )


def is_ordered(samples: Column) -> Column:
    """True if the positions are 1 to n, each once."""
    places = F.array_sort(F.transform(samples, lambda sample: sample["race_position"]))
    return places == F.sequence(F.lit(1), F.size(samples))


def merged(before: Column, arrived: Column, entrants: Column) -> Column:
    """Samples of a frame after new ones came in, in order, and those that it refuses.

    A newer sample of a car replaces the one before. A sample that makes the frame whole but
    contradicts its positions is refused, so the frame stays open.
    """

    def take(state: Column, sample: Column) -> Column:
        others = F.filter(state["samples"], lambda old: old["car_id"] != sample["car_id"])
        frame = F.concat(others, F.array(sample))
        refuse = is_whole(frame, entrants) & ~is_ordered(frame)
        return F.struct(
            F.when(refuse, state["samples"]).otherwise(frame).alias("samples"),
            F.when(refuse, F.concat(state["refused"], F.array(sample)))
            .otherwise(state["refused"])
            .alias("refused"),
        )

    kind = f"array<{_SAMPLE}>"
    start = F.struct(before.cast(kind).alias("samples"), F.array().cast(kind).alias("refused"))
    return F.aggregate(arrived, start, take)


def outcomes(frames: DataFrame, lag: int, pending: int) -> DataFrame:
    """Adds ``outcome`` to frames: complete, partial, superseded, crowded or waits.

    Needs race_id, snapshot_id, ``whole``, ``touched`` (has new rows) and ``waited`` (was waiting
    before). Windows order one row a frame.
    """
    race = Window.partitionBy("race_id").orderBy("snapshot_id")
    later = race.rowsBetween(1, Window.unboundedFollowing)
    ahead = race.rangeBetween(lag, Window.unboundedFollowing)
    near = race.rowsBetween(1, 2 * pending)
    snapshot, touched = F.col("snapshot_id"), F.col("touched")
    # The snapshots at which frames newer than f come to wait; those that waited are there already.
    came = F.collect_list(F.when(~F.col("waited"), snapshot)).over(near)
    were = F.count_if("waited").over(near)
    need = F.lit(pending) - F.col("were")
    seen = (
        frames.withColumn("whole_at", F.min(F.when(F.col("whole"), snapshot)).over(later))
        .withColumn("ahead_at", F.min(F.when(touched, snapshot)).over(ahead))
        .withColumn("next_at", F.lead("snapshot_id").over(race))
        .withColumn("came", came)
        .withColumn("were", were)
        .withColumn("ends_at", F.least("whole_at", "ahead_at"))
        .withColumn(
            "crowded_at",
            F.when(need <= 0, snapshot).when(F.size("came") >= need, F.get("came", (need - 1).cast("int"))),
        )
    )
    crowded = F.col("crowded_at") < F.coalesce("ends_at", F.lit(2**62))
    outcome = (
        F.when(F.col("whole"), "complete")
        .when(crowded, "crowded")
        .when(F.col("ends_at").isNull(), "waits")
        .when(F.col("ends_at") == F.col("whole_at"), "superseded")
        .when(F.col("next_at") > F.col("ends_at") - lag, "partial")
        .otherwise("superseded")
    )
    return seen.withColumn("outcome", outcome).drop(
        "whole_at", "ahead_at", "next_at", "came", "were", "ends_at", "crowded_at"
    )


def closed(frames: DataFrame, closing: DataFrame) -> DataFrame:
    """Frames with the outcome of races that close: the newest that waits leaves as it is."""
    newest = Window.partitionBy("race_id").orderBy(
        F.col("waiting").desc(), F.col("snapshot_id").desc()
    )
    marked = frames.join(closing.select("race_id", F.lit(True).alias("closing")), "race_id", "left")
    ranked = marked.withColumn("waiting", F.col("outcome") == "waits").withColumn(
        "rank", F.row_number().over(newest)
    )
    over = F.col("waiting") & F.coalesce("closing", F.lit(False))
    outcome = F.when(over & (F.col("rank") == 1), "partial").when(over, "superseded")
    return ranked.withColumn("outcome", F.coalesce(outcome, "outcome")).drop(
        "closing", "waiting", "rank"
    )


def car_rows(released: DataFrame, cars: DataFrame) -> DataFrame:
    """A row for each car known by then of each released frame, with ``sequence``.

    ``cars`` are the last words of the races before. In a partial frame a car keeps its position;
    a car that is not in the frame is stale and shows its last word.
    """
    own = released.select(
        *FRAME, "complete", F.explode("samples").alias("sample")
    ).select(*FRAME, "sample.*", F.when(F.col("complete"), F.col("sample.race_position")).alias("settled"))
    known = own.select("race_id", "car_id").union(cars.select("race_id", "car_id")).distinct()
    grid = released.select(*FRAME, "complete", "sequence").join(known, "race_id")
    cells = grid.join(own, [*FRAME, "car_id"], "left").withColumn("seed", F.lit(False))
    seeds = cars.withColumn("settled", F.col("race_position")).withColumn("seed", F.lit(True))
    seeds = seeds.withColumn("snapshot_id", F.lit(-(2**62)))
    both = cells.unionByName(seeds, allowMissingColumns=True)
    so_far = (
        Window.partitionBy("race_id", "car_id")
        .orderBy("snapshot_id")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    settled = F.last("settled", ignorenulls=True).over(so_far)
    first = F.first("race_position", ignorenulls=True).over(so_far)
    return (
        both.withColumn("stale", F.col("payload").isNull())
        .withColumn("place", F.coalesce(settled, first))
        .withColumn("word", F.last("payload", ignorenulls=True).over(so_far))
        .filter(~F.col("seed") & F.col("word").isNotNull())
        .select(
            "race_id", F.col("sequence").alias("state_sequence"), "snapshot_id", "complete",
            "car_id", F.col("place").alias("race_position"), "stale",
            F.col("word").alias("payload"), F.lit(None).cast("string").alias("refused"),
        )
    )


def _refused(rows: DataFrame, reason: Column) -> DataFrame:
    """Rows with a frame and a ``sample`` as refused output rows."""
    return rows.select(
        "race_id", F.lit(None).cast("bigint").alias("state_sequence"), "snapshot_id",
        F.lit(False).alias("complete"), "sample.car_id", "sample.race_position",
        F.lit(False).alias("stale"), "sample.payload", reason.alias("refused"),
    )


class FrameTables:
    """State and output of the job under ``base``; ``sink`` is its ``foreachBatch`` function.

    A batch has the rows of :func:`pitwall.streaming.frames.frame_input`. Payloads are never null.
    ``clock`` tells the time of a batch: races whose frames have waited for ``idle_seconds``
    without any row are closed by the next batch, which may be empty.
    """

    def __init__(
        self, base: str, lag: int = 3, pending: int = 4, idle_seconds: float = 3.0,
        clock: Callable[[], datetime] = lambda: datetime.now(UTC),
    ) -> None:
        self.base, self.lag, self.pending = base, lag, pending
        self.idle_seconds, self.clock = idle_seconds, clock

    def read_frames(self, spark: SparkSession) -> DataFrame:
        """Output rows of the committed batches."""
        commits = self._commits(spark).select("batch_id")
        rows = read_layer(spark, f"{self.base}/{FRAMES}", _schema(f"{OUTPUT}, batch_id bigint"))
        return rows.join(commits, "batch_id", "left_semi")

    def read_state(self, spark: SparkSession, table: str, ddl: str) -> DataFrame:
        """A table of the newest committed state."""
        return self._state(spark, self._newest(spark, None), table, ddl)

    def _commits(self, spark: SparkSession) -> DataFrame:
        return read_layer(spark, f"{self.base}/{COMMITS}", _schema(COMMIT))

    def _newest(self, spark: SparkSession, before: int | None) -> int | None:
        commits = self._commits(spark)
        if before is not None:
            commits = commits.filter(F.col("batch_id") < before)
        row = commits.agg(F.max_by("folder", "batch_id")).first()
        return row[0]

    def _state(self, spark: SparkSession, folder: int | None, table: str, ddl: str) -> DataFrame:
        schema = _schema(ddl)
        if folder is None:
            return spark.createDataFrame([], schema)
        return read_layer(spark, f"{self.base}/{STATE}/{folder}/{table}", schema)

    def sink(self, batch: DataFrame, batch_id: int) -> None:
        """Take in one micro-batch: output rows, new state, commit."""
        spark = batch.sparkSession
        folder = self._newest(spark, batch_id)
        races, waiting, cars = (
            self._state(spark, folder, table, ddl)
            for table, ddl in (("races", RACES), ("waiting", WAITING), ("cars", CARS))
        )
        now = F.lit(self.clock()).cast("timestamp")
        target = 0 if folder is None else 1 - folder
        batch = batch.persist()
        try:
            alive = self._stored(self._races(batch, races, now), f"{STATE}/{target}/known")
            first, waiting = self._fitting(batch, alive, waiting)
            judged = self._frames(batch, alive, first, waiting)
            frames = closed(outcomes(judged, self.lag, self.pending), self._closing(batch, alive))
            frames = frames.drop("entrants").unionByName(first)
            # Stored, so that what follows plans and runs on one short table.
            frames = self._stored(frames, f"{STATE}/{target}/judged")
            sequence = F.row_number().over(Window.partitionBy("race_id").orderBy("snapshot_id"))
            released = (
                frames.filter(F.col("outcome").isin("complete", "partial"))
                .withColumn("complete", F.col("outcome") == "complete")
                .withColumn("nth", sequence)
                .join(alive.select("race_id", F.col("sequence").alias("before")), "race_id")
                .withColumn("sequence", F.col("before") + F.col("nth"))
            )
            refused = self._refusals(batch, alive, first, frames)
            out = self._stored(
                car_rows(released, cars).unionByName(refused), f"{FRAMES}/batch_id={batch_id}"
            )
            self._save(target, batch, alive, frames, out.filter("refused IS NULL"), cars)
            commit = spark.createDataFrame([(target,)], "folder int")
            self._write(commit.coalesce(1), f"{COMMITS}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    def _stored(self, frame: DataFrame, table: str) -> DataFrame:
        self._write(frame, table)
        return frame.sparkSession.read.schema(frame.schema).parquet(f"{self.base}/{table}")

    def _write(self, frame: DataFrame, table: str) -> None:
        frame.write.mode("overwrite").parquet(f"{self.base}/{table}")

    def _races(self, batch: DataFrame, races: DataFrame, now: Column) -> DataFrame:
        """Known and new races; the newest list of entrants that is not empty counts."""
        named = batch.filter((F.col("kind") == "control") & (F.size("participants") > 0))
        entered = named.groupBy("race_id").agg(
            F.array_sort(F.array_distinct(F.max_by("participants", "snapshot_id"))).alias("named")
        )
        here = batch.select("race_id").distinct().withColumn("here", F.lit(True))
        both = races.join(here, "race_id", "full").join(entered, "race_id", "left")
        return both.select(
            "race_id",
            F.coalesce("named", "entrants", F.array().cast("array<string>")).alias("entrants"),
            F.coalesce("last", F.lit(-1).cast("bigint")).alias("last"),
            F.coalesce("sequence", F.lit(0).cast("bigint")).alias("sequence"),
            F.when(F.col("here"), now).otherwise(F.col("touched_at")).alias("touched_at"),
            F.coalesce("here", F.lit(False)).alias("here"),
            (F.unix_micros(now) - F.unix_micros("touched_at")).alias("idle_us"),
        )

    def _fitting(
        self, batch: DataFrame, alive: DataFrame, waiting: DataFrame
    ) -> tuple[DataFrame, DataFrame]:
        """Frames that new entrants settle, with their outcome, and those that still wait."""
        controlled = batch.filter(F.col("kind") == "control").select("race_id").distinct()
        entered = alive.join(controlled, "race_id", "left_semi").select("race_id", "entrants")
        checked = waiting.join(entered, "race_id").withColumn(
            "fit", is_whole(F.col("samples"), F.col("entrants")) & is_ordered(F.col("samples"))
        )
        newest = checked.filter("fit").groupBy("race_id").agg(F.max("snapshot_id").alias("fit_at"))
        placed = waiting.join(newest, "race_id", "left")
        settled = placed.filter(F.col("snapshot_id") <= F.col("fit_at")).select(
            *FRAME, "samples",
            F.when(F.col("snapshot_id") == F.col("fit_at"), "complete")
            .otherwise("superseded")
            .alias("outcome"),
        )
        left = placed.filter(F.col("fit_at").isNull() | (F.col("snapshot_id") > F.col("fit_at")))
        return self._shaped(settled), left.drop("fit_at")

    @staticmethod
    def _shaped(frames: DataFrame) -> DataFrame:
        kind = f"array<{_SAMPLE}>"
        return frames.select(
            *FRAME, "samples", F.array().cast(kind).alias("conflicts"),
            F.lit(True).alias("waited"), F.lit(False).alias("touched"),
            (F.col("outcome") == "complete").alias("whole"), "outcome",
        )

    @staticmethod
    def _passed(alive: DataFrame, first: DataFrame) -> DataFrame:
        """Newest released frame of each race once its entrants have taken effect."""
        settled = first.filter("whole").groupBy("race_id").agg(F.max("snapshot_id").alias("fit_at"))
        return alive.join(settled, "race_id", "left").select(
            "race_id", "entrants", F.greatest("last", "fit_at").alias("last")
        )

    def _samples(self, batch: DataFrame, alive: DataFrame, first: DataFrame) -> DataFrame:
        """New samples with the entrants and the newest released frame of their race."""
        sample = F.struct("car_id", "race_position", "payload").cast(_SAMPLE)
        rows = batch.filter(F.col("kind") == "telemetry").select(*FRAME, sample.alias("sample"))
        return rows.join(self._passed(alive, first), "race_id")

    def _frames(
        self, batch: DataFrame, alive: DataFrame, first: DataFrame, waiting: DataFrame
    ) -> DataFrame:
        """One row a frame: what waited and what came, merged."""
        arrived = (
            self._samples(batch, alive, first)
            .filter(F.col("snapshot_id") > F.col("last"))
            .groupBy(*FRAME)
            .agg(F.array_sort(F.collect_list("sample")).alias("arrived"))
        )
        both = waiting.join(arrived, FRAME, "full").join(alive.select("race_id", "entrants"), "race_id")
        nothing = F.array().cast(f"array<{_SAMPLE}>")
        state = merged(
            F.coalesce("samples", nothing), F.coalesce("arrived", nothing), F.col("entrants")
        )
        frames = both.select(
            *FRAME, state.alias("state"), F.col("samples").isNotNull().alias("waited"),
            F.col("arrived").isNotNull().alias("touched"), "entrants",
        ).select(
            *FRAME, "state.samples", F.col("state.refused").alias("conflicts"), "waited", "touched",
            (F.col("touched") & is_whole(F.col("state.samples"), F.col("entrants"))).alias("whole"),
            "entrants",
        )
        return frames

    def _closing(self, batch: DataFrame, alive: DataFrame) -> DataFrame:
        """Races that end with this batch, or have been idle for too long."""
        ended = batch.filter(F.col("kind") == "end").select("race_id")
        idle = alive.filter(~F.col("here") & (F.col("idle_us") >= self.idle_seconds * 1_000_000))
        return ended.union(idle.select("race_id")).distinct()

    def _refusals(
        self, batch: DataFrame, alive: DataFrame, first: DataFrame, frames: DataFrame
    ) -> DataFrame:
        late = self._samples(batch, alive, first).filter(F.col("snapshot_id") <= F.col("last"))
        dropped = frames.filter(F.col("outcome").isin("superseded", "crowded")).select(
            *FRAME, "outcome", F.explode("samples").alias("sample")
        )
        contradicting = frames.select(*FRAME, F.explode("conflicts").alias("sample"))
        reason = F.when(F.col("outcome") == "crowded", CROWDED).otherwise(SUPERSEDED)
        return (
            _refused(late, F.lit(LATE))
            .unionByName(_refused(dropped, reason))
            .unionByName(_refused(contradicting, F.lit(CONFLICT)))
        )

    def _save(
        self, folder: int, batch: DataFrame, alive: DataFrame, frames: DataFrame,
        rows: DataFrame, cars: DataFrame,
    ) -> None:
        """State after the batch: races that have not ended, their waiting frames and cars."""
        ended = batch.filter(F.col("kind") == "end").select("race_id").distinct()
        released = (
            frames.filter(F.col("outcome").isin("complete", "partial"))
            .groupBy("race_id")
            .agg(F.max("snapshot_id").alias("newest"), F.count("*").alias("n"))
        )
        races = alive.join(released, "race_id", "left").select(
            "race_id", "entrants", F.greatest("last", "newest").alias("last"),
            (F.col("sequence") + F.coalesce("n", F.lit(0))).alias("sequence"), "touched_at",
        )
        waiting = frames.filter(F.col("outcome") == "waits").select(*FRAME, "samples")
        told = rows.select("race_id", "car_id", "race_position", "payload", "snapshot_id")
        old = cars.withColumn("snapshot_id", F.lit(-(2**62)))
        newest = keep_first(
            told.unionByName(old), ["race_id", "car_id"], [F.col("snapshot_id").desc()]
        ).drop("snapshot_id")
        for table, frame in (("races", races), ("waiting", waiting), ("cars", newest)):
            live = frame.join(ended, "race_id", "left_anti")
            self._write(live, f"{STATE}/{folder}/{table}")

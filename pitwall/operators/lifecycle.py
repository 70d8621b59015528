"""Race lifecycle, outbox, retention and session views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitwall.operators.ranges import keep_first, tie_break

CAR = ["race_id", "car_id"]
# States in which a race is over, limits of one retention run, blank payload.
ENDED = ("finished", "stopped", "failed")
SHORTEST_RETENTION_DAYS = 8
LARGEST_RETENTION_BATCH = 100_000
BLANK = "{}"


def race_status(control: DataFrame) -> DataFrame:
    """Latest status per race, and whether any control event finished it."""
    return control.groupBy("race_id").agg(
        F.max_by("status", "source_sequence").alias("status"),
        F.bool_or(F.col("status") == "finished").alias("finished"),
    )


def pending_races(control: DataFrame, gold: DataFrame) -> DataFrame:
    """Finished races that have no gold summary yet."""
    finished = control.filter(F.col("status") == "finished").select("race_id").distinct()
    return finished.join(gold.select("race_id"), "race_id", "left_anti")


def latest_race(races: DataFrame) -> DataFrame:
    """The most recently started race."""
    return races.orderBy(F.col("started_at").desc(), F.col("race_id").desc()).limit(1)


def outbox_pending(outbox: DataFrame, delivered: DataFrame, limit: int = 300) -> DataFrame:
    """Oldest derived events that have not been delivered, at most ``limit``."""
    waiting = outbox.join(delivered.select("id"), "id", "left_anti")
    return waiting.orderBy("id", "event_id").limit(limit)


def retention_candidates(
    events: DataFrame,
    races: DataFrame,
    outbox: DataFrame,
    now: Column,
    days: int = 30,
    limit: int = 10_000,
) -> DataFrame:
    """Old payloads of ended races that are not the latest and have nothing to publish."""
    if days < SHORTEST_RETENTION_DAYS or not 1 <= limit <= LARGEST_RETENTION_BATCH:
        raise ValueError("retention needs at least 8 days and a batch of 1 to 100000 rows")
    cutoff = now - F.expr(f"INTERVAL {int(days)} DAYS")
    eligible = (
        races.filter(F.col("status").isin(*ENDED) & (F.col("finished_at") < cutoff))
        .join(latest_race(races).select("race_id"), "race_id", "left_anti")
        .join(outbox.select("race_id").distinct(), "race_id", "left_anti")
    )
    old = events.filter((F.col("received_at") < cutoff) & (F.col("payload") != BLANK))
    return (
        old.join(eligible.select("race_id"), "race_id", "left_semi")
        .orderBy("received_at", "event_id")
        .limit(limit)
    )


def retention_apply(events: DataFrame, candidates: DataFrame) -> DataFrame:
    """All events, with the payload of the candidates blanked and every id kept."""
    marked = candidates.select("event_id").distinct().withColumn("_expired", F.lit(True))
    blanked = F.when(F.col("_expired"), F.lit(BLANK)).otherwise(F.col("payload"))
    return (
        events.join(marked, "event_id", "left").withColumn("payload", blanked).drop("_expired")
    )


def race_results_upsert(old: DataFrame, new: DataFrame) -> DataFrame:
    """Results per race and car; a newer run replaces the row of the same key."""
    versions = old.withColumn("_version", F.lit(0)).unionByName(new.withColumn("_version", F.lit(1)))
    return keep_first(versions, CAR, [F.col("_version").desc()]).drop("_version")


def available_cars_at_lap(cars: DataFrame, plan: DataFrame, lap: int) -> DataFrame:
    """Cars that no planned collision takes out at or before a lap."""
    out = (
        plan.filter((F.col("incident_type") == "collision") & (F.col("lap") <= lap))
        .select("race_id", F.explode(F.array("car_id", "second_car_id")).alias("car_id"))
        .distinct()
    )
    return cars.join(out, CAR, "left_anti")


def _latest(df: DataFrame, sequence: str, name: str) -> DataFrame:
    fields = [column for column in df.columns if column != "race_id"]
    order = F.struct(F.col(sequence), tie_break(df))
    return df.groupBy("race_id").agg(F.max_by(F.struct(*fields), order).alias(name))


def session_snapshot(
    state: DataFrame,
    analytics: DataFrame,
    control: DataFrame,
) -> DataFrame:
    """One row per race: newest state, newest analytics and newest control event.

    Participants come from the newest control event that lists any, when control carries them.
    """
    parts = [
        _latest(state, "state_sequence", "state"),
        _latest(analytics, "revision", "analytics"),
        _latest(control, "source_sequence", "control"),
    ]
    if "participants" in control.columns:
        listed = control.filter(F.size("participants") > 0)
        parts.append(
            listed.groupBy("race_id").agg(
                F.max_by("participants", "source_sequence").alias("participants")
            )
        )
    snapshot = parts[0]
    for part in parts[1:]:
        snapshot = snapshot.join(part, "race_id", "full")
    return snapshot


def coalesced_analytics(batch: DataFrame) -> DataFrame:
    """Only the newest analytics event of each race in a batch."""
    return keep_first(batch, ["race_id"], [F.col("revision").desc(), F.col("event_id")])


def latest_wins_view(events: DataFrame, sequence: str = "state_sequence") -> DataFrame:
    """View in which an event older than the last seen sequence changes nothing."""
    return keep_first(events, ["race_id"], [F.col(sequence).desc(), tie_break(events).desc()])


def car_dimension_join(facts: DataFrame, cars: DataFrame) -> DataFrame:
    """Driver, team and country on facts; Spark broadcasts the cars while they are small."""
    known = cars.select("car_id", "driver_name", F.col("team_id").alias("car_team_id"),
                        "driver_country_code")
    return facts.join(known, "car_id", "left")


def penalty_totals(incidents: DataFrame) -> DataFrame:
    """Applied penalty seconds per race and car."""
    applied = incidents.filter(F.col("penalty_status") == "applied")
    return applied.groupBy(*CAR).agg(
        F.sum("penalty_seconds").cast("bigint").alias("penalty_seconds")
    )


def stream_throughput(
    envelopes: DataFrame,
    is_error: Column,
    slide_seconds: int = 30,
    slides_per_window: int = 4,
) -> DataFrame:
    """Event and error rate per second over sliding windows of each topic.

    Records are first counted per slide; the windows are built from those few counts, so a
    record is shuffled once and not once per window it belongs to.
    """
    slot = F.window("kafka_timestamp", f"{slide_seconds} seconds")["start"]
    counts = envelopes.groupBy("topic", slot.alias("slot")).agg(
        F.count("*").alias("events"), F.count_if(is_error).alias("errors")
    )
    back = F.transform(
        F.sequence(F.lit(0), F.lit(slides_per_window - 1)),
        lambda i: F.col("slot") - F.make_dt_interval(secs=i * slide_seconds),
    )
    seconds = slide_seconds * slides_per_window
    return (
        counts.select("topic", F.explode(back).alias("window_start"), "events", "errors")
        .groupBy("topic", "window_start")
        .agg(
            F.sum("events").cast("bigint").alias("events"),
            (F.sum("events") / seconds).alias("event_rate"),
            (F.sum("errors") / seconds).alias("error_rate"),
        )
    )


def outbox_backlog(
    outbox: DataFrame, delivered: DataFrame, slide_seconds: int = 30
) -> DataFrame:
    """Events that wait for delivery at the end of each slide: ``slot, queued, sent, backlog``.

    ``outbox`` has ``id`` and ``queued_at``, ``delivered`` has ``id`` and ``delivered_at``; an event
    that never left stays in the backlog. Slides without a change are left out. Events are counted
    per slide and per day first: the running total is taken within each day, from what the days
    before have left.
    """

    def per_slide(rows: DataFrame, moment: str, name: str, other: str) -> DataFrame:
        slot = F.window(moment, f"{slide_seconds} seconds")["start"].alias("slot")
        return rows.groupBy(slot).agg(
            F.count("*").alias(name), F.lit(0).cast("bigint").alias(other)
        )

    known = delivered.join(outbox.select("id"), "id", "left_semi")
    moved = per_slide(outbox, "queued_at", "queued", "sent").unionByName(
        per_slide(known, "delivered_at", "sent", "queued")
    )
    slides = moved.groupBy("slot").agg(F.sum("queued").alias("queued"), F.sum("sent").alias("sent"))
    change = F.col("queued") - F.col("sent")
    dated = slides.withColumn("_day", F.to_date("slot"))
    # One row for each day: the only total that is taken in one task.
    before = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    left = (
        dated.groupBy("_day")
        .agg(F.sum(change).alias("_change"))
        .select("_day", F.coalesce(F.sum("_change").over(before), F.lit(0)).alias("_left"))
    )
    until = Window.partitionBy("_day").orderBy("slot")
    return (
        dated.join(left, "_day")
        .withColumn("backlog", F.col("_left") + F.sum(change).over(until))
        .drop("_day", "_left")
    )

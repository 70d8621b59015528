"""Presentation strings built from JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Unicode regional indicators A..Z, the building blocks of a flag emoji.
INDICATORS = "".join(chr(0x1F1E6 + offset) for offset in range(26))

# Podium medals, trophy and texts shown for a missing time.
MEDALS = {1: "ouro", 2: "prata", 3: "bronze"}
TROPHY = "🏆"
NO_GAP = "--:--.---"
NO_TIME = "—"


def country_flag(code: Column) -> Column:
    """Flag emoji of a two-letter country code; empty text for anything else."""
    flag = F.translate(F.upper(code), LETTERS, INDICATORS)
    return F.when(code.rlike("^[A-Za-z]{2}$"), flag).otherwise(F.lit(""))


def _clock(ms: Column) -> Column:
    """``m:ss.mmm`` of a whole number of milliseconds."""
    minutes = F.floor(ms / 60000).cast("string")
    seconds = F.lpad(F.floor(ms % 60000 / 1000).cast("string"), 2, "0")
    millis = (ms % 1000).cast("string")
    # lpad would cut a longer text, and a rounded part may read 1000.
    millis = F.when(F.length(millis) < 3, F.lpad(millis, 3, "0")).otherwise(millis)
    return F.concat(minutes, F.lit(":"), seconds, F.lit("."), millis)


def format_gap(ms: Column) -> Column:
    """``+m:ss.mmm``, or a placeholder for a missing gap."""
    text = F.concat(F.lit("+"), _clock(ms.cast("bigint")))
    return F.when(ms.isNull(), F.lit(NO_GAP)).otherwise(text)


def format_lap_time(ms: Column) -> Column:
    """``m:ss.mmm`` of a lap time that may be fractional, or a dash."""
    number = ms.cast("double")
    usable = ms.isNotNull() & ~F.isnan(number) & (F.abs(number) < F.lit(float("inf")))
    safe = F.when(usable, number)
    minutes = F.floor(safe / 60000).cast("string")
    seconds = F.lpad(F.floor(safe % 60000 / 1000).cast("string"), 2, "0")
    millis = F.floor(safe % 1000 + 0.5).cast("string")
    millis = F.when(F.length(millis) < 3, F.lpad(millis, 3, "0")).otherwise(millis)
    text = F.concat(minutes, F.lit(":"), seconds, F.lit("."), millis)
    return F.coalesce(text, F.lit(NO_TIME))


def team_label(team_id: Column) -> Column:
    """``TEAM-A-03`` as ``Equipe A3``; other identifiers stay as they are."""
    return F.regexp_replace(team_id, r"^TEAM-([ABC])-0*(\d+)$", "Equipe $1$2")


def medal(position: Column) -> Column:
    """Medal of the first three positions, null behind them."""
    choice = F.lit(None).cast("string")
    for place, name in MEDALS.items():
        choice = F.when(position == place, F.lit(name)).otherwise(choice)
    return choice


def trophy(position: Column) -> Column:
    """Trophy for a podium position, null behind it."""
    return F.when(position <= 3, F.lit(TROPHY))


def split_color(valid: Column, time: Column, personal: Column, race: Column) -> Column:
    """Colour of a split against final bests: equal to a best counts as that best."""
    return (
        F.when(~valid, F.lit("gray"))
        .when(time <= race, F.lit("purple"))
        .when(time <= personal, F.lit("green"))
        .otherwise(F.lit("yellow"))
    )

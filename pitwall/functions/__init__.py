"""Column expressions: every function takes and returns Spark columns."""

from pitwall.functions.text import (
    country_flag,
    format_gap,
    format_lap_time,
    medal,
    split_color,
    team_label,
    trophy,
)
from pitwall.functions.track import (
    INTERLAGOS,
    corner_radius_at,
    corner_speed_limit,
    grip_lookup,
    track_column,
    track_lines,
)
from pitwall.functions.vehicle import event_date, lap_time_estimate, telemetry_features

__all__ = [
    "INTERLAGOS",
    "corner_radius_at",
    "corner_speed_limit",
    "country_flag",
    "event_date",
    "format_gap",
    "format_lap_time",
    "grip_lookup",
    "lap_time_estimate",
    "medal",
    "split_color",
    "team_label",
    "telemetry_features",
    "track_column",
    "track_lines",
    "trophy",
]

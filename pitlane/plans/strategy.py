"""Strategy-chart data G1-G4 (the drawing itself is left to the consumer).

The reference chart reads stint bounds from ``stint_summary``, which has
none; here they are derived from the laps per (full_name, session_id,
stint_id, compound), the same groups as VA6, over Race laps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.functions.cleanse import chart_subtitle, chart_title, compound_colour, lap_label
from pitlane.operators.filters import ended_before, for_session
from pitlane.operators.joins import join_dim
from pitlane.plans.views import ordered
from pitlane.operators.star_agg import Measure, star_aggregate
from pitlane.operators.ranking import driver_row


def stint_bounds(laps, drivers, sessions, session_id=None, session_type="Race") -> DataFrame:
    """Per (session, name, stint, compound): first and last lap number."""
    return star_aggregate(
        for_session(laps, session_id), drivers, sessions, session_type,
        ["full_name", "session_id", "stint_id", "compound"],
        [Measure("stint_start_lap", "min", "lap_number"), Measure("stint_end_lap", "max", "lap_number")],
    )


# L2: the chart query's order (full_name, stint_start_lap), within a session.
BARS_ORDER = ["session_id", "full_name", "stint_start_lap"]


def ordered_bars(laps, drivers, sessions, session_id=None) -> DataFrame:
    """L2: the chart's bars in drawing order."""
    return ordered(strategy_bars(laps, drivers, sessions, session_id), BARS_ORDER)


def strategy_bars(laps, drivers, sessions, session_id=None) -> DataFrame:
    """G1: one bar per stint: driver row (W5), start lap, width, colour (C14)."""
    bars = driver_row(stint_bounds(laps, drivers, sessions, session_id))
    return bars.select(
        "session_id", "full_name", "driver_row", "compound", "stint_id", "stint_start_lap",
        (F.col("stint_end_lap") - F.col("stint_start_lap")).alias("width"),
        compound_colour("compound").alias("colour"),
    )


def _with_total(bounds: DataFrame, sessions: DataFrame) -> DataFrame:
    return join_dim(bounds, sessions.select("session_id", "total_laps"), "session_id")


def strategy_pit_markers(laps, drivers, sessions, session_id=None) -> DataFrame:
    """A marker at every stint end before the final lap (F11); a retirement counts."""
    bounds = driver_row(stint_bounds(laps, drivers, sessions, session_id))
    return ended_before(_with_total(bounds, sessions)).select(
        "session_id", "full_name", "driver_row", "stint_id", F.col("stint_end_lap").alias("pit_lap")
    )


def strategy_total_pitstops(laps, drivers, sessions, session_id=None) -> DataFrame:
    """Per session with stints, the number of stints ending before the final lap (0 if none)."""
    bounds = _with_total(stint_bounds(laps, drivers, sessions, session_id), sessions)
    return bounds.groupBy("session_id").agg(
        F.count(F.when(F.col("stint_end_lap") < F.col("total_laps"), 1)).alias("total_pitstops")
    )


def strategy_header(sessions, session_id=None) -> DataFrame:
    """Session header and labels (title, subtitle, final-lap label)."""
    return for_session(sessions, session_id).select(
        "session_id", "track", "year", "session_type", "total_laps",
        chart_title("track").alias("title"),
        chart_subtitle("year", "session_type").alias("subtitle"),
        lap_label("total_laps").alias("final_lap_label"),
    )

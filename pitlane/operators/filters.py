"""Row filters F1-F12. Each takes and returns a DataFrame; all are plain
predicates, so Catalyst pushes them into the parquet scan where the column
is stored, or into the broadcast dimension they touch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def race_only(df: DataFrame, session_type: str = "Race") -> DataFrame:
    """exact (binary) match on the session type."""
    return df.where(F.col("session_type") == F.lit(session_type))


def timed(df: DataFrame) -> DataFrame:
    """laps with a lap time."""
    return df.where(F.col("lap_time_ms").isNotNull())


def in_stint(df: DataFrame) -> DataFrame:
    """laps with a stint number."""
    return df.where(F.col("stint_id").isNotNull())


def with_gap(df: DataFrame) -> DataFrame:
    """laps with a gap to the leader."""
    return df.where(F.col("gap_to_leader_ms").isNotNull())


def for_session(df: DataFrame, session_id: int | None) -> DataFrame:
    """one session, or all sessions when ``session_id`` is None."""
    return df if session_id is None else df.where(F.col("session_id") == F.lit(session_id))


def past_events(schedule: DataFrame, today) -> DataFrame:
    """events dated on or before ``today`` (a date; injected, not read from the clock)."""
    return schedule.where(F.to_date("event_date") <= F.lit(today).cast("date"))


def pit_in_laps(raw_laps: DataFrame) -> DataFrame:
    """raw laps on which the car entered the pit lane."""
    return raw_laps.where(F.col("pit_in_us").isNotNull())


def _not_blank(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit(""))) != ""


def with_code(df: DataFrame, col: str = "driver_code") -> DataFrame:
    """F8: drop rows whose driver code is blank."""
    return df.where(_not_blank(F.col(col)))


def with_team(df: DataFrame, col: str = "team_name") -> DataFrame:
    """drop rows whose team name is blank."""
    return df.where(_not_blank(F.col(col)))


def ended_before(df: DataFrame, end_col: str = "stint_end_lap", total_col: str = "total_laps") -> DataFrame:
    """stints that ended before the last lap of the race."""
    return df.where(F.col(end_col) < F.col(total_col))

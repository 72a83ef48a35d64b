"""Explicit schemas for the warehouse and the landing zone.

Durations land as integer microseconds (BIGINT): parquet keeps them exact,
every engine reads them as plain integers, and ms conversion is integer
arithmetic instead of float seconds.
"""

from __future__ import annotations

from pyspark.sql import types as T

I, L, S, D = T.IntegerType(), T.LongType(), T.StringType(), T.DoubleType()


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# ---- warehouse ------------------------------------------------------------

SESSIONS = _struct(
    ("session_id", I, False),
    ("year", I, False),
    ("track", S, False),
    ("session_type", S, False),
    ("total_laps", I, True),
    ("weather", S, True),
    ("safety_car_count", I, True),
)

DRIVERS = _struct(
    ("driver_id", I, False),
    ("driver_code", S, False),
    ("full_name", S, False),
    ("team", S, True),
)

LAP_KEY = ["session_id", "driver_id", "lap_number"]
LAP_MEASURES = [
    "stint_id", "compound", "lap_time_ms", "sector1_ms", "sector2_ms", "sector3_ms",
    "position", "gap_to_leader_ms", "interval_to_next_ms",
]

LAPS = _struct(
    ("session_id", I, False),
    ("driver_id", I, False),
    ("lap_number", I, True),
    ("stint_id", I, True),
    ("compound", S, True),
    ("lap_time_ms", I, True),
    ("sector1_ms", I, True),
    ("sector2_ms", I, True),
    ("sector3_ms", I, True),
    ("position", I, True),
    ("gap_to_leader_ms", I, True),
    ("interval_to_next_ms", I, True),
)

TEAMS = _struct(("team_name", S, False))

PITSTOP_KEY = ["session_id", "driver_id", "lap_number"]
PITSTOPS = _struct(
    ("session_id", I, False),
    ("driver_id", I, False),
    ("lap_number", I, True),
    ("compound_in", S, True),
    ("compound_out", S, True),
    ("stop_time_ms", L, True),
)

# ---- landing zone ---------------------------------------------------------

RAW_LAPS = _struct(
    ("session_id", I, False),
    ("seq", L, True),  # place in the source frame, which the reference's order rests on
    ("driver", S, True),
    ("lap_number", D, True),
    ("stint", D, True),
    ("compound", S, True),
    ("lap_time_us", L, True),
    ("sector1_us", L, True),
    ("sector2_us", L, True),
    ("sector3_us", L, True),
    ("position", D, True),
    ("gap_to_leader_us", L, True),
    ("interval_to_ahead_us", L, True),
    ("pit_in_us", L, True),
    ("pit_out_us", L, True),
)

RAW_RESULTS = _struct(
    ("session_id", I, False),
    ("abbreviation", S, True),
    ("full_name", S, True),
    ("team_name", S, True),
    ("team", S, True),
)

SCHEDULE = _struct(
    ("year", I, False),
    ("event_name", S, True),
    ("event_date", T.TimestampNTZType(), True),
)

# Weather samples: milliseconds on the session's clock, and which sample of a time is the later.
WEATHER = _struct(
    ("session_id", I, True),
    ("at_ms", L, True),
    ("sample", L, True),
    ("track_temp", D, True),
    ("rainfall", T.BooleanType(), True),
    ("wind", I, True),
)

# Laps as they land: the session by its natural key, ids unknown.
LANDED_LAPS = T.StructType([
    T.StructField("year", I, False),
    T.StructField("event_name", S, True),
    T.StructField("official_event_name", S, True),
    T.StructField("session_name", S, False),
    *RAW_LAPS.fields[1:],
])

WAREHOUSE = {
    "sessions": SESSIONS,
    "drivers": DRIVERS,
    "laps": LAPS,
    "teams": TEAMS,
    "pitstops": PITSTOPS,
}

LANDING = {"raw_laps": RAW_LAPS, "landed_laps": LANDED_LAPS, "raw_results": RAW_RESULTS, "schedule": SCHEDULE, "weather": WEATHER}

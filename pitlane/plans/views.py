"""Analytics views, both families.

Family A (VA1-VA7) groups by ``full_name, session_id`` and is unrounded.
Family B (VB1-VB8, the ``v_*`` views) groups by
``year, track, session_type, driver`` and rounds means to two places.
They are different queries that share a topic; each keeps its own null
filters (SURVEY §2.10-2.11).

Every grouped view is a ``star_aggregate``: with both dimensions broadcast
behind a byte bound, the fact is read once, filtered and joined in
its scan stage, and shuffled only by the aggregate after map-side partial
aggregation; with a drivers table too big to broadcast, the laps are
aggregated per (session, driver) before the join instead of shuffling
every lap to it. Arg-min views (VB5, VB8) join an aggregate back, on the
laps alone: names are joined to the rows that remain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.operators.filters import in_stint, race_only, timed, with_gap
from pitlane.operators.joins import BROADCAST_MAX_BYTES, join_dim, small_side
from pitlane.operators.ranking import arg_min
from pitlane.operators.star_agg import Measure, star_aggregate

SESSION_KEYS = ["year", "track", "session_type"]


def _driver(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("full_name", "driver")


# ---- family A ---------------------------------------------------------------

M = Measure


def _agg(laps, drivers, sessions, session_type, keys, measures, lap_filter=None, max_dim_bytes=BROADCAST_MAX_BYTES):
    return star_aggregate(laps, drivers, sessions, session_type, keys, measures, lap_filter, max_dim_bytes)


def avg_gap_to_leader(laps, drivers, sessions, session_type="Race", max_dim_bytes=BROADCAST_MAX_BYTES) -> DataFrame:
    """VA1."""
    return _agg(laps, drivers, sessions, session_type, ["full_name", "session_id"],
                [M("avg_gap_ms", "avg", "gap_to_leader_ms")], with_gap, max_dim_bytes)


def best_laps(laps, drivers, sessions, session_type="Race", max_dim_bytes=BROADCAST_MAX_BYTES) -> DataFrame:
    """VA2: no null filter, so a driver without a timed lap gets a NULL row."""
    return _agg(laps, drivers, sessions, session_type, ["full_name", "session_id"],
                [M("best_lap_ms", "min", "lap_time_ms")], None, max_dim_bytes)


def driver_avg_by_compound(laps, drivers, sessions, session_type="Race", max_dim_bytes=BROADCAST_MAX_BYTES) -> DataFrame:
    """VA3: a NULL compound is its own group."""
    return _agg(laps, drivers, sessions, session_type, ["full_name", "session_id", "compound"],
                [M("avg_lap_time_ms", "avg", "lap_time_ms")], None, max_dim_bytes)


def driver_avg_laptime(laps, drivers, sessions, session_type="Race", max_dim_bytes=BROADCAST_MAX_BYTES) -> DataFrame:
    """VA4 (flagship): mean lap time per driver name and session."""
    return _agg(laps, drivers, sessions, session_type, ["full_name", "session_id"],
                [M("avg_lap_time_ms", "avg", "lap_time_ms")], None, max_dim_bytes)


def session_summary(laps, sessions, session_type="Race") -> DataFrame:
    """VA5: sessions LEFT JOIN laps, counted per session.

    Laps are aggregated per session first (count distinct runs as partial
    aggregation over (session, driver) pairs), then the small per-session
    result is joined to the session dimension. This equals the left join of
    the raw tables: a session without laps keeps its null-extended row, so
    ``count(*)`` is 1 and ``count(distinct driver_id)`` is 0 (kept as in
    the reference).
    """
    s = sessions.select("session_id", "year", "track", "session_type")
    if session_type is not None:
        s = race_only(s, session_type)
    s = small_side(s)
    per = laps.join(s.select("session_id"), "session_id", "left_semi").groupBy("session_id").agg(
        F.count_distinct("driver_id").alias("_drivers"), F.count(F.lit(1)).alias("_laps")
    )
    return s.join(per, "session_id", "left").select(
        "session_id", "year", "track",
        F.coalesce("_drivers", F.lit(0)).cast("long").alias("drivers_count"),
        F.coalesce("_laps", F.lit(1)).cast("long").alias("total_laps"),
    )


def stint_summary(laps, drivers, sessions, session_type="Race", max_dim_bytes=BROADCAST_MAX_BYTES) -> DataFrame:
    """VA6: NULL stint kept; ``count(*)`` includes untimed laps."""
    return _agg(laps, drivers, sessions, session_type, ["full_name", "session_id", "stint_id", "compound"],
                [M("laps_in_stint", "rows"), M("avg_stint_lap_ms", "avg", "lap_time_ms")], None, max_dim_bytes)


def tyre_degradation(laps, drivers, sessions, session_type="Race", max_dim_bytes=BROADCAST_MAX_BYTES) -> DataFrame:
    """VA7: range over range (A8), not a regression slope; NULL for one-lap stints."""
    keys = ["full_name", "session_id", "stint_id", "compound"]
    g = _agg(laps, drivers, sessions, session_type, keys,
             [M("_y_hi", "max", "lap_time_ms"), M("_y_lo", "min", "lap_time_ms"),
              M("_x_hi", "max", "lap_number"), M("_x_lo", "min", "lap_number"), M("laps_in_stint", "rows")],
             timed, max_dim_bytes)
    return g.select(
        *keys,
        ((F.col("_y_hi") - F.col("_y_lo")) / F.nullif(F.col("_x_hi") - F.col("_x_lo"), F.lit(0))).alias(
            "degradation_ms_per_lap"),
        "laps_in_stint",
        F.col("_x_lo").alias("stint_start_lap"),
        F.col("_x_hi").alias("stint_end_lap"),
    )


# ---- family B ---------------------------------------------------------------


def _timed_in_stint(laps: DataFrame) -> DataFrame:
    return timed(in_stint(laps))


def v_driver_avg_by_compound(laps, drivers, sessions, session_type="Race", max_dim_bytes=BROADCAST_MAX_BYTES) -> DataFrame:
    """VB1."""
    return _driver(_agg(laps, drivers, sessions, session_type, [*SESSION_KEYS, "full_name", "compound"],
                        [M("avg_lap_time_ms", "avg2", "lap_time_ms")], timed, max_dim_bytes))


def v_driver_avg_laptime(laps, drivers, sessions, session_type="Race", max_dim_bytes=BROADCAST_MAX_BYTES) -> DataFrame:
    """VB2: team is an extra group key."""
    return _driver(_agg(laps, drivers, sessions, session_type, [*SESSION_KEYS, "full_name", "team"],
                        [M("avg_lap_time_ms", "avg2", "lap_time_ms")], timed, max_dim_bytes))


def v_stint_summary(laps, drivers, sessions, session_type="Race", max_dim_bytes=BROADCAST_MAX_BYTES) -> DataFrame:
    """VB3: NULL stints dropped; ``COUNT(lap_number)``."""
    return _driver(_agg(
        laps, drivers, sessions, session_type, [*SESSION_KEYS, "full_name", "stint_id", "compound"],
        [M("total_laps", "count", "lap_number"), M("avg_lap_time_ms", "avg2", "lap_time_ms"),
         M("best_lap_time_ms", "min", "lap_time_ms"), M("worst_lap_time_ms", "max", "lap_time_ms"),
         M("stint_start_lap", "min", "lap_number"), M("stint_end_lap", "max", "lap_number")],
        _timed_in_stint, max_dim_bytes))


def v_tyre_degradation(laps, drivers, sessions, session_type="Race", max_dim_bytes=BROADCAST_MAX_BYTES) -> DataFrame:
    """VB4: NULL stints kept; ``COUNT(*)``; no slope despite the name."""
    return _driver(_agg(
        laps, drivers, sessions, session_type, [*SESSION_KEYS, "full_name", "compound", "stint_id"],
        [M("laps_in_stint", "rows"), M("stint_start_lap", "min", "lap_number"),
         M("stint_end_lap", "max", "lap_number"), M("avg_lap_time_ms", "avg2", "lap_time_ms"),
         M("best_lap_time_ms", "min", "lap_time_ms"), M("worst_lap_time_ms", "max", "lap_time_ms")],
        timed, max_dim_bytes))


def v_best_laps(laps, drivers, sessions, session_type="Race") -> DataFrame:
    """VB5: every lap that equals its (session, driver id) best, ties kept.

    Grouped by driver id, not name, so homonyms stay apart; a driver with no
    timed lap has no row.
    """
    s = sessions.select("session_id", *SESSION_KEYS)
    if session_type is not None:
        s = race_only(s, session_type)
    race_laps = timed(laps).select("session_id", "driver_id", "lap_time_ms", "compound", "lap_number")
    race_laps = race_laps.join(small_side(s.select("session_id")), "session_id", "left_semi")
    best = arg_min(race_laps, ["session_id", "driver_id"], "lap_time_ms")
    return join_dim(join_dim(best, s, "session_id"), drivers.select("driver_id", "full_name"), "driver_id").select(
        *SESSION_KEYS,
        F.col("full_name").alias("driver"),
        F.col("lap_time_ms").alias("best_lap_time_ms"),
        F.col("compound").alias("best_lap_compound"),
        F.col("lap_number").alias("best_lap_number"),
    )


def v_avg_gap_to_leader(laps, drivers, sessions, session_type="Race", max_dim_bytes=BROADCAST_MAX_BYTES) -> DataFrame:
    """VB6."""
    return _driver(_agg(laps, drivers, sessions, session_type, [*SESSION_KEYS, "full_name"],
                        [M("avg_gap_to_leader_ms", "avg2", "gap_to_leader_ms")], with_gap, max_dim_bytes))


def v_session_summary(laps, drivers, sessions, session_type="Race", max_dim_bytes=BROADCAST_MAX_BYTES) -> DataFrame:
    """VB7: per driver (unlike VA5), inner join."""
    return _driver(_agg(
        laps, drivers, sessions, session_type, [*SESSION_KEYS, "full_name"],
        [M("total_laps", "count", "lap_number"), M("best_lap_time_ms", "min", "lap_time_ms"),
         M("avg_lap_time_ms", "avg2", "lap_time_ms")],
        timed, max_dim_bytes))


def v_pitstops(laps, drivers, sessions, session_type="Race") -> DataFrame:
    """VB8: first lap of every stint, the race-start stint included (kept as in the reference)."""
    s = sessions.select("session_id", *SESSION_KEYS)
    if session_type is not None:
        s = race_only(s, session_type)
    stint_laps = in_stint(laps).where(F.col("lap_number").isNotNull()).select("session_id", "driver_id", "stint_id", "lap_number", "compound")
    stint_laps = stint_laps.join(small_side(s.select("session_id")), "session_id", "left_semi")
    first = arg_min(stint_laps, ["session_id", "driver_id", "stint_id"], "lap_number")
    return join_dim(join_dim(first, s, "session_id"), drivers.select("driver_id", "full_name"), "driver_id").select(
        *SESSION_KEYS,
        F.col("full_name").alias("driver"),
        F.col("lap_number").alias("pit_lap"),
        F.col("compound").alias("new_compound"),
        "stint_id",
    )


# L1: the order the v_pitstops view declares; results are sets, so apply it at read time.
V_PITSTOPS_ORDER = ["year", "track", "driver", "stint_id"]


def ordered(df: DataFrame, cols) -> DataFrame:
    """L1/L2: sort a view's result for presentation (ascending, NULLs first as in MySQL)."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in cols])


FAMILY_A = {
    "avg_gap_to_leader": avg_gap_to_leader,
    "best_laps": best_laps,
    "driver_avg_by_compound": driver_avg_by_compound,
    "driver_avg_laptime": driver_avg_laptime,
    "stint_summary": stint_summary,
    "tyre_degradation": tyre_degradation,
}

FAMILY_B = {
    "v_driver_avg_by_compound": v_driver_avg_by_compound,
    "v_driver_avg_laptime": v_driver_avg_laptime,
    "v_stint_summary": v_stint_summary,
    "v_tyre_degradation": v_tyre_degradation,
    "v_best_laps": v_best_laps,
    "v_avg_gap_to_leader": v_avg_gap_to_leader,
    "v_session_summary": v_session_summary,
    "v_pitstops": v_pitstops,
}

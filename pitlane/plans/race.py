"""Weather beside the laps, and pit stops of several cars against each other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.config import materialize
from pitlane.functions.cleanse import nullable_int, to_ms
from pitlane.operators.asof import asof_join, overlap_count, overlap_join
from pitlane.operators.filters import pit_in_laps
from pitlane.operators.ranking import GROUP_WINDOW_MAX_ROWS
from pitlane.operators.timing import CAR, cumulative_ms, next_lap

#: Length of a bucket of the session's clock: a few laps.
CLOCK_BUCKET_MS = 300_000
#: Width of the finest bins of stop windows: about a stop.
STOP_BIN_MS = 30_000
#: How long after its own stop a car still answers a rival's.
REACH_MS = 30_000


def enrich_weather(raw: DataFrame, weather: DataFrame, max_group_rows: int = GROUP_WINDOW_MAX_ROWS) -> DataFrame:
    """Each raw lap with its end on the session's clock (W1) and the last weather sample at or before it.

    Of samples at one time the later one (``sample``) counts. A lap without a time, or one
    that ends before the first sample, has no weather.
    """
    laps = cumulative_ms(raw, max_group_rows).select(*CAR, "lap_number", "stint", "compound", "lap_time_us", "cum_ms")
    return asof_join(laps, weather, ["session_id"], "cum_ms", "at_ms", CLOCK_BUCKET_MS, tie=["sample"], max_group_rows=max_group_rows)


def weather_pace(raw: DataFrame, weather: DataFrame) -> DataFrame:
    """Laps and mean lap time per session, compound and rain, of timed laps with weather."""
    laps = enrich_weather(raw, weather).where(F.col("at_ms").isNotNull() & F.col("lap_time_us").isNotNull())
    return laps.groupBy("session_id", "compound", "rainfall").agg(
        F.count(F.lit(1)).alias("laps"), F.avg("lap_time_us").alias("avg_lap_us"), F.max("wind").alias("max_wind")
    )


def stop_windows(raw: DataFrame, max_group_rows: int = GROUP_WINDOW_MAX_ROWS) -> DataFrame:
    """One row per pit stop: when the car is in the pits on the session's clock.

    A stop begins when its in-lap ends (W1) and lasts as W4 has it; without either time the
    window is unknown, and a stop of no or negative length is not a window. The stops are written once:
    what follows counts and reads them several times, and the laps' windows run once.
    """
    laps = cumulative_ms(raw, max_group_rows).select(*CAR, "lap_number", "seq", "position", "cum_ms", "pit_in_us", "pit_out_us")
    stops = pit_in_laps(next_lap(laps, ["pit_out_us"], max_group_rows=max_group_rows))
    out = F.coalesce("pit_out_us", "next_pit_out_us")
    return materialize(stops.select(
        *CAR,
        nullable_int("lap_number").alias("lap_number"),
        nullable_int("position").alias("position"),
        F.col("cum_ms").cast("long").alias("from_ms"),
        (F.col("cum_ms") + to_ms(out - F.col("pit_in_us"))).cast("long").alias("to_ms"),
    ), "stop-windows")


def pit_traffic(raw: DataFrame) -> DataFrame:
    """Each stop with the number of other stops of its session that it overlaps."""
    return overlap_count(stop_windows(raw), ["session_id"], "from_ms", "to_ms", CLOCK_BUCKET_MS, out="others")


def pit_battles(raw: DataFrame, reach_ms: int = REACH_MS, max_group_rows: int = GROUP_WINDOW_MAX_ROWS) -> DataFrame:
    """Stops of two cars, one place apart when they came in, whose windows overlap within ``reach_ms``.

    ``kind`` is ``undercut`` if the car behind stopped first, ``overcut`` if it stopped last, else
    ``together``. ``gained``: whether it is ahead on the lap after the later in-lap; NULL if
    either position is unknown there.
    """
    stops = stop_windows(raw, max_group_rows).where(F.col("position").isNotNull())
    reach = stops.withColumn("reach_ms", F.col("to_ms") + reach_ms)
    behind = reach.select(
        "session_id", F.col("driver").alias("behind"), F.col("lap_number").alias("behind_lap"), F.col("from_ms").alias("behind_from"),
        F.col("to_ms").alias("behind_to"), F.col("reach_ms").alias("behind_reach"), (F.col("position") - 1).alias("place"),
    )
    ahead = reach.select(
        F.col("session_id").alias("a_session"), F.col("driver").alias("ahead"), F.col("lap_number").alias("ahead_lap"), F.col("from_ms").alias("ahead_from"),
        F.col("to_ms").alias("ahead_to"), F.col("reach_ms").alias("ahead_reach"), F.col("position").alias("a_place"),
    )
    ok = F.col("behind_to") > F.col("behind_from"), F.col("ahead_to") > F.col("ahead_from")
    pairs = overlap_join(
        behind.where(ok[0]), ahead.where(ok[1]), [("session_id", "a_session"), ("place", "a_place")],
        ("behind_from", "behind_reach"), ("ahead_from", "ahead_reach"), STOP_BIN_MS,
    )
    kind = F.when(F.col("behind_from") < F.col("ahead_from"), "undercut").when(F.col("behind_from") > F.col("ahead_from"), "overcut").otherwise("together")
    shared = F.least("behind_to", "ahead_to") - F.greatest("behind_from", "ahead_from")
    pairs = pairs.select(
        "session_id", "place", "behind", "behind_lap", "ahead", "ahead_lap", kind.alias("kind"), F.greatest(shared, F.lit(0)).cast("long").alias("both_in_ms"),
        (F.greatest("behind_lap", "ahead_lap") + 1).alias("_after"),
    )
    # One row a car and lap, the first in frame order, read by both lookups.
    places = (
        raw.select(*CAR, nullable_int("lap_number").alias("_lap"), nullable_int("position").alias("_place"), "seq")
        .where(F.col("_lap").isNotNull() & F.col("_place").isNotNull())
        .groupBy(*CAR, "_lap").agg(F.min_by("_place", F.struct(F.col("seq").isNull(), "seq", "_place")).alias("_place"))
    )
    for side in ("behind", "ahead"):
        p = places.select(F.col("session_id").alias("_s"), F.col("driver").alias("_d"), "_lap", F.col("_place").alias(f"_{side}_place"))
        met = (F.col("session_id") == F.col("_s")) & (F.col(side) == F.col("_d")) & (F.col("_after") == F.col("_lap"))
        pairs = pairs.join(p, met, "left").drop("_s", "_d", "_lap")
    gained = F.col("_behind_place") < F.col("_ahead_place")
    return pairs.select("session_id", "place", "behind", "behind_lap", "ahead", "ahead_lap", "kind", "both_in_ms", gained.alias("gained"))

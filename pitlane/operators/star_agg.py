"""Star-join aggregation with eager (pre-join) aggregation for big dimensions.

The analytics views join the laps fact to drivers and sessions and group by
dimension attributes. Sessions are always broadcast behind the size check.
When drivers also fit, the fact streams through two broadcast joins into one
partial + final aggregate. When drivers do not fit, joining first would
shuffle every lap by ``driver_id``. Instead, the laps are aggregated per
(session, driver, lap keys) into decomposable partials (sum, count, min,
max), the much smaller result is joined to drivers, and the partials are
merged per output group. This is exact for every measure used here.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlane.operators.joins import BROADCAST_MAX_BYTES, fits, join_dim, small_side


@dataclass(frozen=True)
class Measure:
    """One output column: ``kind`` in avg, avg2 (rounded to 2), min, max, count (non-NULL), rows."""

    name: str
    kind: str
    col: str | None = None


def _direct(m: Measure) -> Column:
    if m.kind == "avg":
        return F.avg(m.col)
    if m.kind == "avg2":
        return F.round(F.avg(m.col), 2)
    if m.kind == "min":
        return F.min(m.col)
    if m.kind == "max":
        return F.max(m.col)
    if m.kind == "count":
        return F.count(m.col)
    if m.kind == "rows":
        return F.count(F.lit(1))
    raise ValueError(m.kind)


def _partials(m: Measure) -> list[Column]:
    p = f"_p_{m.name}"
    if m.kind in ("avg", "avg2"):
        return [F.sum(m.col).alias(p + "_s"), F.count(m.col).alias(p + "_n")]
    if m.kind in ("min", "max"):
        return [_direct(m).alias(p)]
    if m.kind in ("count", "rows"):
        return [_direct(m).alias(p)]
    raise ValueError(m.kind)


def _merge(m: Measure) -> Column:
    p = f"_p_{m.name}"
    if m.kind in ("avg", "avg2"):
        mean = F.sum(p + "_s").cast("double") / F.nullif(F.sum(p + "_n"), F.lit(0))
        return F.round(mean, 2) if m.kind == "avg2" else mean
    if m.kind == "min":
        return F.min(p)
    if m.kind == "max":
        return F.max(p)
    return F.sum(p).cast("long")  # count, rows


#: Of a table of stored partials: the number of laps a row stands for. Its presence tells such a table.
PARTIAL_ROWS = "_rows"
_MEASURED = ("lap_time_ms", "gap_to_leader_ms", "lap_number")


def lap_partials(laps: DataFrame) -> DataFrame:
    """Laps reduced to what the grouped views need, mergeable over any of their keys.

    Laps with and without a time, and with and without a gap, are kept apart, and a measure's least
    value stands under its own name: so the views' NULL filters mean the same here as on the laps.
    """
    grain = ["session_id", "driver_id", "stint_id", "compound"]
    timed, gapped = F.col("lap_time_ms").isNotNull().alias("_timed"), F.col("gap_to_leader_ms").isNotNull().alias("_gapped")
    parts = [F.count(F.lit(1)).alias(PARTIAL_ROWS)]
    for c in _MEASURED:
        parts += [F.min(c).alias(c), F.max(c).alias(f"_hi_{c}"), F.sum(c).alias(f"_s_{c}"), F.count(c).alias(f"_n_{c}")]
    return laps.groupBy(*grain, timed, gapped).agg(*parts).drop("_timed", "_gapped")


def _stored(m: Measure) -> Column:
    """A measure over stored partials."""
    if m.kind in ("avg", "avg2"):
        mean = F.sum(f"_s_{m.col}").cast("double") / F.nullif(F.sum(f"_n_{m.col}"), F.lit(0))
        return F.round(mean, 2) if m.kind == "avg2" else mean
    if m.kind == "min":
        return F.min(m.col)
    if m.kind == "max":
        return F.max(f"_hi_{m.col}")
    return F.sum(PARTIAL_ROWS if m.kind == "rows" else f"_n_{m.col}").cast("long")


def star_aggregate(
    laps: DataFrame,
    drivers: DataFrame,
    sessions: DataFrame,
    session_type: str | None,
    keys: Sequence[str],
    measures: Sequence[Measure],
    lap_filter: Callable[[DataFrame], DataFrame] | None = None,
    max_dim_bytes: int = BROADCAST_MAX_BYTES,
) -> DataFrame:
    """Group the star join of laps, drivers and sessions by ``keys`` with ``measures``.

    ``keys`` may name lap columns and driver/session attributes; the result
    has ``keys`` then the measure columns, named as given. ``laps`` may also be stored
    partials of laps (``lap_partials``), which are merged.
    """
    s_cols = [c for c in ("year", "track", "session_type") if c in keys]
    d_cols = [c for c in ("full_name", "team") if c in keys]
    lap_keys = [c for c in keys if c not in s_cols + d_cols and c != "session_id"]
    s = sessions.select("session_id", *s_cols, *([] if "session_type" in s_cols else ["session_type"]))
    if session_type is not None:
        s = s.where(F.col("session_type") == F.lit(session_type))
    s = s.select("session_id", *s_cols)
    d = drivers.select("driver_id", *d_cols)
    fact = lap_filter(laps) if lap_filter else laps
    if PARTIAL_ROWS in laps.columns:
        joined = join_dim(join_dim(fact, s, "session_id"), d, "driver_id", max_bytes=max_dim_bytes)
        return joined.groupBy(*keys).agg(*[_stored(m).alias(m.name) for m in measures])
    if fits(d, max_dim_bytes):
        joined = join_dim(join_dim(fact, s, "session_id"), d, "driver_id", max_bytes=max_dim_bytes)
        return joined.groupBy(*keys).agg(*[_direct(m).alias(m.name) for m in measures])
    # Eager aggregation: reduce the fact per (session, driver, lap keys) before the big join.
    fact = fact.join(small_side(s.select("session_id")), "session_id", "left_semi")
    partial = fact.groupBy("session_id", "driver_id", *lap_keys).agg(
        *[c for m in measures for c in _partials(m)]
    )
    joined = join_dim(partial.join(d, "driver_id"), s, "session_id")
    return joined.groupBy(*keys).agg(*[_merge(m).alias(m.name) for m in measures])

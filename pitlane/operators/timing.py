"""Lap timing: cumulative time (W1), gaps and intervals (W2, W3), pit stops
(W4), and the three lap normalisations (N1-N3).

Shuffle plan, designed so no step funnels a data-sized group into one task:

* W1's running sum (``running_sum``) is one window per car while the
  table, or else its largest car, holds at most 1M rows (footer count, then
  one aggregate, both remembered). Beyond that it is cut into contiguous
  slices, each a window, plus offsets from per-slice totals, so even an
  unbounded car is spread over many tasks.
* The laps' order is the frame order (``seq``): it orders W1's sum, decides which
  of several matching rows is the first (J6-J8), and which update is the last.
* W2 needs the leader's cumulative time per (session, lap) and W3 the car
  one position ahead. A (session, lap) group grows with the number of cars,
  so its size is counted first (memoised). Within the bound, one window per
  (session, lap) answers both. Beyond it, an aggregate per
  (session, lap, position) (partial + final, skew-safe) serves as the
  lookup table: W2 joins its P1 rows (broadcast behind the byte bound), and
  W3 joins it on position = mine - 1 (a near-unique key that AQE's
  skew-join can still split).
* W4 looks up the next lap of the same car with a range frame [+1, +1]
  over (car, chunk of lap numbers); chunk boundaries are bridged by copying
  each chunk's first lap into the previous chunk.

All lookups run before the driver lookup (J5), as in the reference: gaps
are computed over every car, including ones the lookup later rejects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitlane.config import materialize
from pitlane.functions.cleanse import nullable_int, to_ms
from pitlane.operators.filters import pit_in_laps
from pitlane.operators.joins import join_dim, resolve_driver
from pitlane.operators.ranking import GROUP_WINDOW_MAX_ROWS, largest_group, running_sum

CAR = ["session_id", "driver"]

# Lap numbers per chunk of the next-lap window (W4): a race is one chunk.
RUN_CHUNK = 256


def cumulative_ms(raw: DataFrame, max_group_rows: int | None = None) -> DataFrame:
    """Running race time per car, summed in microseconds, rounded once.

    A lap without a time gets NULL, but the sum carries on after it (a
    pandas cumsum skips NaT). Laps are summed in frame order, then by lap
    number (NULL last). A row without a session or driver belongs to no
    group of a pandas groupby, so its cumulative time is NULL; it is kept.
    The running sum (``running_sum``) is one window per car while the
    largest car is within the bound, and cut into slices beyond it, so
    even a car with an unbounded number of laps is spread over many tasks.
    """
    run = running_sum(
        raw, CAR, "seq", "lap_time_us", "_cum_us", tie=["lap_number", "lap_time_us"], max_group_rows=max_group_rows
    )
    known = F.col("session_id").isNotNull() & F.col("driver").isNotNull() & F.col("lap_time_us").isNotNull()
    return run.withColumn("cum_ms", F.when(known, to_ms("_cum_us"))).drop("_cum_us")


def _frame_order():
    """Frame order as a sort key without NULLs: ``seq`` (absent last), then the driver's code."""
    return F.struct(F.col("seq").isNull(), F.col("seq"), F.col("driver").isNull(), F.col("driver"))


def car_at_position(cum: DataFrame) -> DataFrame:
    """J6/J7 lookup table: per (session, lap, position) the cumulative time of its first car in frame order.

    An aggregate over a near-unique key (partial + final, skew-safe). The
    leader (J6) is its position-1 row; the car ahead (J7) is the row at
    position - 1. Both lookups read this one table, so its shuffle is shared.
    """
    return (
        cum.where(_numbered() & F.col("position").isNotNull() & ~F.isnan("position"))
        .groupBy("session_id", "lap_number", "position")
        .agg(F.min_by("cum_ms", _frame_order()).alias("cum_at"))
    )


def leader_of_lap(lookup: DataFrame) -> DataFrame:
    """leader's cumulative time per (session, lap): the first car of the frame in position 1."""
    return lookup.where(F.col("position") == 1).select(
        "session_id", "lap_number", F.col("cum_at").alias("leader_cum_ms")
    )


def car_ahead(lookup: DataFrame) -> DataFrame:
    """The lookup keyed by ``ahead_position``, to be joined on ``position - 1``."""
    return lookup.select(
        F.col("session_id").alias("_a_session"), F.col("lap_number").alias("_a_lap"),
        F.col("position").alias("ahead_position"), F.col("cum_at").alias("ahead_cum_ms"),
    )


def _lookups_by_window(cum: DataFrame) -> DataFrame:
    """Leader and car-ahead cumulative times with one window per (session, lap).

    Used when no (session, lap) group exceeds the window bound: one shuffle,
    no self-join. ``min_by`` skips rows whose ordering is NULL, so the
    leader is the first car of the frame among the P1 rows; the range frame
    [-1, -1] over position holds exactly the cars one place ahead.
    """
    pos = F.col("position")
    valid = _numbered() & pos.isNotNull() & ~F.isnan(pos)
    lap = Window.partitionBy("session_id", "lap_number")
    p1 = valid & (pos == 1)
    ahead = lap.orderBy(pos).rangeBetween(-1, -1)
    return cum.withColumns({
        "leader_cum_ms": F.when(_numbered(), F.min_by(F.col("cum_ms"), F.when(p1, _frame_order())).over(lap)),
        "ahead_cum_ms": F.when(valid, F.min_by(F.col("cum_ms"), _frame_order()).over(ahead)),
    })


def _numbered():
    """A lap with a lap number: NULL and NaN never equal another lap (pandas NaN != NaN)."""
    return F.col("lap_number").isNotNull() & ~F.isnan("lap_number")


def with_gaps(raw: DataFrame, max_group_rows: int = GROUP_WINDOW_MAX_ROWS) -> DataFrame:
    """W1 + W2 + W3 on raw laps: ``cum_ms``, ``gap_to_leader_ms``, ``interval_to_next_ms``.

    A provided value wins; otherwise the difference of cumulative times.
    NULL when either side is missing; a gap may be negative. The lookups
    are a window per (session, lap) while the largest such group is within
    ``max_group_rows`` (a memoised count), else an aggregate joined back.
    """
    cum = cumulative_ms(raw, max_group_rows)
    out = [*raw.columns, "cum_ms", "gap_to_leader_ms", "interval_to_next_ms"]
    if largest_group(raw, ["session_id", "lap_number"]) <= max_group_rows:
        return _gap_columns(_lookups_by_window(cum)).select(*out)
    lookup = materialize(car_at_position(cum), "places")  # read by both lookups: the laps are summed for it once
    leaders = materialize(leader_of_lap(lookup), "leaders")  # a row for each lap of a session
    ahead = car_ahead(lookup)
    j = join_dim(cum, leaders, ["session_id", "lap_number"], "left")
    j = j.join(
        ahead,
        (F.col("session_id") == F.col("_a_session"))
        & (F.col("lap_number") == F.col("_a_lap"))
        & (F.col("position") - 1 == F.col("ahead_position")),
        "left",
    ).drop("_a_session", "_a_lap", "ahead_position")
    return _gap_columns(j).select(*out)


def _gap_columns(j: DataFrame) -> DataFrame:
    """Provided values win; else differences of cumulative times."""
    return j.withColumns({
        "gap_to_leader_ms": F.when(F.col("gap_to_leader_us").isNotNull(), to_ms("gap_to_leader_us"))
        .otherwise(F.col("cum_ms") - F.col("leader_cum_ms")),
        "interval_to_next_ms": F.when(F.col("interval_to_ahead_us").isNotNull(), to_ms("interval_to_ahead_us"))
        .otherwise(F.col("cum_ms") - F.col("ahead_cum_ms")),
    }).drop("leader_cum_ms", "ahead_cum_ms")


def next_lap(raw: DataFrame, cols: list[str], chunk: int = RUN_CHUNK,
             max_group_rows: int = GROUP_WINDOW_MAX_ROWS) -> DataFrame:
    """For each lap, ``next_<col>`` of the same car's lap numbered one higher, and ``has_next``.

    A range frame [+1, +1] over lap number holds exactly the laps numbered
    n + 1; of several, the first in frame order counts (then the least
    values, so the answer never depends on row order). The window is
    partitioned by (car, chunk of lap numbers), never by car alone; each
    chunk's first laps are also copied into the previous chunk, so the lap
    after a chunk's last lap is in reach. If a lap number of a car comes
    more than ``max_group_rows`` times (so ``chunk`` times that in a window),
    the window runs over one row per (car, lap), chosen by the same order,
    and its answers are joined back on (car, lap). Laps without a number
    (NULL or NaN), session or driver have no next lap.
    """
    lap = F.col("lap_number")
    linked = _numbered() & F.col("session_id").isNotNull() & F.col("driver").isNotNull()
    numbered = raw.where(linked).withColumn("_chunk", F.floor(lap / chunk))
    w = Window.partitionBy(*CAR, "_chunk").orderBy(lap).rangeBetween(1, 1)
    order = F.struct(F.col("seq").isNull(), F.col("seq"), *[F.col(c) for c in cols])
    first = F.min_by(F.struct(*[F.col(c) for c in cols]), order)

    def lookup(rows: DataFrame) -> DataFrame:
        tagged = rows.withColumn("_copy", F.lit(False))
        copies = (
            tagged.where(lap - F.col("_chunk") * chunk < 1)
            .withColumn("_chunk", F.col("_chunk") - 1).withColumn("_copy", F.lit(True))
        )
        found = tagged.unionByName(copies).withColumn("_next", first.over(w))
        found = found.withColumns(
            {"has_next": F.col("_next").isNotNull(), **{f"next_{c}": F.col("_next")[c] for c in cols}}
        )
        return found.where(~F.col("_copy")).drop("_chunk", "_copy", "_next")

    if largest_group(raw, [*CAR, "lap_number"]) <= max_group_rows:
        found = lookup(numbered)
    else:
        firsts = numbered.groupBy(*CAR, "lap_number", "_chunk").agg(
            F.min(F.col("seq")).alias("seq"), first.alias("_v")
        ).select(*CAR, "lap_number", "_chunk", "seq", "_v.*")
        answers = lookup(firsts).select(*CAR, "lap_number", "has_next", *[f"next_{c}" for c in cols])
        found = numbered.drop("_chunk").join(answers, [*CAR, "lap_number"], "left")
    unnumbered = raw.where(~linked).withColumn("has_next", F.lit(False))
    for c in cols:
        unnumbered = unnumbered.withColumn(f"next_{c}", F.lit(None).cast(raw.schema[c].dataType))
    return found.unionByName(unnumbered).select(*raw.columns, "has_next", *[f"next_{c}" for c in cols])


def pit_stops(raw: DataFrame, max_group_rows: int = GROUP_WINDOW_MAX_ROWS) -> DataFrame:
    """W4 on raw laps: one row per pit-in lap (F7), before the driver lookup.

    ``compound_out`` is the next lap's compound. The pit-out time is the
    lap's own, else the next lap's; ``stop_ms = to_ms(out - in)``, NULL if
    either is missing, negative if the own-lap pit-out is earlier (kept).
    """
    nx = pit_in_laps(next_lap(raw.select(*CAR, "lap_number", "seq", "compound", "pit_in_us", "pit_out_us"),
                              ["compound", "pit_out_us"], max_group_rows=max_group_rows))
    pit_out = F.when(F.col("pit_out_us").isNotNull(), F.col("pit_out_us")).otherwise(F.col("next_pit_out_us"))
    return nx.select(
        "session_id", "driver",
        nullable_int("lap_number").alias("lap_number"),
        F.col("compound").alias("compound_in"),
        F.col("next_compound").alias("compound_out"),
        to_ms(pit_out - F.col("pit_in_us")).alias("stop_time_ms"),
        "seq",
    )


def _lap_columns(df: DataFrame, rounding: str) -> list:
    ms = lambda c: to_ms(c, rounding).cast("int")
    return [
        F.col("session_id").cast("int").alias("session_id"),
        F.col("driver_id").cast("int").alias("driver_id"),
        nullable_int("lap_number").alias("lap_number"),
        nullable_int("stint").alias("stint_id"),
        F.col("compound").cast("string").alias("compound"),  # C4
        ms("lap_time_us").alias("lap_time_ms"),
        ms("sector1_us").alias("sector1_ms"),
        ms("sector2_us").alias("sector2_ms"),
        ms("sector3_us").alias("sector3_ms"),
        nullable_int("position").alias("position"),
    ]


def normalise_laps(raw: DataFrame, drivers: DataFrame, fill_gaps: bool = False, keep_seq: bool = False,
                   max_group_rows: int = GROUP_WINDOW_MAX_ROWS) -> tuple[DataFrame, DataFrame]:
    """N1 (``fill_gaps=False``) and N2 (``fill_gaps=True``): raw laps -> warehouse laps.

    Returns ``(laps, rejected)``: rejected raw laps have an unknown driver
    code (F10). N1 truncates to ms and keeps provided gaps only; N2 rounds
    and fills missing gaps from cumulative times (computed over all cars,
    before the lookup). A NULL lap number is kept as NULL by both (the
    reference's N2 would raise on it). ``keep_seq`` adds the frame order, by
    which an upsert tells the last of several rows.
    """
    if fill_gaps:
        src = with_gaps(raw, max_group_rows)
        _, rejected = resolve_driver(src, drivers)
        return warehouse_laps(src, drivers, keep_seq), rejected.select(*raw.columns)
    gap = to_ms("gap_to_leader_us", "truncate").cast("int").alias("gap_to_leader_ms")
    ivl = to_ms("interval_to_ahead_us", "truncate").cast("int").alias("interval_to_next_ms")
    known, rejected = resolve_driver(raw, drivers)
    return known.select(*_lap_columns(known, "truncate"), gap, ivl, *(["seq"] if keep_seq else [])), rejected.select(*raw.columns)


def warehouse_laps(timed: DataFrame, drivers: DataFrame, keep_seq: bool = False) -> DataFrame:
    """Raw laps with their gaps (``with_gaps``) as warehouse rows, rounded; unknown drivers dropped."""
    known, _ = resolve_driver(timed, drivers)
    gaps = [F.col(c).cast("int").alias(c) for c in ("gap_to_leader_ms", "interval_to_next_ms")]
    return known.select(*_lap_columns(known, "round"), *gaps, *(["seq"] if keep_seq else []))


def normalise_pitstops(raw: DataFrame, drivers: DataFrame, keep_seq: bool = False,
                       max_group_rows: int = GROUP_WINDOW_MAX_ROWS) -> DataFrame:
    """Pit stops (W4) with driver ids; unknown codes dropped."""
    known, _ = resolve_driver(pit_stops(raw, max_group_rows), drivers)
    return known.select(
        F.col("session_id").cast("int").alias("session_id"),
        F.col("driver_id").cast("int").alias("driver_id"),
        "lap_number", "compound_in", "compound_out", "stop_time_ms", *(["seq"] if keep_seq else []),
    )

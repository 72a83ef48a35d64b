"""Joins on time. As-of (the last sample at or before a row) and overlap of intervals.

Neither sends the rows of one key to one task.

* ``asof_join`` cuts each key's time into buckets. Rows and samples of a bucket share one window;
  what a bucket inherits, the last sample before it, is found on one row per bucket (the last
  sample of each, carried forward) and enters the window as its first sample. Where a bucket has more
  rows than a window may hold, rows and samples are cut into contiguous slices instead; what a
  slice inherits is the last sample of the key's earlier slices. No row or sample is copied.
* ``overlap_join`` cuts intervals into bins and joins equal bins. An interval is cut at the finest
  level at which it covers at most ``MAX_BINS`` bins, and also at every coarser one that some
  interval is cut at, so one of any length makes a bounded number of pieces; two intervals meet at the coarser of their levels and
  are a pair only in the bin where the later one begins, so a pair is emitted once and needs no
  ``distinct``.
* ``overlap_count`` counts the overlapping intervals without any pair: those that begin before
  an interval's end less those that end at or before its start, both by ``asof_join`` over
  running counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitlane.config import materialize
from pitlane.operators.ranking import GROUP_WINDOW_MAX_ROWS, largest_group, running_sum, slice_count, slices, with_earlier

#: Most bins an interval covers at its level, and how much wider each level's bins are.
MAX_BINS = 8
LEVEL_STEP = 16
LEVELS = 8


def _usable(df: DataFrame, cols: Sequence[str]) -> Column:
    """No NULL, and no NaN among floating columns: such a row is equal to and before nothing."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
        if dict(df.dtypes)[c] in ("double", "float"):
            cond = cond & ~F.isnan(c)
    return cond


def asof_join(rows: DataFrame, samples: DataFrame, by: Sequence[str], time: str, at: str, width: float, tie: Sequence[str] = (),
              max_group_rows: int = GROUP_WINDOW_MAX_ROWS) -> DataFrame:
    """``rows`` with the columns of the last of ``samples`` whose ``at`` is at or before ``time``.

    Both sides share the key columns ``by``; ``width`` is a bucket's length in the unit of
    ``time``. Of samples at the same time the greatest by ``tie`` counts, then by all their columns. A row
    without a key or time, or before the first sample, has NULLs; a sample without a key or ``at`` is
    never taken. Every row comes once, repeated rows too. Rows that keep their bucket
    within ``max_group_rows`` share one window per bucket; with a larger bucket all are sliced.
    """
    payload = [c for c in samples.columns if c not in by]
    clash = set(payload) & set(rows.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    row, sample = F.struct(*rows.columns), F.struct(*payload)
    known = _usable(rows, [*by, time])
    left = rows.where(known).select(*by, F.col(time).alias("_t"), F.floor(F.col(time) / width).alias("_bucket"), row.alias("_row"))
    order = F.struct(*(F.col(c).alias(f"_{k}") for k, c in enumerate([at, *tie, *payload])))
    right = samples.where(_usable(samples, [*by, at])).select(
        *by, F.col(at).alias("_t"), F.floor(F.col(at) / width).alias("_bucket"), sample.alias("_sample"), order.alias("_order")
    )
    nothing = {c: F.lit(None).cast(right.schema[c].dataType) for c in ("_sample", "_order")}
    keys = [*by, "_bucket"]
    if largest_group(rows, by) > max_group_rows and largest_group(left.select(*keys), keys) > max_group_rows:
        # A sample comes before the rows of its time; rows of one time are spread by a hash.
        merged = left.withColumns({**nothing, "_side": F.lit(2)}).unionByName(right.withColumn("_side", F.lit(1)), allowMissingColumns=True).drop("_bucket")
        order_in = [F.col("_t"), F.col("_side"), F.col("_order"), F.xxhash64("_row")]
        parts = slices(merged, by, order_in, slice_count(rows))
        within = Window.partitionBy("_slice", *by).orderBy(*order_in).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        local = parts.withColumn("_sample", F.last("_sample", ignorenulls=True).over(within)).where("_side = 2")
        found = with_earlier(local, parts, by, F.max_by("_sample", F.when(F.col("_sample").isNotNull(), F.col("_order"))),
                             lambda c: F.last(c, ignorenulls=True)).withColumn("_sample", F.coalesce("_sample", "_earlier"))
    else:
        # One row a bucket: its last sample, and whether it has rows. What precedes it is carried in.
        buckets = (
            left.select(*keys).withColumns({**nothing, "_n": F.lit(1)})
            .unionByName(right.select(*keys, "_sample", "_order").withColumn("_n", F.lit(0)))
            .groupBy(*keys).agg(F.max_by("_sample", "_order").alias("_sample"), F.sum("_n").alias("_n"))
        )
        earlier = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        carried = (
            buckets.withColumn("_sample", F.last("_sample", ignorenulls=True).over(earlier)).where((F.col("_n") > 0) & F.col("_sample").isNotNull())
            .select(*keys, "_sample")
        )
        # A sample comes before the rows of its time; what is carried in comes before all.
        merged = (
            left.withColumns({**nothing, "_side": F.lit(2)})
            .unionByName(right.withColumn("_side", F.lit(1)), allowMissingColumns=True)
            .unionByName(carried.withColumn("_side", F.lit(0)), allowMissingColumns=True)
        )
        so_far = Window.partitionBy(*keys).orderBy(F.col("_t").asc_nulls_first(), "_side", "_order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        found = merged.withColumn("_sample", F.last("_sample", ignorenulls=True).over(so_far)).where("_side = 2")
    found = found.select("_row.*", *(F.col("_sample")[c].alias(c) for c in payload))
    rest = rows.where(~known).select(*rows.columns, *(F.lit(None).cast(samples.schema[c].dataType).alias(c) for c in payload))
    return found.unionByName(rest)


def _bins(start: Column, end: Column, width: float) -> tuple[list[Column], list[Column]]:
    """First and last bin of an interval at every level."""
    scale = [width * LEVEL_STEP**k for k in range(LEVELS)]
    return [F.floor(start / w) for w in scale], [F.floor((end - 1) / w) for w in scale]


def _own_level(start: Column, end: Column, width: float) -> Column:
    """The finest level at which an interval covers at most ``MAX_BINS`` bins."""
    first, last = _bins(start, end, width)
    own = F.lit(LEVELS - 1)
    for k in reversed(range(LEVELS - 1)):
        own = F.when(last[k] - first[k] < MAX_BINS, k).otherwise(own)
    return own


def _levels(start: Column, end: Column, width: float, levels: Sequence[int] = range(LEVELS)) -> Column:
    """(level, bin) of an interval at its own level and all coarser ones of ``levels``, and its own level."""
    first, last = _bins(start, end, width)
    own = _own_level(start, end, width)

    def at(level: int) -> Column:
        bins = F.transform(F.sequence(first[level], last[level]), lambda x: F.struct(F.lit(level).alias("level"), x.alias("bin"), own.alias("own")))
        return F.when(F.lit(level) >= own, bins).otherwise(F.array().cast("array<struct<level:int,bin:bigint,own:int>>"))

    return F.flatten(F.array(*(at(k) for k in levels)))


def overlap_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], left_span: tuple[str, str], right_span: tuple[str, str],
                 width: float) -> DataFrame:
    """Pairs of rows with equal ``on`` columns whose half-open whole-number intervals overlap.

    Column names of the two sides must differ. Each pair comes once; an empty or reversed interval,
    or one with a NULL, overlaps nothing. The join is on (``on``, level, bin), which a sort-merge
    join spreads and AQE splits where it is skewed; the last level is exact at any length.
    """
    (ls, le), (rs, re_) = left_span, right_span

    sides = (left, left_span, [x for x, _ in on]), (right, right_span, [x for _, x in on])
    ok = [df.where((F.col(span[1]) > F.col(span[0])) & _usable(df, cols)) for df, span, cols in sides]
    # Two intervals meet at the coarser of their own levels: no pieces at a level that is nobody's own.
    owns = [df.select(_own_level(F.col(span[0]), F.col(span[1]), width).alias("_own")) for df, (_, span, _) in zip(ok, sides)]
    levels = sorted(r["_own"] for r in owns[0].unionAll(owns[1]).distinct().collect())

    def cut(df: DataFrame, span: tuple[str, str], side: str) -> DataFrame:
        at = F.explode(_levels(F.col(span[0]), F.col(span[1]), width, levels or [0])).alias("_at")
        return df.select("*", at).select(*df.columns, *(F.col("_at")[c].alias(f"_{side}_{c}") for c in ("level", "bin", "own")))

    a, b = cut(ok[0], left_span, "l"), cut(ok[1], right_span, "r")
    equal = (F.col("_l_level") == F.col("_r_level")) & (F.col("_l_bin") == F.col("_r_bin"))
    for x, y in on:
        equal = equal & (F.col(x) == F.col(y))
    scale = F.lit(float(width)) * F.pow(F.lit(float(LEVEL_STEP)), F.col("_l_level"))
    met = (F.col("_l_level") == F.greatest("_l_own", "_r_own")) & (F.floor(F.greatest(ls, rs) / scale) == F.col("_l_bin"))
    overlap = (F.col(ls) < F.col(re_)) & (F.col(rs) < F.col(le))
    return a.join(b, equal & met & overlap, "inner").select(*left.columns, *right.columns)


def overlap_count(spans: DataFrame, by: Sequence[str], start: str, end: str, width: float, out: str = "overlaps") -> DataFrame:
    """``spans`` with the number of other rows of the same key whose half-open interval overlaps.

    Intervals that begin before my end, less those that end at or before my start, less myself: running counts
    per distinct time (combined map-side) looked up as-of, so nothing grows with the number
    of overlapping pairs. Rows without a proper interval have NULL and are not counted.
    """
    proper = _usable(spans, [*by, start, end]) & (F.col(end) > F.col(start))
    ok = spans.where(proper)

    def counted(time: str, name: str) -> DataFrame:
        per_time = ok.groupBy(*by, F.col(time).alias(f"_{name}_at")).agg(F.count(F.lit(1)).alias("_n"))
        # Written once each, as the as-of joins count and read their sides several times.
        per_time = materialize(per_time, f"{name}-times")
        return materialize(running_sum(per_time, by, f"_{name}_at", "_n", f"_{name}").drop("_n"), name)

    begun = materialize(asof_join(ok.withColumn("_until", F.col(end) - 1), counted(start, "begun"), by, "_until", "_begun_at", width), "overlaps")
    both = asof_join(begun, counted(end, "ended"), by, start, "_ended_at", width)
    n = F.col("_begun") - F.coalesce("_ended", F.lit(0)) - 1
    rest = spans.where(~proper).withColumn(out, F.lit(None).cast("long"))
    return both.select(*spans.columns, n.cast("long").alias(out)).unionByName(rest)

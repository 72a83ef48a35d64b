"""Arg-min with ties (J3, J4, L5), first-by (L4), driver rows (W5), latest event (L3).

No operator here sends a data-sized group to one task: arg-min is an
aggregate joined back, row numbers over groups that can grow are computed
slice by slice, and the only plain windows run over distinct or counted
tables that are bounded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitlane.operators.filters import past_events
from pitlane.config import materialize
from pitlane.operators.joins import memo_by_plan


def _asc_nulls_last(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).asc_nulls_last()


def arg_min(df: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """Rows whose ``order`` value is the minimum of their ``by`` group, ties kept.

    An aggregate of the group minimum (partial + final, so a hot group is
    combined map-side) joined back on (by, order). The minimum table has one
    row per group; AQE broadcasts it when its shuffle turns out small and
    can split a hot group otherwise, so nothing is run to size it. Rows with
    a NULL ``order`` (or NULL group key) never qualify, as in an equality
    join-back.
    """
    cand = df.where(F.col(order).isNotNull())
    mins = cand.groupBy(*by).agg(F.min(order).alias(order))
    return cand.join(mins, [*by, order], "inner").select(*df.columns)


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """L4: exactly one row per key, the first by ``order`` (ascending; give a complete tie key).

    ``min_by`` over the whole row: an aggregate, so a hot key is reduced map-side.
    """
    cols = [c for c in df.columns if c not in keys]
    ordering = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order], *[F.col(c) for c in cols])
    return (
        df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in cols]), ordering).alias("_row"))
        .select(*keys, "_row.*").select(*df.columns)
    )


def running_sum(df: DataFrame, groups: Sequence[str], order: str, value: str, out: str,
                tie: Sequence[str | Column] = (), max_group_rows: int | None = None, largest: int | None = None) -> DataFrame:
    """``sum(value) over (partition by groups order by order[, tie] rows unbounded preceding)``.

    The largest group is counted first (memoised aggregate), unless the caller knows it
    (``largest``). Within the bound it is that plain window. Beyond it, rows are cut into
    contiguous slices (``slices``): the sum within a slice is a window over one slice, and a
    slice's offset is the total of its group's earlier slices. A hot group, even one
    of repeated lap numbers, is spread over many tasks. NULL values are
    skipped, as SUM does.
    """
    bound = GROUP_WINDOW_MAX_ROWS if max_group_rows is None else max_group_rows
    sort = [F.col(order).asc_nulls_last(), *[F.col(t).asc_nulls_last() if isinstance(t, str) else t for t in tie]]
    if (largest_group(df, groups) if largest is None else largest) <= bound:
        w = Window.partitionBy(*groups).orderBy(*sort).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumn(out, F.sum(value).over(w))
    parts = slices(df, groups, sort)
    within = Window.partitionBy("_slice", *groups).orderBy(*sort).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    j = with_earlier(parts.withColumn("_run", F.sum(value).over(within)), parts, groups, F.sum(value), F.sum)
    # NULL while nothing non-NULL has been summed, like the plain window
    total = F.when(F.col("_run").isNull() & F.col("_earlier").isNull(), F.lit(None)).otherwise(
        F.coalesce(F.col("_earlier"), F.lit(0)) + F.coalesce(F.col("_run"), F.lit(0)))
    return j.select(*df.columns, total.alias(out))


def slices(df: DataFrame, groups: Sequence[str], order: Sequence[Column], partitions: int | None = None) -> DataFrame:
    """``df`` in contiguous slices of (groups, order), by ``_slice``: written once, since range bounds come
    from sampling and must not be recomputed. A slice holds about a window's bound of rows at most."""
    n = partitions or slice_count(df)
    return materialize(df.repartitionByRange(n, *[F.col(g) for g in groups], *order).withColumn("_slice", F.spark_partition_id()), "slices")


def slice_count(df: DataFrame) -> int:
    """The session's shuffle partitions, or as many as keep a slice's rows about within a window's bound."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), row_count(df) // GROUP_WINDOW_MAX_ROWS + 1)


def with_earlier(local: DataFrame, parts: DataFrame, groups: Sequence[str], total: Column, merge) -> DataFrame:
    """``local`` with ``_earlier``: ``merge`` of the ``total`` of its group's earlier slices, NULL if there are none.

    Slices are contiguous, so of a slice's groups only the first can have begun earlier: the table joined
    back has at most one row for each slice, whatever the number of groups, and is broadcast.
    """
    earlier = Window.partitionBy(*groups).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    per = parts.groupBy("_slice", *groups).agg(total.alias("_total")).select(
        F.col("_slice").alias("_o_slice"), *[F.col(g).alias(f"_o_{g}") for g in groups], merge("_total").over(earlier).alias("_earlier"))
    cond = (F.col("_slice") == F.col("_o_slice")) & _same(groups)
    return local.join(F.broadcast(per.where(F.col("_earlier").isNotNull())), cond, "left").drop("_o_slice", *[f"_o_{g}" for g in groups])


def _same(keys: Sequence[str]) -> Column:
    """Null-safe equality of ``k`` and ``_o_k`` for all keys."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_o_{k}"))
    return cond


# Largest group numbered by one plain window task; bigger groups are sliced.
GROUP_WINDOW_MAX_ROWS = 1_000_000


def row_count(df: DataFrame) -> int:
    """Rows of ``df``, remembered per plan."""
    return memo_by_plan(df.select(F.lit(1)), "rows", df.count)


def largest_group(df: DataFrame, groups: Sequence[str]) -> int:
    """Row count of the biggest group, or of the whole input while that is within the window bound.

    A stored table's total comes from the file footers, a far cheaper job than
    the aggregate per group, which runs only on inputs beyond the bound.
    Both are remembered per plan.
    """
    total = row_count(df)
    if total <= GROUP_WINDOW_MAX_ROWS:
        return total

    def compute():
        v = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0]
        return 0 if v is None else int(v)
    return memo_by_plan(df.select(*groups), ("largest_group", tuple(groups)), compute)


def group_row_number(df: DataFrame, groups: Sequence[str], order: Sequence[str | Column],
                     out: str = "row_number", partitions: int | None = None,
                     max_group_rows: int = GROUP_WINDOW_MAX_ROWS, largest: int | None = None) -> DataFrame:
    """``row_number() over (partition by groups order by order)`` that never funnels a big group into one task.

    The largest group is counted first (an aggregate), unless the caller knows it (``largest``). Within
    ``max_group_rows`` every group fits one task and the plain window is
    used. Beyond it:

    1. Range-partition on (groups, order): a large group is cut into
       contiguous slices spread over several partitions (``slices``).
    2. Number rows inside each (slice, group): a window over at most one
       partition's worth of rows.
    3. Offset of a (slice, group) = rows of the same group in earlier slices
       (``with_earlier``), which only the first group of a slice has.
    ``order`` must be a total order within a group, as for ``row_number``.
    """
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    if (largest_group(df, groups) if largest is None else largest) <= max_group_rows:
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*groups).orderBy(*order_cols)).cast("int"))
    parts = slices(df, groups, order_cols, partitions)
    local = parts.withColumn(
        "_local", F.row_number().over(Window.partitionBy("_slice", *groups).orderBy(*order_cols))
    )
    joined = with_earlier(local, parts, groups, F.count(F.lit(1)), F.sum)
    return joined.select(
        *df.columns, (F.coalesce("_earlier", F.lit(0)) + F.col("_local")).cast("int").alias(out)
    )


def driver_row(df: DataFrame, session_col: str = "session_id", name_col: str = "full_name") -> DataFrame:
    """Chart row per (session, driver name): names ascending, reversed, numbered from 0.

    ``df`` holds a handful of rows per driver and session (stints), so a
    session's rows are bounded by its drivers and their stints: one dense
    rank per session, with the input evaluated once.
    """
    w = Window.partitionBy(session_col).orderBy(F.col(name_col).desc())
    return df.withColumn("driver_row", (F.dense_rank().over(w) - 1).cast("int"))


def latest_event(schedule: DataFrame, today) -> DataFrame:
    """L3: per year, the last event dated on or before ``today`` (a year with none has no row).

    ``max_by`` is an aggregate, so this is partial + final aggregation with
    no window; ties on the date keep the greatest event name.
    """
    past = past_events(schedule, today)
    return past.groupBy("year").agg(
        F.max_by(F.col("event_name"), F.struct("event_date", "event_name")).alias("event_name"),
        F.max("event_date").alias("event_date"),
    )

"""The physical-plan properties the README claims, checked on the formatted plan."""

import contextlib
import io
import re

from pitlane.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def tree(p: str) -> str:
    """The operator tree at the top of a formatted plan (details follow a blank line)."""
    return p.split("\n\n", 1)[0]


def test_flagship_broadcasts_dimensions_and_prunes_the_scan(spark):
    p = plan(QUERIES["va4_driver_avg_laptime"](spark, SF))
    assert tree(p).count("BroadcastHashJoin") == 2
    assert "SortMergeJoin" not in p
    assert "ReadSchema: struct<session_id:int,driver_id:int,lap_time_ms:int>" in p
    assert "EqualTo(session_type,Race)" in p          # the filter reaches the sessions scan
    assert tree(p).count("+- Exchange (") == 1        # only the aggregate shuffles


WINDOW_PARTITION = re.compile(r"Arguments: \[[^\[\]]*windowspecdefinition[^\[\]]*\], \[([^\[\]]*)\]")
WINDOW_SPEC = re.compile(
    r"Arguments: \[[^\[\]]*windowspecdefinition[^\[\]]*\], \[([^\[\]]*)\], \[([^\[\]]*)\]")


def test_gap_lookups_beyond_the_bound_never_window_over_a_lap(spark):
    from pitlane.operators.timing import with_gaps
    from pitlane.sources.fixtures import warehouse

    p = plan(with_gaps(warehouse(spark, SF).raw_laps, max_group_rows=0))
    windows = WINDOW_PARTITION.findall(p)
    assert windows and all("lap_number" not in w and "driver" in w for w in windows)


def test_row_numbers_beyond_the_bound_are_slice_wise(spark):
    from pitlane.operators.ranking import group_row_number
    from pitlane.sources.fixtures import warehouse

    laps = warehouse(spark, SF).laps
    p = plan(group_row_number(laps, ["session_id", "lap_number"], ["driver_id"], max_group_rows=0))
    windows = WINDOW_SPEC.findall(p)
    # Row windows are per slice; the only other one orders the per-slice
    # counts (at most one row per slice for a group).
    assert windows
    for part, order in windows:
        assert "_slice" in part or "_slice" in order, (part, order)


def jobs_of(spark, build) -> int:
    """Spark jobs that run while a query's plan is built, with no remembered sizes."""
    from pitlane.operators.joins import forget_sizes

    forget_sizes()
    tracker, group = spark.sparkContext.statusTracker(), f"plan-{id(build)}"
    spark.sparkContext.setJobGroup(group, "build")
    try:
        build()
        return len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_building_a_plan_runs_few_jobs(spark):
    for name, most in (("s10_ingest_audit", 4), ("vb5_best_laps", 0), ("vb8_pitstops", 0), ("w2_w3_gaps", 2),
                       ("va4_driver_avg_laptime", 0), ("g1_strategy_bars", 0), ("x1_outlier_filter", 0)):
        QUERIES[name](spark, SF)   # the fixture build is not counted
        assert jobs_of(spark, lambda: QUERIES[name](spark, SF)) <= most, name


def test_arg_min_views_scan_the_laps_at_most_twice(spark):
    for name in ("vb5_best_laps", "vb8_pitstops"):
        p = plan(QUERIES[name](spark, SF))
        assert len(re.findall(r"Location: .*/laps\]", p)) <= 2, name


def test_a_micro_batch_prunes_the_landing_by_partition(spark, tmp_path):
    from pitlane.sources.fixtures import warehouse
    from pitlane.streaming.lap_stream import landed_of

    raw = warehouse(spark, SF).raw_laps
    path = str(tmp_path / "landing")
    raw.write.partitionBy("session_id").parquet(path)
    first = raw.select("session_id").orderBy("session_id").first()[0]
    p = plan(landed_of(spark, raw.where(f"session_id = {first}"), path))
    filters = re.findall(r"PartitionFilters: \[(.*)\]", p)
    assert any("session_id" in f and (f"= {first})" in f) for f in filters), filters

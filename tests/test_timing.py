from conftest import rows
from tables import raw
from timing_rows import RAW

from pyspark.sql import functions as F

from pitlane.functions.cleanse import nullable_int, to_ms
from pitlane.operators import timing
from pitlane.schemas import DRIVERS



def _drivers(spark):
    return spark.createDataFrame(
        [(10, "AAA", "Alex", None), (11, "BBB", "Ben", None), (0, "NUL", "Zero", None)], DRIVERS)


def test_to_ms_rounding_and_truncation(spark):
    df = spark.createDataFrame([(v,) for v in [1500, 2500, -1500, -2500, 1499, 1999, -1999, None]], "us long")
    got = [(r[0], r[1], r[2]) for r in df.select("us", to_ms("us"), to_ms("us", "truncate")).collect()]
    assert got == [
        (1500, 2, 1), (2500, 2, 2), (-1500, -2, -1), (-2500, -2, -2),
        (1499, 1, 1), (1999, 2, 1), (-1999, -2, -1), (None, None, None),
    ]


def test_nullable_int_guards_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (3.9,)], "x double")
    assert [r[0] for r in df.select(nullable_int("x")).collect()] == [None, None, 3]


def test_cumulative_skips_untimed_lap_but_keeps_summing(spark):
    got = rows(timing.cumulative_ms(raw(spark, RAW)).where(F.col("driver") == "AAA"), "lap_number", "cum_ms")
    assert got == [(1.0, 90001), (2.0, None), (3.0, 180001)]


def test_gaps_and_intervals(spark):
    g = timing.with_gaps(raw(spark, RAW))
    got = {(r[0], r[1]): (r[2], r[3]) for r in rows(g, "driver", "lap_number", "gap_to_leader_ms", "interval_to_next_ms")}
    # leader of lap 1: AAA and NUL both in P1, AAA is first in the frame
    assert got[("BBB", 1.0)] == (91000 - 90001, 91000 - 92000)   # car ahead is the unknown ZZZ
    assert got[("ZZZ", 1.0)] == (1500, 92000 - 90001)             # provided gap wins (rounded)
    assert got[("BBB", 2.0)] == (None, None)                       # leader AAA has no time on lap 2
    assert got[("AAA", 3.0)] == (180001 - 273000, 180001 - 273000)  # negative gap kept
    assert got[("BBB", 3.0)] == (0, None)                          # the leader: gap 0, no car ahead


def test_normalise_rejects_unknown_codes_and_id_zero(spark):
    laps, rejected = timing.normalise_laps(raw(spark, RAW), _drivers(spark), fill_gaps=True)
    assert sorted({r[0] for r in rejected.select("driver").collect()}) == ["NUL", "ZZZ"]
    assert laps.count() == 6
    # the simple ingest keeps provided gaps only
    simple, _ = timing.normalise_laps(raw(spark, RAW), _drivers(spark), fill_gaps=False)
    assert rows(simple.where(F.col("gap_to_leader_ms").isNotNull())) == []


def test_pit_stops(spark):
    got = rows(timing.normalise_pitstops(raw(spark, RAW), _drivers(spark)))
    assert got == [
        (1, 10, 1, "SOFT", "HARD", 23400),      # pit-out from the next lap; 23400.5 ms rounds to even
        (1, 11, 2, "SOFT", "MEDIUM", -10000),   # own-lap pit-out wins even when earlier
        (1, 11, 3, "MEDIUM", None, None),       # no next lap
    ]


def test_results_do_not_depend_on_partitioning(spark):
    r = raw(spark, RAW)
    a = rows(timing.with_gaps(r))
    b = rows(timing.with_gaps(r.repartition(7)))
    assert a == b


def test_next_lap_bridges_chunk_boundaries(spark):
    r = raw(spark, RAW).select("session_id", "seq", "driver", "lap_number", "compound", "pit_out_us")
    want = rows(timing.next_lap(r, ["compound", "pit_out_us"]))
    for chunk in (1, 2, 3):
        assert rows(timing.next_lap(r, ["compound", "pit_out_us"], chunk=chunk)) == want, chunk
        assert rows(timing.next_lap(r, ["compound", "pit_out_us"], chunk=chunk, max_group_rows=0)) == want, chunk


def test_pitstop_upsert_updates_and_inserts(spark):
    from pitlane.operators.upsert import lookup_ids
    from pitlane.plans.ingest import upsert_pitstops
    from pitlane.schemas import PITSTOPS

    base = spark.createDataFrame([(1, 10, 1, "SOFT", "WET", 1), (1, 10, 9, "HARD", None, None)], PITSTOPS)
    got = rows(upsert_pitstops(base, raw(spark, RAW), _drivers(spark)))
    assert got == [
        (1, 10, 1, "SOFT", "HARD", 23400),     # updated from the landing
        (1, 10, 9, "HARD", None, None),        # untouched
        (1, 11, 2, "SOFT", "MEDIUM", -10000),  # inserted
        (1, 11, 3, "MEDIUM", None, None),
    ]
    ids = lookup_ids(_drivers(spark), spark.createDataFrame([("BBB",)], "driver_code string"), ["driver_code"], "driver_id")
    assert rows(ids) == [("BBB", 11)]


def test_gap_lookups_window_and_join_paths_agree(spark):
    r = raw(spark, RAW + [(1, "QQQ", 1.0, 1.0, "SOFT", 95_000_000, 3.0, None, None, None, None)])  # duplicate P3
    assert rows(timing.with_gaps(r)) == rows(timing.with_gaps(r, max_group_rows=0))


def test_a_repeated_lap_number_takes_the_first_of_the_frame_on_both_paths(spark):
    laps = [
        (1, "AAA", 1.0, 1.0, "SOFT", 1, None, None, None, 100, None),
        (1, "AAA", 2.0, 1.0, None, 1, None, None, None, None, None),       # the first lap 2: no compound
        (1, "AAA", 2.0, 1.0, "HARD", 1, None, None, None, None, 5_100),
        (1, "AAA", 2.0, 1.0, "HARD", 1, None, None, None, None, 5_100),    # repeated row
    ]
    r = raw(spark, laps)
    for df in (r, r.repartition(3)):
        for bound in (10**6, 0):
            got = rows(timing.pit_stops(df, max_group_rows=bound), "driver", "lap_number", "compound_out", "stop_time_ms")
            assert got == [("AAA", 1, None, None)], bound


def test_duplicate_positions_take_the_first_of_the_frame_on_both_paths(spark):
    laps = [
        (1, "ZZZ", 1.0, 1.0, "SOFT", 90_000_000, 1.0, None, None, None, None),   # in P1 and first in the frame
        (1, "AAA", 1.0, 1.0, "SOFT", 95_000_000, 1.0, None, None, None, None),
        (1, "BBB", 1.0, 1.0, "SOFT", 99_000_000, 2.0, None, None, None, None),
    ]
    for bound in (10**6, 0):
        got = rows(timing.with_gaps(raw(spark, laps), max_group_rows=bound), "driver", "gap_to_leader_ms", "interval_to_next_ms")
        assert got == [("AAA", 5000, None), ("BBB", 9000, 9000), ("ZZZ", 0, None)], bound


def test_laps_without_driver_have_no_cumulative_time_and_stay(spark):
    laps = [
        (1, None, 1.0, 1.0, "SOFT", 90_000_000, 1.0, None, None, 7, None),
        (1, None, 2.0, 1.0, "HARD", 90_000_000, 2.0, None, None, None, 9),
        (1, "AAA", 1.0, 1.0, "SOFT", 91_000_000, 3.0, None, None, None, None),
    ]
    for bound in (10**6, 0):
        got = rows(timing.cumulative_ms(raw(spark, laps), max_group_rows=bound), "driver", "lap_number", "cum_ms")
        assert got == [("AAA", 1.0, 91000), (None, 1.0, None), (None, 2.0, None)], bound
        got = rows(timing.pit_stops(raw(spark, laps), max_group_rows=bound), "driver", "compound_out", "stop_time_ms")
        assert got == [(None, None, None)], bound


def test_the_running_sum_follows_the_frame(spark):
    laps = [(1, "AAA", n, 1.0, "SOFT", int(n) * 1_000_000, None, None, None, None, None) for n in (2.0, 1.0)]
    assert rows(timing.cumulative_ms(raw(spark, laps)), "lap_number", "cum_ms") == [(1.0, 3000), (2.0, 2000)]


def test_the_last_row_of_the_frame_wins_an_upsert(spark):
    from pitlane.plans.ingest import upsert_laps
    from pitlane.schemas import LAPS

    laps = [
        (1, "AAA", 1.0, 1.0, "SOFT", 99_000_000, 1.0, None, None, None, None),
        (1, "AAA", 1.0, 2.0, None, None, None, None, None, None, None),   # later in the frame, smaller values
    ]
    base = spark.createDataFrame([], LAPS)
    for path in ({}, {"max_broadcast_bytes": 0}):
        got = rows(upsert_laps(base, raw(spark, laps), _drivers(spark), **path), "lap_number", "stint_id", "compound")
        assert got == [(1, 2, None)]

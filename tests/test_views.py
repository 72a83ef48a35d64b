from conftest import rows
from tables import tables

from pitlane.plans import views


def test_va4_groups_homonyms_and_ignores_other_session_types(spark):
    laps, drivers, sessions = tables(spark)
    got = rows(views.driver_avg_laptime(laps, drivers, sessions), "full_name", "session_id", "avg_lap_time_ms")
    assert got == [
        ("Alex Able", 1, 91200.0),
        ("Dee Untimed", 1, None),
        ("Sam Same", 1, (95000 + 94000 + 96000 + 97000) / 4),
    ]


def test_va2_driver_without_times_gets_null_row(spark):
    laps, drivers, sessions = tables(spark)
    got = dict(rows(views.best_laps(laps, drivers, sessions), "full_name", "best_lap_ms"))
    assert got == {"Alex Able": 90000, "Sam Same": 94000, "Dee Untimed": None}


def test_va5_lapless_session_counts_one_lap(spark):
    laps, _, sessions = tables(spark)
    got = rows(views.session_summary(laps, sessions))
    assert got == [(1, 2024, "Bahrain", 4, 10), (3, 2024, "Jeddah", 0, 1)]


def test_va6_keeps_null_stint_and_untimed_laps(spark):
    laps, drivers, sessions = tables(spark)
    got = rows(views.stint_summary(laps, drivers, sessions), "full_name", "stint_id", "compound", "laps_in_stint")
    assert ("Alex Able", None, None, 1) in got
    assert ("Dee Untimed", 1, "WET", 1) in got


def test_va7_one_lap_stint_has_null_slope(spark):
    laps, drivers, sessions = tables(spark)
    got = {(r[0], r[1], r[2]): r[3] for r in rows(
        views.tyre_degradation(laps, drivers, sessions), "full_name", "stint_id", "compound", "degradation_ms_per_lap")}
    assert got[("Sam Same", 1, "SOFT")] is None
    assert got[("Alex Able", 2, "HARD")] == 2000.0
    assert got[("Sam Same", 1, "MEDIUM")] == 1000.0  # range over range: never negative


def test_vb3_drops_null_stints_vb4_keeps_them(spark):
    laps, drivers, sessions = tables(spark)
    vb3 = rows(views.v_stint_summary(laps, drivers, sessions), "driver", "stint_id")
    vb4 = rows(views.v_tyre_degradation(laps, drivers, sessions), "driver", "stint_id")
    assert ("Alex Able", None) not in vb3
    assert ("Alex Able", None) in vb4
    assert ("Dee Untimed", 1) not in vb4  # no timed lap


def test_vb5_keeps_ties_and_separates_homonyms(spark):
    laps, drivers, sessions = tables(spark)
    got = rows(views.v_best_laps(laps, drivers, sessions), "driver", "best_lap_time_ms", "best_lap_compound", "best_lap_number")
    assert got == [
        ("Alex Able", 90000, "HARD", 3),
        ("Alex Able", 90000, "SOFT", 2),
        ("Sam Same", 94000, "MEDIUM", 2),
        ("Sam Same", 96000, "SOFT", 1),
    ]


def test_vb8_first_lap_of_every_stint(spark):
    laps, drivers, sessions = tables(spark)
    got = rows(views.v_pitstops(laps, drivers, sessions), "driver", "stint_id", "pit_lap", "new_compound")
    assert got == [
        ("Alex Able", 1, 1, "SOFT"),
        ("Alex Able", 2, 3, "HARD"),
        ("Dee Untimed", 1, 1, "WET"),
        ("Sam Same", 1, 1, "MEDIUM"),
        ("Sam Same", 1, 1, "SOFT"),
        ("Sam Same", 2, 2, None),
    ]


def test_vb_rounding_is_half_up_on_the_decimal_mean(spark):
    from pitlane.schemas import DRIVERS, LAPS, SESSIONS
    laps = spark.createDataFrame(
        [(1, 1, n, 1, "SOFT", t, None, None, None, 1, None, None) for n, t in enumerate([1, 1, 1, 1, 1, 1, 1, 2], 1)],
        LAPS)  # mean 1.125 -> 1.13
    drivers = spark.createDataFrame([(1, "A", "A", None)], DRIVERS)
    sessions = spark.createDataFrame([(1, 2024, "X", "Race", 8, "{}", 0)], SESSIONS)
    assert rows(views.v_session_summary(laps, drivers, sessions), "avg_lap_time_ms") == [(1.13,)]


def test_session_type_is_a_parameter(spark):
    laps, drivers, sessions = tables(spark)
    got = rows(views.driver_avg_laptime(laps, drivers, sessions, session_type="Qualifying"), "full_name", "avg_lap_time_ms")
    assert got == [("Alex Able", 80000.0)]

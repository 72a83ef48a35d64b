"""Hand-made warehouse tables for the traps of SURVEY §A (few rows, literal values)."""

from pitlane.schemas import DRIVERS, LAPS, RAW_LAPS, SESSIONS

SESS = [
    # session_id, year, track, session_type, total_laps, weather, safety_car_count
    (1, 2024, "Bahrain", "Race", 5, "{}", 0),
    (2, 2024, "Bahrain", "Qualifying", 3, "{}", 0),
    (3, 2024, "Jeddah", "Race", 4, "{}", 0),   # no laps at all
    (4, 2024, "Monaco", "race", 3, "{}", 0),   # case variant: not a Race
]
DRV = [
    (10, "AAA", "Alex Able", "Red"),
    (11, "BBB", "Sam Same", "Blue"),
    (12, "CCC", "Sam Same", None),    # homonym of 11
    (13, "DDD", "Dee Untimed", "Red"),
]
LAP_COLS = LAPS.fieldNames()


def lap(s, d, n, stint, comp, t, pos=None, gap=None, ivl=None):
    sec = None if t is None else t // 4
    return (s, d, n, stint, comp, t, sec, sec, sec, pos, gap, ivl)


LAPS_ROWS = [
    # driver 10: tie on best lap (90000 twice), NULL stint on lap 5
    lap(1, 10, 1, 1, "SOFT", 91000, 1, 0, None),
    lap(1, 10, 2, 1, "SOFT", 90000, 1, 0, None),
    lap(1, 10, 3, 2, "HARD", 90000, 2, 500, 500),
    lap(1, 10, 4, 2, "HARD", 92000, 1, 0, None),
    lap(1, 10, 5, None, None, 93000, 1, 0, None),
    # driver 11 and 12 share a name
    lap(1, 11, 1, 1, "MEDIUM", 95000, 2, 4000, 4000),
    lap(1, 11, 2, 1, "MEDIUM", 94000, 2, 8000, 8000),
    lap(1, 12, 1, 1, "SOFT", 96000, 3, None, None),   # one-lap stint
    lap(1, 12, 2, 2, None, 97000, 3, 9000, 1000),     # NULL compound
    # driver 13: a Race with no timed lap
    lap(1, 13, 1, 1, "WET", None, 4, None, None),
    # qualifying and the lower-case session are not Race
    lap(2, 10, 1, 1, "SOFT", 80000, 1, 0, None),
    lap(4, 10, 1, 1, "SOFT", 70000, 1, 0, None),
]


def tables(spark):
    return (
        spark.createDataFrame(LAPS_ROWS, LAPS),
        spark.createDataFrame(DRV, DRIVERS),
        spark.createDataFrame(SESS, SESSIONS),
    )


def raw(spark, rows):
    """Raw laps in frame order: (session_id, driver, lap, stint, compound, lap_us, pos, gap_us, ivl_us, pit_in_us,
    pit_out_us)."""
    full = [
        (s, k, d, n, st, c, t, None if t is None else t // 4, None, None, p, g, i, pi, po)
        for k, (s, d, n, st, c, t, p, g, i, pi, po) in enumerate(rows)
    ]
    return spark.createDataFrame(full, RAW_LAPS)

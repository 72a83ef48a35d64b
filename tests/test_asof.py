"""As-of join, overlap of intervals, and the plans over them, against plain Python."""

import random

import pytest
from conftest import rows

from pyspark.sql import functions as F

from pitlane.operators.asof import asof_join, overlap_count, overlap_join
from pitlane.plans import race
from pitlane.schemas import RAW_LAPS, WEATHER

ROWS, SAMPLES = "k int, t long, n int", "k int, at long, v string, seq int"


def last_before(left, samples):
    out = []
    for k, t, n in left:
        fit = [s for s in samples if k is not None and t is not None and s[0] == k and s[1] is not None and s[1] <= t]
        best = max(fit, key=lambda s: (s[1], s[3])) if fit else (None,) * 4
        out.append((k, t, n, *best[1:]))
    return out


def some_rows(r, n, keys=(1, 2, None)):
    return [(r.choice(keys), r.choice([None, r.randint(-50, 400)]) if r.random() < 0.1 else r.randint(-50, 400), r.randint(0, 2)) for _ in range(n)]


def some_samples(r, n, keys=(1, 2, 3, None)):
    return [(r.choice(keys), None if r.random() < 0.1 else r.randint(0, 39) * 10, r.choice(["a", "b", None]), k) for k in range(n)]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("path", [{}, {"max_group_rows": 3}])
def test_asof_equals_a_search(spark, seed, path):
    r = random.Random(seed)
    left, samples = some_rows(r, 120), some_samples(r, r.choice([0, 3, 60]))
    got = asof_join(spark.createDataFrame(left, ROWS), spark.createDataFrame(samples, SAMPLES), ["k"], "t", "at", 25, tie=["seq"], **path)
    assert got.columns == ["k", "t", "n", "at", "v", "seq"]
    key = lambda x: tuple((v is None, v if v is not None else 0) for v in x)
    assert rows(got) == sorted(last_before(left, samples), key=key)


def test_asof_edges(spark):
    left = [(1, 9, 0), (1, 10, 0), (1, 10, 0), (1, 99, 0), (1, 10_000, 0), (2, 5, 0), (None, 50, 0), (1, None, 0)]
    samples = [(1, 10, "first", 1), (1, 10, "second", 2), (1, 98, None, 3), (None, 0, "no key", 4), (1, None, "no time", 5)]
    got = asof_join(spark.createDataFrame(left, ROWS), spark.createDataFrame(samples, SAMPLES), ["k"], "t", "at", 20, tie=["seq"])
    assert rows(got, "k", "t", "v", "seq") == [
        (1, 9, None, None),  # before the first sample
        (1, 10, "second", 2), (1, 10, "second", 2),  # at it; of equal times the last; repeated rows stay
        (1, 99, None, 3),  # a sample without a value is a sample
        (1, 10_000, None, 3),  # carried over many empty buckets
        (1, None, None, None), (2, 5, None, None), (None, 50, None, None),
    ]


def test_asof_refuses_equal_names_and_takes_empty_sides(spark):
    left, samples = spark.createDataFrame([(1, 9, 0)], ROWS), spark.createDataFrame([], SAMPLES)
    with pytest.raises(ValueError, match="both sides"):
        asof_join(left, samples.withColumnRenamed("v", "n"), ["k"], "t", "at", 20)
    assert rows(asof_join(left, samples, ["k"], "t", "at", 20)) == [(1, 9, 0, None, None, None)]
    assert asof_join(left.limit(0), samples, ["k"], "t", "at", 20).count() == 0


def test_no_window_is_by_key_alone_and_no_product(spark):
    left, samples = spark.createDataFrame(some_rows(random.Random(1), 20), ROWS), spark.createDataFrame(some_samples(random.Random(1), 20), SAMPLES)
    plan = asof_join(left, samples, ["k"], "t", "at", 25)._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in plan.splitlines() if "Window [" in x]
    assert len(windows) == 2 and all("_bucket" in w for w in windows)
    spans = spark.createDataFrame([(1, 0, 5)], "k int, a long, b long")
    pairs = overlap_join(spans, spans.toDF("k2", "a2", "b2"), [("k", "k2")], ("a", "b"), ("a2", "b2"), 10)
    assert "Cartesian" not in pairs._jdf.queryExecution().executedPlan().toString()


def some_spans(r, n):
    out = []
    for i in range(n):
        a = r.choice([r.randint(-100, 300), r.randint(0, 10**9)])
        out.append((r.choice([1, 1, 2, None]), a, a + r.choice([-3, 0, 1, 7, 40, 300, 5000, 10**6, 10**9]), i))
    out += [(1, None, 5, n), (1, 5, None, n + 1)]
    return out


def overlaps(x, y):
    return None not in x[:3] and None not in y[:3] and x[0] == y[0] and x[1] < x[2] and y[1] < y[2] and x[1] < y[2] and y[1] < x[2]


@pytest.mark.parametrize("seed", range(4))
def test_overlap_join_equals_all_pairs(spark, seed):
    r = random.Random(seed)
    a, b = some_spans(r, 80), some_spans(r, 80)
    left, right = spark.createDataFrame(a, "k int, s long, e long, i int"), spark.createDataFrame(b, "k2 int, s2 long, e2 long, i2 int")
    got = overlap_join(left, right, [("k", "k2")], ("s", "e"), ("s2", "e2"), 10)
    assert rows(got, "i", "i2") == sorted((x[3], y[3]) for x in a for y in b if overlaps(x, y))


def test_an_interval_of_any_length_makes_few_pieces(spark):
    from pitlane.operators.asof import LEVELS, MAX_BINS, _levels

    spans = spark.createDataFrame([(0, 10**k) for k in range(1, 12)], "s long, e long")
    assert spans.select(F.max(F.size(_levels(F.col("s"), F.col("e"), 10)))).first()[0] <= MAX_BINS * LEVELS


@pytest.mark.parametrize("seed", range(3))
def test_overlap_count_equals_all_pairs(spark, seed):
    a = some_spans(random.Random(seed), 100)
    got = overlap_count(spark.createDataFrame(a, "k int, s long, e long, i int"), ["k"], "s", "e", 50)
    want = [(x[3], sum(overlaps(x, y) for y in a) - 1 if overlaps(x, x) else None) for x in a]
    assert rows(got, "i", "overlaps") == sorted(want)


def lap(session, driver, n, time_us, position=None, pit_in=None, pit_out=None):
    row = dict.fromkeys(RAW_LAPS.fieldNames())
    return row | {"session_id": session, "seq": n * 100, "driver": driver, "lap_number": float(n), "lap_time_us": time_us, "position": position, "pit_in_us": pit_in, "pit_out_us": pit_out}


def raw_of(spark, laps):
    return spark.createDataFrame([tuple(x.values()) for x in laps], RAW_LAPS)


def test_weather_of_hand_made_laps(spark):
    laps = [lap(1, "A", 1, 90_000_000), lap(1, "A", 2, None), lap(1, "A", 3, 90_000_000), lap(2, "A", 1, 90_000_000), lap(1, "B", 1, 79_999_600)]
    weather = [(1, 80_000, 1, 20.0, False, 3), (1, 180_000, 2, 21.0, False, 4), (1, 180_000, 3, 22.0, True, 5), (1, None, 9, 0.0, True, 0)]
    got = race.enrich_weather(raw_of(spark, laps), spark.createDataFrame(weather, WEATHER))
    assert rows(got, "session_id", "driver", "lap_number", "cum_ms", "at_ms", "track_temp", "rainfall") == [
        (1, "A", 1.0, 90_000, 80_000, 20.0, False),
        (1, "A", 2.0, None, None, None, None),  # no time
        (1, "A", 3.0, 180_000, 180_000, 22.0, True),  # the later of two samples, at the very end of the lap
        (1, "B", 1.0, 80_000, 80_000, 20.0, False),  # rounded as W1 rounds
        (2, "A", 1.0, 90_000, None, None, None),  # a session without samples
    ]


def test_battles_of_hand_made_stops(spark):
    laps = []
    # B, behind A, stops a lap earlier and is ahead afterwards; C stops alone; D's stop has no end.
    for driver, stop, place in (("A", 2, 1.0), ("B", 1, 2.0), ("C", 9, 3.0), ("D", 1, 3.0)):
        for n in range(1, 5):
            after = {"A": 2.0, "B": 1.0}.get(driver, place)
            laps.append(lap(1, driver, n, 20_000_000, place if n <= 2 else after, pit_in=1_000 if n == stop else None,
                            pit_out=25_001_000 if n == stop and driver != "D" else None))
    got = race.pit_battles(raw_of(spark, laps))
    assert [tuple(r) for r in got.collect()] == [(1, 1, "B", 1, "A", 2, "undercut", 5_000, True)]
    traffic = race.pit_traffic(raw_of(spark, laps))
    assert rows(traffic, "driver", "from_ms", "to_ms", "others") == [("A", 40_000, 65_000, 1), ("B", 20_000, 45_000, 1), ("D", 20_000, None, None)]

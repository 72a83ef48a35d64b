"""X4 timing from state: equals the batch timing (N2) after any order of arrival, restarts and redeliveries."""

import random

import pandas as pd
import pytest
from conftest import rows

from pyspark.sql import functions as F

from pitlane.operators.timing import normalise_laps
from pitlane.schemas import DRIVERS, RAW_LAPS
from pitlane.streaming import live_timing as L

NAMES = RAW_LAPS.fieldNames()


def raw_lap(session, driver, seq, lap, us, position=None, **more):
    row = dict.fromkeys(NAMES) | {"session_id": session, "seq": seq, "driver": driver, "lap_number": lap, "lap_time_us": us, "position": position}
    return tuple((row | more)[c] for c in NAMES)


def some_laps(seed):
    r = random.Random(seed)
    out = []
    for session in (1, 2):
        for d in range(5):
            for lap in range(1, 8):
                number = r.choice([float(lap)] * 8 + [None, float("nan"), float(max(1, lap - 1))])
                us = r.choice([None] + [80_000_000 + r.randint(0, 10**7)] * 6)
                position = r.choice([None, float("nan"), float(d + 1), float(d + 1), float(r.randint(1, 5))])
                out.append(raw_lap(session, r.choice([f"D{d}"] * 9 + ["unknown"]), d * 100 + lap, number, us, position,
                                   gap_to_leader_us=r.choice([None, None, 1500]), interval_to_ahead_us=r.choice([None, None, 2500]), compound="SOFT"))
    seen = {}
    for x in out:  # a car's place in the frame is its row
        seen[x[0], x[2], x[1]] = x
    return list(seen.values())


@pytest.fixture(scope="module")
def drivers(spark):
    return spark.createDataFrame([(d + 1, f"D{d}", f"Driver {d}", None) for d in range(5)], DRIVERS)


def drained(spark, tmp_path, drivers, *landings, **options):
    for k, laps in enumerate(landings):
        spark.createDataFrame(laps, RAW_LAPS).repartition(2, "seq").write.mode("append").parquet(f"{tmp_path}/in")
        L.stream_timing(spark, f"{tmp_path}/in", drivers, f"{tmp_path}/log", f"{tmp_path}/ckpt", state_partitions=2, **options).awaitTermination()
    return L.latest(spark, f"{tmp_path}/log")


def key(x):
    return tuple((v is None, v if v is not None else 0) for v in x)


def batch(spark, laps, drivers):
    want, _ = normalise_laps(spark.createDataFrame(laps, RAW_LAPS), drivers, fill_gaps=True, keep_seq=True)
    return want


@pytest.mark.parametrize("seed", range(2))
def test_equals_batch_timing_out_of_order_and_after_restarts(spark, tmp_path, drivers, seed):
    laps = some_laps(seed)
    random.Random(seed).shuffle(laps)
    got = drained(spark, tmp_path, drivers, laps[:20], laps[20:], max_files=1)
    want = batch(spark, laps, drivers)
    assert rows(got.select(want.columns)) == rows(want) and len(rows(want)) > 40


@pytest.mark.parametrize("seed", range(2))
def test_a_lap_dealt_to_many_states_equals_batch_timing(spark, tmp_path, drivers, monkeypatch, seed):
    monkeypatch.setattr(L, "BLOCK_PLACES", 1)  # every car has the one ahead in another state
    laps = some_laps(seed)
    moved = [tuple({"position": (x[NAMES.index("position")] or 0.0) % 5 + 1, "lap_time_us": 70_000_000}.get(c, v) for c, v in zip(NAMES, x)) for x in laps[::3]]
    want = list(({(x[0], x[2], x[1]): x for x in laps} | {(x[0], x[2], x[1]): x for x in moved}).values())
    random.Random(seed).shuffle(laps)
    got = drained(spark, tmp_path, drivers, laps[:25], laps[25:], moved, place_buckets=3)
    want = batch(spark, want, drivers)
    assert rows(got.select(want.columns)) == rows(want) and len(rows(want)) > 40


def test_the_cars_of_a_lap_are_spread_over_states(spark):
    cars = spark.createDataFrame([(1, f"D{p}", p, f"1.0@{float(p)}" if p % 9 else "1.0@", 5, "{}", False) for p in range(1, 4001)], L._SUMS)
    held = {r.place: (r.n, r.own) for r in L.placed(cars, 8).groupBy("place").agg(F.count("*").alias("n"), F.count_if("own").alias("own")).collect()}
    assert len(held) == 8 and sum(own for _, own in held.values()) == 4000 and max(n for n, _ in held.values()) < 700


def test_redelivered_and_changed_laps_replace_themselves(spark, tmp_path, drivers):
    laps = some_laps(7)
    by_key = {(x[0], x[2], x[1]): x for x in laps}
    again = laps[:10]
    changed = [tuple(v if c not in ("lap_time_us", "lap_number") else (70_000_000 if c == "lap_time_us" else 6.0) for c, v in zip(NAMES, x)) for x in laps[10:20]]
    by_key |= {(x[0], x[2], x[1]): x for x in changed}
    got = drained(spark, tmp_path, drivers, laps, again, changed)
    want = batch(spark, list(by_key.values()), drivers)
    assert rows(got.select(want.columns)) == rows(want)
    log = spark.read.parquet(f"{tmp_path}/log")
    assert log.where("batch = 1").count() == 0  # the same rows again change nothing


def test_a_late_lap_touches_only_rows_it_changes(spark, tmp_path, drivers):
    laps = [raw_lap(s, f"D{d}", d * 100 + n, float(n), 90_000_000, float(d + 1)) for s in (1, 2) for d in range(3) for n in (1, 2, 3)]
    late = [x for x in laps if x[0] == 1 and x[2] == "D1" and x[3] == 2.0]
    first = [x for x in laps if x not in late]
    drained(spark, tmp_path, drivers, first, late)
    touched = {(r.session_id, r.driver_id, r.lap_number) for r in spark.read.parquet(f"{tmp_path}/log").where("batch = 1").collect()}
    # its own lap and the next, and the car behind on both
    assert touched == {(1, 2, 2), (1, 2, 3), (1, 3, 2), (1, 3, 3)}


def test_compacted_log_holds_the_newest_versions(spark, tmp_path, drivers):
    laps = some_laps(3)
    got = rows(drained(spark, tmp_path, drivers, laps[:30], laps[30:]))
    L.compact(spark, f"{tmp_path}/log", f"{tmp_path}/small", 1)
    assert rows(L.latest(spark, f"{tmp_path}/small")) == got
    assert spark.read.parquet(f"{tmp_path}/small").count() == len(got)


def test_settings_are_back_after_the_start(spark, tmp_path, drivers):
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    drained(spark, tmp_path, drivers, some_laps(1)[:3])
    assert before == (spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.streaming.stateStore.providerClass"))


@pytest.mark.parametrize("us", [None, 0, 499, 500, 501, 1500, 2500, -500, -1500, 2**52 + 500])
def test_milliseconds_are_rounded_half_to_even(spark, us):
    from pitlane.functions.cleanse import to_ms

    assert L.half_even_ms(us) == spark.createDataFrame([(us,)], "us long").select(to_ms("us")).first()[0]


def test_frames_keep_whole_numbers_beside_nulls():
    frame = L._frame([(1, "a", 2**53 + 1, "k", None, None, False)], L._SUMS)
    assert frame["seq"][0] == 2**53 + 1 and frame["cum_ms"][0] is pd.NA
    assert L.running_sums({3: ("c", 2_500), 1: ("a", 1_000), 2: ("b", None)}) == {1: 1, 2: None, 3: 4}


def test_rows_without_identity_are_left_out(spark, tmp_path, drivers):
    laps = [raw_lap(1, "D1", None, 1.0, 1), raw_lap(1, None, 5, 1.0, 1), raw_lap(1, "D1", 6, 1.0, 90_000_000)]
    got = drained(spark, tmp_path, drivers, laps)
    assert rows(got, "session_id", "driver_id", "lap_number", "seq") == [(1, 2, 1, 6)]

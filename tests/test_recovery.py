"""Ingest that is cut off or meets bad input: no dimension is lost, no session added twice, no error taken for an empty table."""

import os
import shutil

import pytest
from conftest import rows
from test_ingest import RESULTS, landed, state
from timing_rows import RAW

from pyspark.sql import functions as F

from pitlane.operators.upsert import dedupe_last, read_table, upsert
from pitlane.plans import ingest
from pitlane.schemas import DRIVERS, LANDED_LAPS, LAPS, RAW_RESULTS
from pitlane.sources.landing import recover_table, replace_table


def drivers(spark, *names):
    return spark.createDataFrame([(k, n, n, None) for k, n in enumerate(names, 1)], DRIVERS)


def names(spark, root):
    return [r.driver_code for r in spark.read.parquet(f"{root}/drivers").orderBy("driver_id").collect()]


def test_a_replaced_table_is_the_old_or_the_new_one_wherever_a_run_ends(spark, tmp_path):
    root = str(tmp_path)
    replace_table(spark, drivers(spark, "A"), root, "drivers")
    replace_table(spark, spark.read.parquet(f"{root}/drivers").unionAll(drivers(spark, "B").withColumn("driver_id", F.lit(2))), root, "drivers")
    assert names(spark, root) == ["A", "B"] and os.listdir(f"{root}/_next") == []

    def new(whole=True):
        drivers(spark, "C").write.mode("overwrite").parquet(f"{root}/_next/drivers")
        if not whole:
            os.remove(f"{root}/_next/drivers/_SUCCESS")

    def put_away():
        os.makedirs(f"{root}/_previous", exist_ok=True)
        shutil.copytree(f"{root}/drivers", f"{root}/_previous/drivers")

    new(whole=False)  # ends while it writes
    recover_table(spark, root, "drivers")
    assert names(spark, root) == ["A", "B"]
    new()  # ends before the move
    recover_table(spark, root, "drivers")
    assert names(spark, root) == ["A", "B"]
    new()
    os.makedirs(f"{root}/_previous", exist_ok=True)
    os.rename(f"{root}/drivers", f"{root}/_previous/drivers")  # ends between both moves
    recover_table(spark, root, "drivers")
    assert names(spark, root) == ["C"]
    put_away()  # ends before the old one is deleted
    recover_table(spark, root, "drivers")
    assert names(spark, root) == ["C"] and os.listdir(f"{root}/_previous") == []
    os.makedirs(f"{root}/_previous", exist_ok=True)
    os.rename(f"{root}/drivers", f"{root}/_previous/drivers")
    new(whole=False)
    recover_table(spark, root, "drivers")
    assert names(spark, root) == ["C"]
    recover_table(spark, root, "never_there")


def test_an_ingest_after_a_cut_off_one_keeps_the_ids(spark, tmp_path):
    root = str(tmp_path / "wh")
    laps = [r for r in RAW if r[1] in ("AAA", "BBB")]
    results = spark.createDataFrame(RESULTS, RAW_RESULTS)
    ingest.run_ingest(spark, landed(spark, laps), results, root)
    once = state(spark, root)
    os.makedirs(f"{root}/_previous", exist_ok=True)
    os.rename(f"{root}/drivers", f"{root}/_previous/drivers")  # the driver was lost here
    ingest.run_ingest(spark, landed(spark, laps), results, root)
    assert state(spark, root) == once


def test_laps_of_no_session_are_rejected_with_a_count_and_replays_change_nothing(spark, tmp_path):
    root = str(tmp_path / "wh")
    laps = [r for r in RAW if r[1] in ("AAA", "BBB")]
    results = spark.createDataFrame(RESULTS, RAW_RESULTS)
    good = landed(spark, laps)
    nullable = [(*r,) for r in good.limit(1).collect()]
    cols = LANDED_LAPS.fieldNames()
    bad = [tuple(None if c == gone else v for c, v in zip(cols, nullable[0])) for gone in ("year", "session_name", "event_name")]
    loose = spark.createDataFrame(bad, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in LANDED_LAPS.fields))
    both = good.unionAll(loose)
    audit = ingest.run_ingest(spark, both, results, root)
    assert [tuple(r) for r in audit.where("session_id IS NULL").collect()] == [(None, 3, 0, 0, 0)]
    once = state(spark, root)
    assert len(once[2]) == 1
    ingest.run_ingest(spark, both, results, root)
    assert state(spark, root) == once
    assert ingest.unidentified(both).count() == 3 and ingest.identified(both).count() == good.count()


def test_only_an_absent_folder_is_an_empty_table(spark, tmp_path):
    assert read_table(spark, str(tmp_path / "absent"), LAPS).count() == 0
    (tmp_path / "bare").mkdir()
    assert read_table(spark, str(tmp_path / "bare"), LAPS).count() == 0
    for folder in ("session_id=1", "year=2024/session_id=2"):  # two layouts in one table
        (tmp_path / "mixed" / folder).mkdir(parents=True)
        (tmp_path / "mixed" / folder / "part-0.parquet").write_bytes(b"PAR1")
    with pytest.raises(Exception):
        read_table(spark, str(tmp_path / "mixed"), LAPS).count()


@pytest.mark.parametrize("path", [{}, {"max_broadcast_bytes": 0}])
def test_rows_without_a_key_come_as_often_as_they_came(spark, path):
    rows_in = [(None, 1), (None, 1), (None, 2), (7, 1), (7, 3), (8, None)]
    updates = spark.createDataFrame(rows_in, "k int, v int").repartition(3)
    assert rows(dedupe_last(updates, ["k"], "v")) == sorted([(None, 1), (None, 1), (None, 2), (7, 3), (8, None)], key=lambda t: tuple((x is None, x or 0) for x in t))
    assert rows(dedupe_last(updates.select("k"), ["k"], None)) == [(7,), (8,), (None,), (None,), (None,)]
    base = spark.createDataFrame([(None, 1), (None, 9), (7, 0)], "k int, v int")
    got = upsert(base, updates, ["k"], ["v"], order="v", **path)
    assert rows(got) == [(7, 3), (8, None), (None, 1), (None, 1), (None, 1), (None, 2), (None, 9)]


def test_no_plan_numbers_rows_by_their_place(spark):
    updates = spark.createDataFrame([(None, 1)], "k int, v int").repartition(3)
    plan = dedupe_last(updates, ["k"], "v")._jdf.queryExecution().optimizedPlan().toString()
    assert "monotonically_increasing_id" not in plan

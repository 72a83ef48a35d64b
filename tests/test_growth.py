"""What keeps the shuffles, states and writes of a query in step with its input."""

import os
import time

import pandas as pd
from pyspark.sql import functions as F

from pitlane.operators import asof, timing, upsert
from pitlane import config
from pitlane.plans import ingest, race, refresh, views
from pitlane.sources import fixtures
from pitlane.streaming import live_timing
from pitlane.streaming.settings import state_partitions
from conftest import rows

RAW = "session_id int, driver string, lap_number double, seq long, position double, lap_time_us long, gap_to_leader_us long, interval_to_ahead_us long, pit_in_us long, pit_out_us long, compound string, stint double"


def raw(spark):
    one = lambda d, lap: (1, f"D{d}", float(lap), d * 100 + lap, float(d), 90_000_000, None, None, lap * 90_000_000 if lap == 2 else None, lap * 90_000_000 - 60_000_000 if lap == 3 else None, "SOFT", 1.0)
    return spark.createDataFrame([one(d, lap) for d in (1, 2, 3) for lap in (1, 2, 3)], RAW)


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


class Held:
    """A state of one value."""

    value = None

    def getValueState(self, name, schema):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def test_cars_share_a_state():
    cars = live_timing.CarSums()
    cars.init(Held())
    frame = lambda *r: pd.DataFrame(r, columns=["driver", "seq", "lap_key", "lap_time_us", "payload"])
    first = next(cars.handleInputRows((1, 7), iter([frame(("a", 1, "1.0", 1000, "p"), ("b", 1, "1.0", 2000, "q"))]), None))
    assert sorted(zip(first["driver"], first["cum_ms"])) == [("a", 1), ("b", 2)]
    second = next(cars.handleInputRows((1, 7), iter([frame(("b", 2, "2.0", 3000, "r"))]), None))
    assert list(zip(second["driver"], second["seq"], second["cum_ms"])) == [("b", 2, 5)]


def test_a_large_bucket_copies_no_sample(spark):
    laps = spark.createDataFrame([(1, t) for t in range(40)] + [(2, 5), (None, 1)], "k int, t long")
    samples = spark.createDataFrame([(1, 3, "a"), (1, 3, "b"), (1, 20, "c"), (2, 6, "d")], "k int, at long, v string")
    join = lambda **path: asof.asof_join(laps, samples, ["k"], "t", "at", 1000, **path)
    assert rows(join(max_group_rows=3)) == rows(join())
    assert "explode" not in plan(join(max_group_rows=3))


def test_state_partitions_follow_the_input():
    assert [state_partitions(n, 4) for n in (0, 60_000, 3_600_000)] == [4, 4, 15]


def test_the_mapping_is_sized_by_one_aggregate(spark, monkeypatch):
    def counted(*_):
        raise AssertionError("counted again")

    monkeypatch.setattr("pitlane.operators.ranking.largest_group", counted)
    fixtures.lap_source(spark, "/root/testdata/sf0.001")


def test_stops_are_computed_once(spark):
    assert all("stop-windows" in f for f in race.stop_windows(raw(spark)).inputFiles()), "read from their written rows"
    assert "Window" not in plan(race.stop_windows(raw(spark)))


def test_no_pieces_at_levels_that_no_interval_has(spark):
    spans = spark.createDataFrame([(0, 10)], "s long, e long")
    assert spans.select(F.size(asof._levels(F.col("s"), F.col("e"), 10, [0]))).first()[0] == 1


def test_the_places_of_a_lap_are_summed_once(spark):
    got = timing.with_gaps(raw(spark), max_group_rows=0)
    assert any("/places-" in f for f in got.inputFiles())
    assert rows(got) == rows(timing.with_gaps(raw(spark)))


def test_messages_land_where_they_are_read(spark, tmp_path):
    from pitlane.plans import catalog

    catalog._land(spark.range(100).repartition(6).selectExpr("string(id) key", "'{}' value", "now() timestamp"), f"{tmp_path}/in")
    files = [f for f in os.listdir(f"{tmp_path}/in") if f.startswith("part-")]
    assert len(files) == 6 and all(f.endswith(".json.gz") for f in files)


def test_a_batch_is_deduplicated_with_one_copy_of_its_rows(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (None, 1, "c"), (None, 1, "c")], "k int, o int, v string")
    got = upsert.dedupe_last(df, ["k"], "o")
    assert sorted(rows(got), key=str) == sorted([(1, 2, "b"), (None, 1, "c"), (None, 1, "c")], key=str)
    assert "max_by" not in plan(got)


def disk_files(spark):
    return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().length()


def test_shuffles_are_deleted_with_their_query(spark, tmp_path):
    before, conf = disk_files(spark), spark.conf.get(config.CLEAN_SHUFFLES, None)
    with config.cleaned_shuffles(spark), config.cleaned_shuffles(spark):
        spark.range(10_000).repartition(7, "id").write.parquet(f"{tmp_path}/out")
        for _ in range(50):
            if disk_files(spark) <= before:
                break
            time.sleep(0.1)
        assert disk_files(spark) <= before
    assert spark.conf.get(config.CLEAN_SHUFFLES, None) == conf


def test_partitions_are_merged_range_by_range(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(s, k, f"{s}") for s in (1, 2, 5, 9) for k in range(4)] + [(None, 1, "n")], "session_id int, k int, v string")
    assert [df.where(p).count() for p in upsert.partition_ranges(df, "session_id", 5)] == [5, 8, 4]
    assert [df.where(p).count() for p in upsert.partition_ranges(df, "session_id", 100)] == [17]
    parts = []
    monkeypatch.setattr(upsert, "ROWS_PER_MERGE", 5)
    monkeypatch.setattr(upsert, "materialize", lambda df, label, kept=upsert.materialize: (parts.append(kept(df, label)), parts[-1])[1])
    for v in ("old", "new"):
        batch = df.where("session_id IS NOT NULL").withColumn("v", F.lit(v))
        upsert.upsert_partitions(spark, f"{tmp_path}/t", batch, ["session_id", "k"], ["v"], df.schema, sized_by=batch)
        assert rows(spark.read.parquet(f"{tmp_path}/t").select(df.columns)) == rows(batch)
    folders = {f.rsplit("/", 1)[0].removeprefix("file://") for p in parts for f in p.inputFiles()}
    assert len(folders) == 9 and not any(map(os.path.exists, folders))


def test_an_ingest_leaves_no_copy_of_its_laps(spark, tmp_path, monkeypatch):
    left = []
    monkeypatch.setattr(ingest, "materialize", lambda df, label, kept=ingest.materialize: (left.append((label, kept(df, label))), left[-1][1])[1])
    wh = fixtures.warehouse(spark, "/root/testdata/sf0.001")
    audit = ingest.run_ingest(spark, wh.landed_laps.where("year = 1995"), wh.raw_results, str(tmp_path))
    assert audit.agg(F.sum("laps_found")).first()[0] == wh.landed_laps.where("year = 1995").count()
    copies = [f for label, df in left if label == "ingest-raw-laps" for f in df.inputFiles()]
    assert copies and not any(os.path.exists(f.removeprefix("file://")) for f in copies)


def test_stored_parts_are_written_once_before_their_place(spark, tmp_path, monkeypatch):
    labels = []
    monkeypatch.setattr(refresh, "materialize", lambda df, label, kept=refresh.materialize: (labels.append(label), kept(df, label))[1])
    laps = spark.createDataFrame([(1, 2, 1, "SOFT", 90, 1, 1)], "session_id int, driver_id int, stint_id int, compound string, lap_time_ms int, gap_to_leader_ms int, lap_number int")
    refresh.refresh_partials(spark, str(tmp_path), laps, laps)
    assert labels.count("refresh-lap_partials") == 1


def test_best_laps_are_found_before_names_are_joined(spark):
    laps = spark.createDataFrame([(1, 2, 1, "SOFT", 90)], "session_id int, driver_id int, lap_number int, compound string, lap_time_ms int")
    drivers = spark.createDataFrame([(2, "A")], "driver_id int, full_name string")
    sessions = spark.createDataFrame([(1, 2000, "T", "Race")], "session_id int, year int, track string, session_type string")
    got = views.v_best_laps(laps, drivers, sessions)
    assert "LeftSemi" in plan(got) and rows(got) == [(2000, "T", "Race", "A", 90, "SOFT", 1)]

from conftest import rows

from pyspark.sql import functions as F

from pitlane.operators.timing import normalise_laps
from pitlane.sources.fixtures import warehouse
from pitlane.streaming.lap_stream import stream_laps

SF = "/root/testdata/sf0.001"


def test_stream_ingest_matches_batch_ingest(spark, tmp_path):
    wh = warehouse(spark, SF)
    sessions = [r[0] for r in wh.raw_laps.select("session_id").distinct().orderBy("session_id").limit(3).collect()]
    raw = wh.raw_laps.where(F.col("session_id").isin(sessions))
    landing, table, ckpt = str(tmp_path / "landing"), str(tmp_path / "laps"), str(tmp_path / "ckpt")

    # first the opening laps arrive, then the rest of the race
    raw.where(F.col("lap_number") <= 3).write.partitionBy("session_id").parquet(landing)
    stream_laps(spark, landing, wh.drivers, table, checkpoint=ckpt).awaitTermination()
    first, _ = normalise_laps(raw.where(F.col("lap_number") <= 3), wh.drivers, fill_gaps=True)
    assert rows(spark.read.parquet(table).select(*first.columns)) == rows(first)

    raw.where(F.col("lap_number") > 3).write.mode("append").partitionBy("session_id").parquet(landing)
    stream_laps(spark, landing, wh.drivers, table, checkpoint=ckpt).awaitTermination()
    full, _ = normalise_laps(raw, wh.drivers, fill_gaps=True)
    assert rows(spark.read.parquet(table).select(*full.columns)) == rows(full)


def test_windowed_lap_counts_with_watermark(spark, tmp_path):
    import datetime

    from pitlane.streaming.lap_stream import lap_counts_by_window

    t0 = datetime.datetime(2024, 3, 2, 15, 0, 0)
    rows_in = [(1, 90_000_000 + i, t0 + datetime.timedelta(minutes=3 * i)) for i in range(8)]
    src = str(tmp_path / "events")
    spark.createDataFrame(rows_in, "session_id int, lap_time_us long, ts timestamp").write.parquet(src)
    stream = spark.readStream.schema("session_id int, lap_time_us long, ts timestamp").parquet(src)
    q = (lap_counts_by_window(stream, "ts", "10 minutes").writeStream.outputMode("complete")
         .format("memory").queryName("lap_windows").trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted((r["window"]["start"].minute, r["laps"], r["best_lap_us"]) for r in spark.table("lap_windows").collect())
    assert got == [(0, 4, 90_000_000), (10, 3, 90_000_004), (20, 1, 90_000_007)]


def test_views_run_on_a_stream(spark, tmp_path):
    from pitlane.plans import views

    wh = warehouse(spark, SF)
    src = str(tmp_path / "laps")
    wh.laps.write.parquet(src)
    stream = spark.readStream.schema(wh.laps.schema).parquet(src)
    q = (views.driver_avg_laptime(stream, wh.drivers, wh.sessions).writeStream.outputMode("complete")
         .format("memory").queryName("va4_stream").trigger(availableNow=True).start())
    q.awaitTermination()
    assert rows(spark.table("va4_stream")) == rows(views.driver_avg_laptime(wh.laps, wh.drivers, wh.sessions))


def test_replaying_a_batch_is_idempotent(spark, tmp_path):
    from pitlane.streaming.lap_stream import merge_batch

    wh = warehouse(spark, SF)
    session = wh.raw_laps.select("session_id").orderBy("session_id").first()[0]
    raw = wh.raw_laps.where(F.col("session_id") == session)
    landing, table = str(tmp_path / "landing"), str(tmp_path / "laps")
    raw.write.partitionBy("session_id").parquet(landing)
    merge_batch(spark, raw, landing, wh.drivers, table)
    once = rows(spark.read.parquet(table))
    merge_batch(spark, raw, landing, wh.drivers, table)   # the same micro-batch again, e.g. after a failure
    assert rows(spark.read.parquet(table)) == once


def test_replays_leave_a_session_with_unnumbered_laps_unchanged(spark, tmp_path):
    from pitlane.streaming.lap_stream import merge_batch

    wh = warehouse(spark, SF)
    session = wh.raw_laps.select("session_id").orderBy("session_id").first()[0]
    raw = wh.raw_laps.where(F.col("session_id") == session)
    raw = raw.withColumn("lap_number", F.when(F.col("lap_number") > 2, F.col("lap_number")))   # some NULL
    landing, table = str(tmp_path / "landing"), str(tmp_path / "laps")
    raw.repartition(3).write.partitionBy("session_id").parquet(landing)
    landed = spark.read.schema(raw.schema).parquet(landing)
    seen = []
    for _ in range(3):
        merge_batch(spark, landed, landing, wh.drivers, table)
        seen.append(rows(spark.read.parquet(table)))
    assert seen[0] == seen[1] == seen[2] and any(r[2] is None or r[1] is None for r in seen[0])


def test_file_count_follows_sessions_not_tasks(spark, tmp_path):
    import glob

    from pitlane.operators.upsert import write_partitions

    wh = warehouse(spark, SF)
    table = str(tmp_path / "laps")
    write_partitions(wh.laps.repartition(13), table)
    sessions = wh.laps.select("session_id").distinct().count()
    assert len(glob.glob(f"{table}/session_id=*/*.parquet")) == sessions


def test_intermediates_are_deleted(spark, tmp_path):
    import glob

    from pitlane.config import shared_dir
    from pitlane.streaming.lap_stream import merge_batch

    wh = warehouse(spark, SF)
    session = wh.raw_laps.select("session_id").orderBy("session_id").first()[0]
    raw = wh.raw_laps.where(F.col("session_id") == session)
    landing, table = str(tmp_path / "landing"), str(tmp_path / "laps")
    raw.write.partitionBy("session_id").parquet(landing)
    root = shared_dir(spark).removeprefix("file:")

    def left() -> int:
        return len(glob.glob(f"{root}/pitlane/partition-*"))

    before = left()
    merge_batch(spark, raw, landing, wh.drivers, table)
    assert left() == before

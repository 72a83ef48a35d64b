"""S1 as a data source: the partitions read are the sessions asked for."""

import pytest
from conftest import rows
from tables import raw
from timing_rows import RAW

from pyspark.sql import functions as F

from pitlane.schemas import RAW_LAPS
from pitlane.sources.session_source import read_sessions, session_folders


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("landing") / "laps")
    laps = raw(spark, RAW)
    for s in (2, 3, 10):
        laps = laps.unionAll(raw(spark, RAW).withColumn("session_id", F.lit(s)).select(laps.columns))
    laps = laps.where("session_id IS NOT NULL")
    laps.repartition(3).write.partitionBy("session_id").parquet(path)
    return path, spark.read.schema(RAW_LAPS).parquet(path).select(RAW_LAPS.fieldNames())


@pytest.mark.parametrize("where", [
    "session_id = 2", "session_id IN (2, 3)", "session_id >= 3", "session_id > 3", "session_id < 3", "session_id <= 2", "session_id BETWEEN 2 AND 9",
    "session_id = 2 AND lap_number > 1", "lap_number = 1", "session_id <> 2", "session_id = 77", "session_id IS NULL", "session_id <=> 3",
])
def test_rows_equal_the_table_and_partitions_the_sessions(spark, landing, where):
    path, table = landing
    got, want = read_sessions(spark, path).where(where), table.where(where)
    assert got.columns == RAW_LAPS.fieldNames() and repr(rows(got)) == repr(rows(want))
    if where.startswith("session_id") and "<>" not in where.replace("<=>", "") and "lap" not in where and "NULL" not in where:
        sessions = want.select("session_id").distinct().count()
        assert got.rdd.getNumPartitions() == max(1, sessions)


def test_all_sessions_and_none(spark, landing, tmp_path):
    path, table = landing
    assert read_sessions(spark, path).rdd.getNumPartitions() == len(session_folders(path)) == table.select("session_id").distinct().count()
    assert read_sessions(spark, str(tmp_path / "nothing")).count() == 0


def test_uris_and_foreign_folders(spark, landing, tmp_path):
    path, _ = landing
    assert session_folders(f"file://{path}") == session_folders(f"file:{path}") == session_folders(path)
    for name in ("session_id=x", "other=1", "_temporary"):
        (tmp_path / name).mkdir()
    (tmp_path / "session_id=5").mkdir()
    (tmp_path / "session_id=5" / "_SUCCESS").write_text("")
    assert list(session_folders(str(tmp_path))) == [5] and read_sessions(spark, str(tmp_path)).count() == 0


def test_an_absent_column_is_null(spark, landing, tmp_path):
    _, table = landing
    table.where("session_id = 2").drop("compound").write.partitionBy("session_id").parquet(str(tmp_path / "in"))
    got = read_sessions(spark, str(tmp_path / "in"))
    assert got.where("compound IS NOT NULL").count() == 0 and got.count() == table.where("session_id = 2").count()

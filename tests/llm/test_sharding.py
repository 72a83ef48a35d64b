import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from pitlane.llm import oracles
from pitlane.llm import sharding as S

from .llm_data import data


def model(rows, shards):
    """(row, shard, slot) by one running sum over the sorted rows."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    total, before, seen, out = sum(r[1] for r in rows), 0, {}, []
    for r in rows:
        k = min(shards - 1, (2 * before + r[1]) * shards // (2 * total))
        out.append((*r, k, seen.get(k, 0)))
        seen[k] = seen.get(k, 0) + 1
        before += r[1]
    return out


def frame(spark, rows, parts=5):
    return spark.createDataFrame(rows, "k long, size long").repartition(parts)


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_equals_one_running_sum(spark, shards):
    rows = [(i * 7 % 501, 1 + (i * i) % 97) for i in range(500)] + [(900, 40_000)] + [(None, 3)] * 40
    got = S.balanced_shards(frame(spark, rows), ["k", "size"], shards=shards).collect()
    key = lambda r: (r[0] is not None, *((-1 if x is None else x) for x in r))
    assert sorted(map(tuple, got), key=key) == sorted(model(rows, shards), key=key)


def test_sizes_are_near_equal(spark):
    rows = [(i, 1 + (i * 31) % 1000) for i in range(3000)]
    sums = [r[0] for r in S.balanced_shards(frame(spark, rows), ["k"]).groupBy("shard").agg(F.sum("size")).select("sum(size)").collect()]
    share = sum(s for _, s in rows) / 16
    assert len(sums) == 16 and all(abs(s - share) < 1000 for s in sums)


def test_a_third_equal_rows_is_spread_over_ranges(spark):
    rows = [(None, 1)] * 4000 + [(i, 2) for i in range(2000)]
    df = frame(spark, rows, 4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # this table is small
    try:
        counts = [r["count"] for r in S.in_order(df, ["k", "size"]).groupBy("__shard_part").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(counts) < 2000
    got = S.balanced_shards(df, ["k", "size"], shards=4).groupBy("shard").agg(F.count("*"), F.countDistinct("slot"), F.max("slot")).collect()
    assert sum(r[1] for r in got) == 6000 and all(r[1] == r[2] == r[3] + 1 for r in got)


def test_few_rows_empty_table_and_clashing_columns(spark):
    one = spark.createDataFrame([(1, 5, "old", 7)], "k long, size long, shard string, slot int")
    assert [tuple(r) for r in S.balanced_shards(one, ["k"]).collect()] == [(1, 5, 8, 0)]
    none = S.balanced_shards(one.limit(0), ["k"])
    assert none.collect() == [] and none.columns == ["k", "size", "shard", "slot"]
    clash = one.withColumnsRenamed({"shard": "__shard_rank", "slot": "rows"})
    assert S.balanced_shards(clash, ["k"]).columns == ["k", "size", "rows", "shard", "slot"]


def test_shard_files_hold_every_row(spark, tmp_path):
    rows = [(i, 1 + i % 9) for i in range(300)]
    S.write_shards(S.balanced_shards(frame(spark, rows), ["k"], shards=4), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.k, r.size) for r in back.collect()) == sorted(rows)
    assert {p.name for p in (tmp_path / "out").iterdir() if p.is_dir()} == {f"shard={k}" for k in range(4)}


def test_query_equals_its_sql(spark):
    got = S.op12_byte_shards(spark, "/root/testdata/sf0.01")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{data('sf0.01', 'documents')}'")
    want = con.execute(oracles.OP12)
    names = [c[0] for c in want.description]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall())


def test_edge_documents(edge_docs, spark, tmp_path):
    path = str(tmp_path / "sf")
    edge_docs.write.parquet(f"{path}/documents.parquet")
    got = S.op12_byte_shards(spark, path).collect()
    want = [(r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in edge_docs.collect()]
    assert sorted(map(repr, ((r.doc_id, r.size, r.text_crc32) for r in got))) == sorted(map(repr, want))

"""Sharding: contiguous balanced shards by global prefix sums of byte sizes.

Rows are put in order (ranges dealt to the tasks, sorted within) and written once. Every
partition gives one total, of its rows and of its bytes; the running sum over these totals is
where each partition begins, and a running sum within the partition does the rest. So each row
knows how many bytes stand before it, and the line of all bytes is cut at equal targets: a row
goes to the shard in whose stretch its middle lies. Shards are then runs of the order whose
sizes differ from an even share by less than the largest row, however skewed sizes, keys or
copies are. All of it is DataFrame operations; only ids, sizes and checksums are shuffled.

Defined results: null keys come first; a null text is empty, of size 1; repeated rows are placed
each, one after another; a table smaller than its shards leaves shards empty, an empty table
gives no rows; other columns of the input are carried, former ``shard`` and ``slot`` are replaced.
A row is numbered when it is written, before ranges are dealt, so equal rows stay apart and a
task that is run again deals them alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitlane.config import discard
from pitlane.llm.common import materialize, table

SHARDS = 16

_ROW, _PART, _AT, _BEFORE, _BYTES, _ROWS, _ALL, _RANK = (f"__shard_{x}" for x in ("row", "part", "at", "before", "bytes", "rows", "all", "rank"))
_OWN = {_ROW, _PART, _AT, _BEFORE, _BYTES, _ROWS, _ALL, _RANK, "shard", "slot"}
#: Bits of ``monotonically_increasing_id`` that number the rows of a partition (fixed by Spark).
_ROW_BITS = 33


def in_order(rows: DataFrame, order: list[str]) -> DataFrame:
    """The rows as a written table in global order, with partition and place in the partition."""
    numbered = materialize(rows.drop(*_OWN).withColumn(_ROW, F.monotonically_increasing_id()), "shard-rows")
    keys = [numbered[c].asc_nulls_first() for c in [*order, _ROW]]
    ordered = numbered.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(_ROW)
    place = F.monotonically_increasing_id()
    out = materialize(
        ordered.select("*", F.shiftright(place, _ROW_BITS).alias(_PART), place.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias(_AT)),
        "shard-order",
    )
    discard(numbered)
    return out


def part_starts(ordered: DataFrame, size: str) -> DataFrame:
    """For each partition the rows and bytes before it, and the bytes of all: one row a partition,
    which is what bounds the window below and the broadcast of its result."""
    totals = ordered.groupBy(_PART).agg(F.sum(size).alias(_BYTES), F.count(F.lit(1)).alias(_ROWS))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return totals.select(
        _PART,
        F.coalesce(F.sum(_BYTES).over(before), F.lit(0)).alias(_BYTES),
        F.coalesce(F.sum(_ROWS).over(before), F.lit(0)).alias(_ROWS),
        F.sum(_BYTES).over(everything).alias(_ALL),
    )


def balanced_shards(rows: DataFrame, order: list[str], size: str = "size", shards: int = SHARDS) -> DataFrame:
    """``rows`` with ``shard`` (0 to shards - 1, contiguous in the order, near equal in the sum of
    ``size``, a positive whole number) and ``slot``, the place in the shard from 0."""
    ordered = in_order(rows, order)
    kept = [c for c in rows.columns if c not in _OWN]
    so_far = Window.partitionBy(_PART).orderBy(_AT).rowsBetween(Window.unboundedPreceding, -1)
    before = F.col(_BYTES) + F.coalesce(F.sum(size).over(so_far), F.lit(0))
    placed = ordered.join(F.broadcast(part_starts(ordered, size)), _PART).select(*kept, before.alias(_BEFORE), (F.col(_ROWS) + F.col(_AT)).alias(_RANK), _ALL)
    # The row's middle, and what a shard's even share is, both doubled to stay whole.
    middle, share = f"(2 * {_BEFORE} + `{size}`)", f"(2 * {_ALL})"
    shard = F.expr(f"least({shards - 1}, cast({middle} as decimal(20,0)) * {shards} div cast({share} as decimal(20,0)))").cast("int")
    cut = materialize(placed.select(*kept, _RANK, shard.alias("shard")), "shard-cut")
    discard(ordered)
    firsts = cut.groupBy("shard").agg(F.min(_RANK).alias(_BEFORE))  # as many rows as shards
    return cut.join(F.broadcast(firsts), "shard").select(*kept, "shard", (F.col(_RANK) - F.col(_BEFORE)).alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder a shard; the tasks write what they hold, so no shard waits for one task."""
    sharded.write.partitionBy("shard").parquet(path)


def text_size(docs: DataFrame, text: str = "text"):
    """UTF-8 bytes of the text plus 1; a null text counts as empty."""
    return (F.coalesce(F.octet_length(docs[text].cast("string")), F.lit(0)) + 1).cast("long")


def op12_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, in order of doc_id, in 16 shards of near equal bytes."""
    docs = table(spark, sf_dir, "documents")
    light = docs.select(
        "doc_id", text_size(docs).alias("size"), F.crc32(F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary")).alias("text_crc32")
    )
    out = balanced_shards(light, ["doc_id", "text_crc32", "size"])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

"""Idempotent writes U1-U7: ``INSERT ... ON DUPLICATE KEY UPDATE`` as DataFrame plans.

Plain parquet has no MERGE, so an upsert returns the new table contents:

* updates are deduplicated per key, last wins by an explicit order column
  (an aggregate, ``max_by``: partial + final, so a hot key is combined
  map-side rather than in one task);
* a row with any NULL key never conflicts (a unique index allows repeated
  NULLs), so such rows pass straight through on both sides;
* a matched row takes the update's ``update_cols`` (even NULL, like
  ``col = VALUES(col)``) and keeps every other column from the base row;
  an unmatched update is inserted, filling columns it lacks with defaults.

The deduplicated batch is written once to the shared folder. Two physical
plans, chosen by its written size in bytes (known from the file listing,
without a job): a small batch is broadcast and the base is only scanned
(left join plus a semi-join for the inserted keys, no shuffle of the
base); a large batch uses one full outer join, shuffling both sides by key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitlane.config import cleaned_shuffles, discard, exists, materialize
from pitlane.operators.joins import fits, join_dim

# Largest update batch merged by broadcasting it, in bytes as written (about 100,000 laps).
# A race weekend is a few thousand laps; a bulk re-load takes the shuffle path.
UPSERT_BROADCAST_MAX_BYTES = 2 * 1024 * 1024
# Largest number of new dimension keys ranked in one ordered window.
RANK_MAX_ROWS = 1_000_000


def _any_null(keys: Sequence[str]) -> Column:
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return cond


def _spread(keys: Sequence[str], columns: Sequence[str]) -> Column:
    """0 for a complete key; a hash of the row when any key part is NULL.

    Such rows match nothing; the hash, which a task that is run again gives alike, only keeps
    them out of the one partition that NULL keys map to.
    """
    return F.when(_any_null(keys), F.xxhash64(*columns)).otherwise(F.lit(0).cast("long"))


def dedupe_last(df: DataFrame, keys: Sequence[str], order: str | Column | None) -> DataFrame:
    """One row per complete key, the one with the greatest ``order``; NULL-key rows all kept.

    An aggregate (the greatest of order and row, kept once), so a key with many updates is combined
    map-side. Ties on ``order`` resolve to the greatest full row. A NULL-key
    row is grouped by its whole content and comes as often as it came: nothing
    depends on the order of rows, so a stage that is run again loses or doubles none.
    """
    keys = list(keys)
    cols = [c for c in df.columns if c not in keys]
    loose = _any_null(keys)
    order_col = F.lit(0) if order is None else (F.col(order) if isinstance(order, str) else order)
    row = F.struct(*[F.col(c) for c in cols]) if cols else F.struct(F.lit(0).alias("_nothing"))
    picked = df.withColumns({"_loose": F.when(loose, row), "_by": F.struct(order_col.alias("order"), row.alias("row"))}).groupBy(*keys, "_loose").agg(
        F.max("_by")["row"].alias("_row"), F.count(F.lit(1)).cast("int").alias("_times")
    )
    copies = F.explode(F.array_repeat(F.lit(0), F.when(loose, F.col("_times")).otherwise(1))).alias("_copy")
    return picked.select(*keys, "_row", copies).select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def _conform(updates: DataFrame, columns: Sequence[str], defaults: Mapping[str, object], types) -> DataFrame:
    """``updates`` cast to the base columns; a missing column takes its default (or NULL)."""
    out = [
        (F.col(c) if c in updates.columns else F.lit(defaults.get(c))).cast(types[c]).alias(c)
        for c in columns
    ]
    return updates.select(*out, "_order")


def upsert(
    base: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    order: str | Column | None = None,
    defaults: Mapping[str, object] | None = None,
    max_broadcast_bytes: int = UPSERT_BROADCAST_MAX_BYTES,
) -> DataFrame:
    """The base table after upserting ``updates`` on ``keys``.

    ``update_cols`` empty gives INSERT IGNORE (U3). ``order`` (a column of
    ``updates``) picks the last of several updates to one key. ``defaults``
    fills base columns an inserted row lacks (e.g. ``weather='{}'``).
    """
    return merge(base, upsert_batch(base.schema, updates, keys, order, defaults), keys, update_cols, max_broadcast_bytes)


def upsert_batch(schema, updates: DataFrame, keys: Sequence[str], order: str | Column | None = None,
                 defaults: Mapping[str, object] | None = None) -> DataFrame:
    """``updates`` in the base's form, one row per key, written once to the shared folder: however often the merge
    reads the batch, its normalisation runs once."""
    types = {f.name: f.dataType for f in schema.fields}
    order_col = F.lit(0) if order is None else (F.col(order) if isinstance(order, str) else order)
    conformed = _conform(updates.withColumn("_order", order_col), schema.fieldNames(), defaults or {}, types)
    return materialize(dedupe_last(conformed, list(keys), "_order").drop("_order"), "upsert-batch")


def merge(base: DataFrame, u: DataFrame, keys: Sequence[str], update_cols: Sequence[str],
          max_broadcast_bytes: int = UPSERT_BROADCAST_MAX_BYTES) -> DataFrame:
    """The base after upserting a written batch (``upsert_batch``)."""
    keys, columns = list(keys), base.columns
    rest = [c for c in columns if c not in keys]
    renamed = u.select(*keys, _spread(keys, columns).alias("_salt"), *[F.col(c).alias("_u_" + c) for c in rest], F.lit(True).alias("_u_present"))

    def merged(u_present: Column, b_present: Column) -> list[Column]:
        out = []
        for c in columns:
            if c in keys:
                out.append(F.col(c))
            elif c in update_cols:
                out.append(F.when(u_present, F.col("_u_" + c)).otherwise(F.col(c)).alias(c))
            else:
                out.append(F.when(b_present, F.col(c)).otherwise(F.col("_u_" + c)).alias(c))
        return out

    if fits(u, max_broadcast_bytes):
        # Small batch: the base is scanned twice and never shuffled. Equality
        # never matches a NULL key, so such rows fall through as inserts.
        updated = base.join(F.broadcast(renamed.drop("_salt")), keys, "left").select(
            *merged(F.col("_u_present").isNotNull(), F.lit(True))
        )
        matched = base.select(*keys).join(F.broadcast(u.select(*keys)), keys, "left_semi").distinct()
        inserted = u.join(F.broadcast(matched), keys, "left_anti")
        return updated.unionByName(inserted)

    # Large batch: one full outer join on (key, salt).
    b = base.withColumn("_salt", _spread(keys, columns)).withColumn("_b_present", F.lit(True))
    j = b.join(renamed, [*keys, "_salt"], "full_outer")
    return j.select(*merged(F.col("_u_present").isNotNull(), F.col("_b_present").isNotNull()))


def assign_ids(base: DataFrame, new_keys: DataFrame, natural_key: Sequence[str], id_col: str,
               max_rows: int = RANK_MAX_ROWS) -> DataFrame:
    """AUTO_INCREMENT for natural keys absent from ``base``.

    Returns ``new_keys``' distinct, unseen keys with ``id_col`` =
    max(existing id) + rank of the key in ascending order. Dimension inserts
    per batch are small: the unseen keys are written once and counted from
    the file footers before they are ranked in one ordered window; a larger
    batch is numbered range-partition by range-partition (offsets from
    per-partition counts), never in one task.
    """
    fresh = new_keys.select(*natural_key).distinct().join(base.select(*natural_key), list(natural_key), "left_anti")
    fresh = materialize(fresh, "fresh-keys")
    top = base.agg(F.coalesce(F.max(id_col), F.lit(0))).scalar()
    if fresh.count() <= max_rows:
        w = Window.orderBy(*[F.col(k).asc_nulls_last() for k in natural_key])
        numbered = fresh.withColumn("_rn", F.row_number().over(w))
    else:
        numbered = _range_number(fresh, natural_key)
    return numbered.select(
        (top + F.col("_rn")).cast(base.schema[id_col].dataType).alias(id_col), *natural_key
    )


def _range_number(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row numbers 1..n in key order without a single-partition window.

    Range partitioning splits the sorted keys into contiguous slices; each
    slice is numbered locally, and a slice's offset is the count of all
    earlier slices (a table with one row per slice).
    """
    parts = materialize(df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "key-slices")
    local = parts.withColumn(
        "_local", F.row_number().over(Window.partitionBy("_part").orderBy(*keys))
    )
    counts = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_offset", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    # one offset row per range partition: bounded by the partition count
    return local.join(F.broadcast(offsets.select("_part", "_offset")), "_part").select(
        *df.columns, (F.col("_offset") + F.col("_local")).alias("_rn")
    )


def lookup_ids(base: DataFrame, natural: DataFrame, natural_key: Sequence[str], id_col: str) -> DataFrame:
    """The ids of the given natural keys (the row just upserted)."""
    return join_dim(natural, base.select(*natural_key, id_col), list(natural_key))


# Rows of one session that one task writes, about: a larger session's rows are salted over files.
ROWS_PER_FILE = 2_000_000


def write_partitions(df: DataFrame, table_path: str, partition_col: str = "session_id") -> None:
    """Replace the partitions of ``df`` (already materialised) by dynamic overwrite.

    Rows are clustered by partition first, so the number of files follows the
    partitions and their sizes, never the number of tasks. The counts, a row a partition folder, are
    broadcast: the rows are shuffled once, to their files.
    """
    counts = df.groupBy(partition_col).agg(F.ceil(F.count(F.lit(1)) / ROWS_PER_FILE).alias("_files"))
    salted = df.join(F.broadcast(counts), partition_col).withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.col("_files")))
    (salted.repartition(partition_col, "_salt").drop("_files", "_salt").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(table_path))


def key_range(df: DataFrame, col: str) -> Column:
    """A literal min-max filter on ``col`` from the values in ``df``: two numbers reach the driver.

    A literal filter prunes partitions of a scan at planning time, and lets
    dynamic pruning select the exact ones within the range.
    """
    lo, hi = df.agg(F.min(col), F.max(col)).first()
    return F.lit(False) if lo is None else F.col(col).between(lo, hi)


# Rows of whole partitions that are timed, merged and written at a time, about: what bounds the disk of their shuffles.
ROWS_PER_MERGE = 10_000_000


def partition_ranges(df: DataFrame, col: str, rows: int) -> list[Column]:
    """Literal filters on ``col`` that part all its values, whatever they are, into ranges of about ``rows`` rows of ``df``.

    A value's rows stay together. A number for each range reaches the driver; the first range takes NULL too.
    """
    before = F.sum("_n").over(Window.orderBy(F.col(col).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1))
    per = df.groupBy(col).agg(F.count(F.lit(1)).alias("_n")).withColumn("_range", F.floor(F.coalesce(before, F.lit(0)) / rows))
    ends = per.groupBy("_range").agg(F.max(col).alias("_end")).where("_end IS NOT NULL").orderBy("_range").collect()
    bounds = [None, *(r["_end"] for r in ends[:-1]), None]
    out = []
    for over, to in zip(bounds, bounds[1:]):
        above = F.lit(True) if over is None else F.col(col) > over
        out.append(above if to is None else above & (F.col(col) <= to) | (F.col(col).isNull() if over is None else F.lit(False)))
    return out


def read_table(spark, table_path: str, schema) -> DataFrame:
    """A warehouse table by its schema; one that does not exist yet, or has no rows, is empty.

    Only an absent folder is taken for an absent table: any other trouble is raised, since a merge into a
    base taken for empty would overwrite what is there.
    """
    if not exists(spark, table_path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(table_path).select(*schema.fieldNames())


def upsert_partitions(spark, table_path: str, updates: DataFrame, keys: Sequence[str], update_cols: Sequence[str],
                      schema, partition_col: str = "session_id", order: str | Column | None = None,
                      full_partitions: bool = False, sized_by: DataFrame | None = None) -> None:
    """Upsert ``updates`` into the parquet table at ``table_path``, rewriting only touched partitions.

    The base is restricted to the ``partition_col`` values the batch touches
    (a literal range plus a semi-join, so the scan prunes partitions), merged
    with ``upsert``, materialised in the shared folder, and written back with
    dynamic partition overwrite. Untouched partitions are never read or
    rewritten. ``full_partitions`` says that the batch holds all rows of its
    partitions: then base rows with a NULL key, which an update can never
    match, are replaced by the batch's, and a replay changes nothing.

    ``sized_by``, the rows that the updates come from, parts a large batch into ranges of partitions
    that are merged one after the other: the disk of their shuffles and copies is that of ``ROWS_PER_MERGE`` rows, or of the
    largest partition. The batch is written with one row per key, a table that is not there yet takes it as it
    is, and what has been read is deleted.
    """
    with cleaned_shuffles(spark):
        there = exists(spark, table_path)
        for part in [F.lit(True)] if sized_by is None else partition_ranges(sized_by, partition_col, ROWS_PER_MERGE):
            batch = upsert_batch(schema, updates.where(part), keys, order)
            if there:
                in_range = key_range(batch, partition_col)
                touched = batch.select(partition_col).where(in_range).distinct()
                base = read_table(spark, table_path, schema).where(in_range).join(touched, partition_col, "left_semi")
                if full_partitions:
                    base = base.where(~_any_null(keys))
                merged = materialize(merge(base, batch, keys, update_cols), "partition-merge")
                discard(batch)
            else:
                merged = batch
            write_partitions(merged, table_path, partition_col)
            discard(merged)

"""Helpers shared by the corpus operators: table access, the label folds, written intermediates
and a streaming reader of whole sorted groups for ``mapInPandas``."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlane.config import materialize

__all__ = ["bounded_batches", "fold", "labelled_sample", "let", "materialize", "parts_for", "sigmoid", "table", "text_column", "texts_of", "whole_groups"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder; the path is handed to Spark's reader as it is."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of an Arrow batch on its way to or from Python, about: whole texts make batches bounded by rows alone too large.
BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Bound the session's Arrow batches by bytes; a smaller bound that the session has stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = int(spark.conf.get(key).removesuffix("b"))
    if not 0 < now <= most:
        spark.conf.set(key, str(most))


def fold(doc_id: Column | str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``: the fold a document belongs to."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % F.lit(n)


def labelled_sample(labels: DataFrame, label: str, folds: int, held: int, max_rows: int) -> DataFrame:
    """(doc_id, y) of at most ``max_rows`` labelled rows outside the held-out fold, the first
    ones by a hash of the id; the bound makes the result small enough to broadcast."""
    y = labels.select("doc_id", F.col(label).cast("int").alias("y")).where("y in (0, 1) and doc_id is not null")
    y = y.where(fold("doc_id", folds) != held)
    return F.broadcast(y.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(max_rows))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``.

    Catalyst inlines a named column into the lambdas that use it, which would evaluate it
    again for each array element; a lambda variable is a value and never inlined.
    """
    return F.transform(F.array(value), body)[0]


def parts_for(rows: int, per_part: int) -> int:
    """Number of partitions that hold at most about ``per_part`` rows each."""
    return max(1, math.ceil(rows / per_part))


def text_column(df: DataFrame, column: str = "text") -> Column:
    """The text as a string column, null kept."""
    return df[column].cast("string")


def sigmoid(x):
    """Logistic function of a numpy array, safe for large arguments."""
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def texts_of(batch: pa.RecordBatch, column: str, rows: int = 512) -> Iterator[str | None]:
    """A column's strings, a few hundred at a time: the rest of the batch stays in Arrow's buffers."""
    c = batch.column(batch.schema.get_field_index(column))
    for lo in range(0, len(c), rows):
        yield from c.slice(lo, rows).to_pylist()


def whole_groups(batches: Iterable[pd.DataFrame], keys: list[str]) -> Iterator[tuple[pd.DataFrame, list[int]]]:
    """Frames of whole groups out of a partition sorted by ``keys``, with the groups' bounds.

    Rows of a group that runs over a batch's end wait for the next batch, so memory follows
    a batch and the largest group, not the partition.
    """
    held: pd.DataFrame | None = None
    for batch in batches:
        if not len(batch):
            continue
        frame = batch if held is None else pd.concat([held, batch], ignore_index=True)
        bounds = _bounds(frame, keys)
        held = frame.iloc[bounds[-1] :]
        if len(bounds) > 1:
            yield frame.iloc[: bounds[-1]], bounds
    if held is not None and len(held):
        yield held, [0, len(held)]


def _bounds(frame: pd.DataFrame, keys: list[str]) -> list[int]:
    """Starts of the groups of consecutive equal keys."""
    new = np.zeros(len(frame), bool)
    new[0] = True
    for k in keys:
        v = frame[k].to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new).tolist()

"""The skew-safe forms equal their plain-window definitions, also on their
split paths (several chunks/slices, no broadcast)."""

import random

from conftest import rows

from pyspark.sql import Window
from pyspark.sql import functions as F

from pitlane.operators.ranking import arg_min, first_by, group_row_number, running_sum


def _data(spark, n=400, seed=7):
    rnd = random.Random(seed)
    data = [
        (rnd.choice([1, 1, 1, 2]),               # group 1 is hot
         rnd.choice(["a", "b"]),
         float(i) if rnd.random() > 0.05 else None,
         rnd.choice([None, 0, rnd.randint(1, 1000)]))
        for i in range(n)
    ]
    return spark.createDataFrame(data, "g int, h string, o double, v long")


def test_running_sum_matches_window_across_chunks(spark):
    df = _data(spark)
    w = (Window.partitionBy("g", "h").orderBy(F.col("o").asc_nulls_last(), F.col("v").asc_nulls_last())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    want = rows(df.withColumn("s", F.sum("v").over(w)).where(F.col("o").isNotNull()))
    for bound in (3, 50, 10_000):
        got = rows(running_sum(df, ["g", "h"], "o", "v", "s", tie=["v"], max_group_rows=bound)
                   .where(F.col("o").isNotNull()))
        assert got == want, bound


def test_running_sum_splits_repeated_order_values(spark):
    # one hot group whose order values all repeat: chunks by row rank still split it
    df = spark.createDataFrame([(1, 1.0, i % 3, i) for i in range(60)], "g int, o double, v long, k long")
    w = Window.partitionBy("g").orderBy("o", "k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = rows(df.withColumn("s", F.sum("v").over(w)))
    assert rows(running_sum(df, ["g"], "o", "v", "s", tie=["k"], max_group_rows=7)) == want


def test_group_row_number_matches_window_across_slices(spark):
    df = _data(spark).where(F.col("o").isNotNull())
    want = rows(df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("o"))))
    for parts in (1, 5, 16):
        assert rows(group_row_number(df, ["g"], [F.col("o")], out="rn", partitions=parts, max_group_rows=0)) == want
    assert rows(group_row_number(df, ["g"], [F.col("o")], out="rn")) == want   # small groups: one window


def test_arg_min_keeps_ties(spark):
    df = spark.createDataFrame([(1, 5, "x"), (1, 5, "y"), (1, 7, "z"), (2, None, "n"), (2, 9, "m")],
                               "k int, t int, tag string")
    want = [(1, 5, "x"), (1, 5, "y"), (2, 9, "m")]
    assert rows(arg_min(df, ["k"], "t")) == want


def test_running_sum_keeps_rows_with_null_group_keys_on_both_paths(spark):
    data = [(None, 1.0, 5), (None, 2.0, 6), (1, 1.0, 7), (None, None, None)]
    df = spark.createDataFrame(data, "g int, o double, v long")
    want = [(1, 1.0, 7, 7), (None, 1.0, 5, 5), (None, 2.0, 6, 11), (None, None, None, 11)]
    for bound in (1, 2, 10**6):
        assert rows(running_sum(df, ["g"], "o", "v", "s", max_group_rows=bound)) == want, bound



def test_first_by_one_row_per_key(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (2, 2, "b")], "k int, o int, tag string")
    assert rows(first_by(df, ["k"], ["o"])) == [(1, 1, "a"), (2, 2, "b")]

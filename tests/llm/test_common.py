import pyarrow as pa

from pitlane.llm.common import bounded_batches

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_batches_are_bounded_by_bytes_and_a_smaller_bound_stays(spark):
    before = spark.conf.get(KEY)
    try:
        spark.conf.unset(KEY)
        bounded_batches(spark, 1 << 20)
        df = spark.range(400).selectExpr("repeat('x', 10000) AS text").coalesce(1)

        def sizes(batches):
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

        got = [r.n for r in df.mapInArrow(sizes, "n long").collect()]
        assert len(got) > 3 and max(got) < 1_100_000
        bounded_batches(spark, 1 << 30)
        assert spark.conf.get(KEY) == str(1 << 20)
    finally:
        spark.conf.set(KEY, before)

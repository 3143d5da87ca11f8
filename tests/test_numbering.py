"""Dense numbers against a window over everything."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from abonados.operators.numbering import dense_numbers
from test_plans import plan


@pytest.mark.parametrize("descending", [False, True])
def test_numbers_equal_a_global_window(spark, descending):
    rows = spark.range(5000).select(F.xxhash64("id").alias("key"), (F.col("id") % 3).alias("number"), F.lit(None).cast("string").alias("gone"))
    order = [F.col("key").desc() if descending else F.col("key").asc()]
    found = dense_numbers(rows, order, "place", first=10)
    wanted = rows.withColumn("place", F.row_number().over(Window.orderBy(*order)).cast("bigint") + 9)
    assert found.exceptAll(wanted).count() == 0 and found.count() == 5000
    assert "SinglePartition" not in plan(found)


def test_ties_and_few_rows(spark):
    ties = dense_numbers(spark.range(100).withColumn("same", F.lit(1)), [F.col("same")])
    assert sorted(r.number for r in ties.collect()) == list(range(1, 101))
    assert dense_numbers(spark.range(0), [F.col("id")]).collect() == []
    (row,) = dense_numbers(spark.range(1).withColumn("number", F.lit("x")), [F.col("id")]).collect()
    assert row.number == 1


def test_rows_are_spread(spark):
    """Ranges are tasks of their own once they are large enough not to be joined up."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = dense_numbers(spark.range(0, 40_000, 1, 1), [F.col("id")])
        files = numbered.groupBy(F.input_file_name().alias("file")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(files) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(f["count"] for f in files) < 2 * 40_000 / len(files)

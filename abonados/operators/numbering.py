"""Dense row numbers in a global order, without bringing the rows into one task."""

from __future__ import annotations

import uuid
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abonados.session import shared_dir

_PART, _HERE = "_range", "_place"
#: Bits of a generated id that count rows within a partition.
_PLACES = (1 << 33) - 1


def dense_numbers(df: DataFrame, order: list[Column], name: str = "number", first: int = 1) -> DataFrame:
    """Adds ``ROW_NUMBER() OVER (ORDER BY order)``, counted from ``first``.

    Rows are dealt to tasks by ranges of the order and sorted there; a number is the place
    within its range plus the rows of all ranges before. Places are written to the
    shared folder first, so that a repeated task cannot number rows otherwise. The order
    should tell rows apart: rows that are equal in it are one range, and are numbered in
    any order. A column called ``name`` is replaced.
    """
    spark = df.sparkSession
    placed = (
        df.drop(name)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(_PART, F.spark_partition_id())
        .withColumn(_HERE, F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACES)))
    )
    path = f"{shared_dir(spark)}/numbered-{uuid.uuid4().hex[:12]}"
    placed.write.parquet(path)
    stored = spark.read.schema(placed.schema).parquet(path)
    # a row per range: as many as the shuffle has partitions
    sizes = stored.groupBy(_PART).agg(F.count("*").alias("rows")).sort(_PART).collect()
    begins = [first, *accumulate((r["rows"] for r in sizes), initial=first)][1:-1] if sizes else []
    offsets = spark.createDataFrame(
        [(r[_PART], begin) for r, begin in zip(sizes, begins, strict=True)], f"{_PART} int, _begin bigint"
    )
    joined = stored.join(F.broadcast(offsets), _PART)
    return joined.withColumn(name, F.col("_begin") + F.col(_HERE)).drop(_PART, _HERE, "_begin")

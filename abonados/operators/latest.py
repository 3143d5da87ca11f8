"""Keeping the newest row of each key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK, _AFTER = "__rank", "__after"


def keep_latest(
    df: DataFrame, keys: list[str], order: list[Column], with_ties: bool = False, apart: str | None = None
) -> DataFrame:
    """The first row of each key in the given order, or all rows equal to it.

    Spark applies the limit in every map task before the shuffle, so a key that
    holds a large share of all rows arrives as one row (or one tie) per task.

    Rows for which the column ``apart`` holds, at most one of each key, are kept besides
    the first of the others and do not compete with them.
    """
    if apart:
        beside = Window.partitionBy(*keys).orderBy(F.col(apart).desc(), *order)
        two = df.withColumn(_RANK, F.row_number().over(beside)).filter(F.col(_RANK) <= 2)
        after = F.lag(apart, 1, False).over(beside)
        return two.withColumn(_AFTER, after).filter((F.col(_RANK) == 1) | F.col(_AFTER)).drop(_RANK, _AFTER)
    window = Window.partitionBy(*keys).orderBy(*order)
    rank = F.rank() if with_ties else F.row_number()
    return df.withColumn(_RANK, rank.over(window)).filter(F.col(_RANK) == 1).drop(_RANK)

"""Exact order statistics and shares for groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ACCURACY = 10_000


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``keys``, the value and ``n``, how often it occurs. Combined map-side."""
    return df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))


def _beside(df: DataFrame, groups: DataFrame, keys: list[str], few: bool) -> DataFrame:
    """Each row beside the one row of its group; NULL keys are equal."""
    renamed = groups.withColumnsRenamed({k: f"g_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"g_{k}")) for k in keys]
    return df.join(F.broadcast(renamed) if few else renamed, same).drop(*[f"g_{k}" for k in keys])


def grouped_summary(
    df: DataFrame, keys: list[str], value: str, few_groups: bool = False
) -> DataFrame:
    """``mean``, exact interpolated ``median``, ``mode`` and ``total`` of each group.

    Groups may be of any size: no task ever holds the values of a group. Set
    ``few_groups`` where the keys come from fixed vocabularies: one row per group
    is then broadcast, whatever Spark estimates.

    1. A sketch brackets the middle of each group.
    2. Equal values are counted; the counts are summed below, inside and above
       the bracket, which tells in what range of values the median must lie.
    3. Only the values of that range are ranked.

    The ranges are facts about the data, so the result is exact whatever the
    sketch says; a poor sketch only means that more values are ranked. The mode
    is the smallest of the most frequent values.
    """
    rows = df.filter(F.col(value).isNotNull()).select(*keys, value)
    margin = 4 / _ACCURACY
    sketch = rows.groupBy(*keys).agg(
        F.avg(value).alias("mean"),
        F.count("*").alias("total"),
        F.percentile_approx(
            F.col(value).cast("double"), [0.5 - margin, 0.5 + margin], _ACCURACY
        ).alias("bracket"),
    )
    counts = value_counts(rows, keys, value)
    as_double = F.col(value).cast("double")
    zone = (
        F.when(as_double < F.col("bracket")[0], -1)
        .when(as_double > F.col("bracket")[1], 1)
        .otherwise(0)
    )
    zones = (
        _beside(counts, sketch, keys, few_groups)
        .groupBy(*keys, zone.alias("zone"))
        .agg(
            F.sum("n").alias("held"),
            F.min(value).alias("least"),
            F.max(value).alias("most"),
            F.max(F.struct("n", (-F.col(value)).alias("low"), F.col(value).alias("value"))).alias("top"),
            F.max("mean").alias("mean"),
            F.max("total").alias("total"),
        )
        .withColumn("upto", F.sum("held").over(Window.partitionBy(*keys).orderBy("zone")))
    )
    lower, upper = F.expr("(total + 1) DIV 2"), F.expr("(total + 2) DIV 2")
    holds = (F.col("upto") >= lower) & (F.col("upto") - F.col("held") < upper)
    ranges = zones.groupBy(*keys).agg(
        F.min(F.when(holds, F.col("least"))).alias("least"),
        F.max(F.when(holds, F.col("most"))).alias("most"),
        F.min(F.when(holds, F.col("upto") - F.col("held"))).alias("before"),
        F.max("top").alias("top"),
        F.max("mean").alias("mean"),
        F.max("total").alias("total"),
    )
    ranked = (
        _beside(counts, ranges, keys, few_groups)
        .filter(F.col(value).between(F.col("least"), F.col("most")))
        .withColumn(
            "upto",
            F.col("before") + F.sum("n").over(Window.partitionBy(*keys).orderBy(value)),
        )
    )

    def value_at(rank: Column) -> Column:
        here = (F.col("upto") >= rank) & (F.col("upto") - F.col("n") < rank)
        return F.max(F.when(here, as_double))

    return (
        ranked.groupBy(*keys)
        .agg(
            F.max("mean").alias("mean"),
            value_at(lower).alias("lo"),
            value_at(upper).alias("hi"),
            F.max("top")["value"].alias("mode"),
            F.max("total").alias("total"),
        )
        .select(*keys, "mean", (F.col("lo") + (F.col("hi") - F.col("lo")) * 0.5).alias("median"), "mode", "total")
    )


def percent_of_total(count: str, digits: int = 2) -> Column:
    """Percentage of a column's grand total. For aggregated, hence small, frames."""
    everything = Window.partitionBy()
    hundred = F.lit(100).cast("decimal(4,1)")
    return F.round(F.col(count) * hundred / F.sum(count).over(everything), digits)

"""Collecting queries together with their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contract.store import tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and timestamps as texts, which both engines print alike."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(name: str, *reads: str, oracle: str | None = None):
    """Registers a function of the named stored tables, given in that order."""

    def register(function: Callable[..., DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(function(*tables(spark, sf_dir, *reads).values()))

        return add(name, run, oracle) and function

    return register


def add(name: str, run: Query, oracle: str | None) -> Query:
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")
    QUERIES[name] = run
    if oracle:
        ORACLES[name] = oracle
    return run

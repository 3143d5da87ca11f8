"""Row counts, freshness and rejected values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abonados.functions import documents as D
from abonados.functions import parsing as P


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``layer`` and ``rows`` of every given table."""
    counts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("layer"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def customers_per_service(services: DataFrame, dim: DataFrame) -> DataFrame:
    """Bridge rows of every service, counted before the dimension is joined."""
    counts = services.groupBy("service_id").agg(F.count("*").alias("customers"))
    return counts.join(F.broadcast(dim), "service_id").select("service_code", "customers")


def freshness(table: DataFrame, as_of: Column, warn_hours: float, error_hours: float) -> DataFrame:
    """Newest load, its age in hours and ``pass``, ``warn`` or ``error``."""
    newest = F.max("_loaded_at")
    age = (F.unix_seconds(as_of.cast("timestamp")) - F.unix_seconds(newest)) / 3600.0
    state = (
        F.when(newest.isNull() | (age > error_hours), "error")
        .when(age > warn_hours, "warn")
        .otherwise("pass")
    )
    return table.agg(newest.alias("newest"), age.alias("age_hours"), state.alias("state"))


def rejected_values(bronze: DataFrame) -> DataFrame:
    """Values of accepted shape, or unchecked ones, that no conversion took: ``field``, ``rejected``."""
    doc = F.col("data")

    def text(key: str) -> Column:
        return D.field_text(doc, key)

    given, number = D.field(doc, "customer_id"), P.given_customer_id(doc)
    rejected = {
        "customer_id": D.is_number(given) & number.isNull(),
        "registration_date": P.has_timestamp_shape(text("registration_date"))
        & P.parse_timestamp(text("registration_date")).isNull(),
        "last_payment_date": P.has_timestamp_shape(text("last_payment_date"))
        & P.parse_timestamp(text("last_payment_date")).isNull(),
    }
    for key, dtype in (
        ("credit_limit", P.MONEY),
        ("data_usage_current_month", P.MONEY),
        ("latitude", P.COORDINATE),
        ("longitude", P.COORDINATE),
    ):
        rejected[key] = text(key).isNotNull() & P.loose_number_field(doc, key, dtype).isNull()
    counted = bronze.agg(*[F.count_if(test).alias(name) for name, test in rejected.items()])
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("field"), F.col(name).alias("rejected"))
            for name in rejected
        ]
    )
    return counted.select(F.inline(rows))

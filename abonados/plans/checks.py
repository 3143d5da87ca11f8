"""The checks declared for each layer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import functions as F

from abonados.functions import documents as D
from abonados.functions import parsing as P
from abonados.functions import vocabulary as V
from abonados.operators.quality import (
    WARN,
    AcceptedRange,
    AcceptedValues,
    Check,
    NotNull,
    Relationship,
    Unique,
    primary_key,
)

BRONZE = "raw_mobile_customers"
CUSTOMERS = "stg_mobile_customers_cleaned"
PAYMENTS = "stg_payment_history"
SERVICES = "stg_customer_services"
DIM_SERVICES = "stg_dim_services"
ANALYTICS = "customer_analytics"

_STATUSES = tuple(rule.value for rule in V.CUSTOMER_STATUSES) + (V.UNKNOWN,)
_COUNTRIES = tuple(rule.value for rule in V.COUNTRIES) + (V.UNKNOWN_COUNTRY,)


@dataclass(frozen=True)
class ServicesIntegrity(Check):
    """Customers that have services, but none that is active."""

    table: str = SERVICES
    severity: str = WARN
    name = "customer_services_integrity"

    def violations(self, tables):
        active = F.bool_or(F.col("status") == "ACTIVE")
        return (
            tables[self.table].groupBy("customer_id").agg(active.alias("active")).filter("NOT active")
        )


@dataclass(frozen=True)
class ServicesCompleteness(Check):
    """Service names of the raw documents that the dimension does not list."""

    table: str = BRONZE
    severity: str = WARN
    name = "services_completeness"

    def violations(self, tables):
        tokens = P.service_tokens(D.field_text(F.col("data"), "contracted_services"))
        named = (
            tables[self.table]
            .select(F.explode(tokens).alias("token"))
            .select(F.upper(F.trim("token")).alias("service_code"))
            .filter("service_code <> ''")
            .groupBy("service_code")
            .agg(F.count("*").alias("mentions"))
        )
        known = F.broadcast(tables[DIM_SERVICES].select("service_code"))
        return named.join(known, "service_code", "left_anti")


@dataclass(frozen=True)
class PaymentHistoryCompleteness(Check):
    """Customers whose documents list payments, but who have none in silver."""

    table: str = CUSTOMERS
    severity: str = WARN
    name = "payment_history_completeness"

    def violations(self, tables):
        doc = F.col("data")
        listing = (
            tables[BRONZE]
            .filter(F.size(D.elements(doc, "payment_history")) > 0)
            .select(P.given_customer_id(doc).alias("customer_id"))
            .filter(F.col("customer_id").isNotNull())
            .groupBy("customer_id")
            .agg(F.count("*").alias("documents"))
        )
        paid = tables[PAYMENTS].groupBy("customer_id").agg(F.count("*").alias("payments"))
        return (
            tables[self.table]
            .select("customer_id")
            .join(listing, "customer_id", "left_semi")
            .join(paid, "customer_id", "left_anti")
        )


SILVER_CHECKS: list[Check] = [
    NotNull(CUSTOMERS, column="customer_id"),
    Unique(CUSTOMERS, columns=("customer_id",)),
    NotNull(CUSTOMERS, column="email"),
    AcceptedRange(CUSTOMERS, column="age", min_value=0, max_value=120),
    NotNull(CUSTOMERS, column="country"),
    AcceptedValues(CUSTOMERS, column="country", values=_COUNTRIES),
    AcceptedValues(CUSTOMERS, column="customer_status", values=_STATUSES),
    AcceptedRange(CUSTOMERS, column="credit_score", min_value=0),
    AcceptedRange(CUSTOMERS, column="monthly_data_gb", min_value=0),
    NotNull(PAYMENTS, column="payment_id"),
    Unique(PAYMENTS, columns=("payment_id",)),
    NotNull(PAYMENTS, column="customer_id"),
    Relationship(PAYMENTS, WARN, column="customer_id", parent=CUSTOMERS, parent_column="customer_id"),
    NotNull(PAYMENTS, column="payment_date"),
    NotNull(PAYMENTS, column="payment_amount"),
    AcceptedRange(PAYMENTS, column="payment_amount", min_value=0, inclusive=False),
    AcceptedValues(
        PAYMENTS, column="payment_status", values=tuple(r.value for r in V.PAYMENT_STATUSES)
    ),
    NotNull(SERVICES, column="customer_id"),
    Relationship(SERVICES, WARN, column="customer_id", parent=CUSTOMERS, parent_column="customer_id"),
    NotNull(SERVICES, column="service_id"),
    AcceptedValues(SERVICES, column="status", values=_STATUSES),
    NotNull(SERVICES, column="contracted_date"),
]

KEY_CHECKS: list[Check] = [
    *primary_key(CUSTOMERS, "customer_id"),
    *primary_key(PAYMENTS, "payment_id"),
    *primary_key(SERVICES, "customer_id", "service_id"),
    *primary_key(DIM_SERVICES, "service_id"),
]

DESCRIBED_CHECKS: list[Check] = [
    ServicesIntegrity(),
    ServicesCompleteness(),
    PaymentHistoryCompleteness(),
]

GOLD_CHECKS: list[Check] = [
    NotNull(ANALYTICS, column="customer_id"),
    Unique(ANALYTICS, columns=("customer_id",)),
    AcceptedRange(ANALYTICS, column="total_revenue", min_value=0),
    AcceptedRange(ANALYTICS, column="arpu_real", min_value=0),
]

"""Gold layer: the wide customer table and the business questions asked of it.

All queries take and return DataFrames. NULLs sort last in ascending and first
in descending order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abonados.functions import metrics as M
from abonados.operators import statistics as S

DIMENSIONS = (
    "customer_id", "plan_type", "operator", "country", "city", "device_brand", "device_model",
    "monthly_bill_usd", "monthly_data_gb", "credit_score", "credit_score_range", "age",
    "age_bucket", "registration_date", "customer_status", "_loaded_at",
)
MEASURES = (
    "total_revenue", "avg_payment_amount", "payments_count", "first_payment_date",
    "last_payment_date", "has_payment_issues", "has_pending_payments", "total_services_count",
    "active_services_count", "months_of_service", "arpu_estimated", "arpu_real",
)


def _asc(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


def _desc(name: str) -> Column:
    return F.col(name).desc_nulls_first()


def _customers() -> Column:
    return F.count("*").alias("customers")


def _mean_arpu(name: str) -> Column:
    return F.round(F.avg("arpu_estimated"), 2).alias(name)


# --- the wide table ----------------------------------------------------------------


def payments_by_customer(payments: DataFrame) -> DataFrame:
    """One row per customer. Combined map-side, so hot customers are no burden."""
    status = F.col("payment_status")
    completed = F.when(status == "COMPLETED", F.col("payment_amount"))
    return payments.groupBy("customer_id").agg(
        F.count_if(status == "COMPLETED").alias("payments_count"),
        F.sum(completed).alias("total_revenue"),
        F.avg(completed).alias("avg_payment_amount"),
        F.max("payment_date").alias("last_payment_date"),
        F.min("payment_date").alias("first_payment_date"),
        F.bool_or(status.isin("FAILED", "LATE")).alias("has_payment_issues"),
        F.bool_or(status == "PENDING").alias("has_pending_payments"),
    )


def services_by_customer(services: DataFrame) -> DataFrame:
    """Distinct services per customer; both counts mean the same."""
    distinct = F.count_distinct("service_id")
    return services.groupBy("customer_id").agg(
        distinct.alias("total_services_count"), distinct.alias("active_services_count")
    )


def customer_analytics(
    customers: DataFrame, payments: DataFrame, services: DataFrame, as_of: Column | None = None
) -> DataFrame:
    """One wide row per customer. ``as_of`` is the day tenure is counted to."""
    today = F.current_date() if as_of is None else as_of.cast("date")
    dimensions = customers.withColumns(
        {
            "credit_score_range": M.credit_score_range(F.col("credit_score")),
            "age_bucket": M.age_bucket(F.col("age")),
        }
    ).select(*DIMENSIONS)
    joined = dimensions.join(payments_by_customer(payments), "customer_id", "left").join(
        services_by_customer(services), "customer_id", "left"
    )
    measured = joined.withColumns(
        {
            "total_services_count": F.coalesce("total_services_count", F.lit(0).cast("bigint")),
            "active_services_count": F.coalesce("active_services_count", F.lit(0).cast("bigint")),
            "months_of_service": M.months_between(today, F.col("registration_date")),
            "arpu_estimated": M.arpu_estimated(
                F.col("total_revenue"), F.col("payments_count"), F.col("monthly_bill_usd")
            ),
        }
    ).withColumn("arpu_real", M.arpu_real(F.col("total_revenue"), F.col("months_of_service")))
    return measured.select(*DIMENSIONS, *MEASURES)


# --- customers -----------------------------------------------------------------------


def _month() -> Column:
    return F.date_trunc("month", "registration_date").alias("month")


def acquisition_trends_operator(analytics: DataFrame) -> DataFrame:
    return (
        analytics.groupBy(_month(), "operator")
        .agg(F.count("*").alias("new_customers"))
        .orderBy(*_asc("month", "operator"))
    )


def new_customers_over_time(analytics: DataFrame) -> DataFrame:
    return (
        analytics.groupBy(_month()).agg(F.count("*").alias("new_customers")).orderBy(*_asc("month"))
    )


def age_dist_country_operator(analytics: DataFrame) -> DataFrame:
    keys = ("country", "operator", "age_bucket")
    return analytics.groupBy(*keys).agg(_customers()).orderBy(*_asc(*keys))


def age_distribution_by_plan(analytics: DataFrame) -> DataFrame:
    keys = ("plan_type", "age_bucket")
    return analytics.groupBy(*keys).agg(_customers()).orderBy(*_asc(*keys))


def customers_by_geo(analytics: DataFrame) -> DataFrame:
    return analytics.groupBy("country", "city").agg(_customers()).orderBy(_desc("customers"))


def customers_by_operator(analytics: DataFrame) -> DataFrame:
    return (
        analytics.groupBy("operator")
        .agg(_customers(), _mean_arpu("avg_arpu"))
        .orderBy(_desc("customers"))
    )


def customer_status_distribution(analytics: DataFrame) -> DataFrame:
    return (
        analytics.groupBy("customer_status")
        .agg(_customers())
        .withColumn("pct_total", S.percent_of_total("customers"))
        .orderBy(_desc("customers"))
    )


# --- revenue -------------------------------------------------------------------------


def arpu_by_plan_type(analytics: DataFrame) -> DataFrame:
    return (
        analytics.filter(F.col("arpu_estimated").isNotNull())
        .groupBy("plan_type")
        .agg(_mean_arpu("arpu"))
        .orderBy(_desc("arpu"))
    )


def revenue_by_geo(analytics: DataFrame) -> DataFrame:
    return (
        analytics.groupBy("country", "city")
        .agg(F.sum("total_revenue").alias("total_revenue"), _customers(), _mean_arpu("avg_arpu"))
        .orderBy(_desc("total_revenue"))
    )


def revenue_stats_plan_operator(analytics: DataFrame, approx: bool = False) -> DataFrame:
    """Mean, median and mode of estimated ARPU.

    The cleaners know four plans and five operators, so there are at most 20
    groups, each of which may hold a large part of all customers.
    ``approx=True`` takes the median from a sketch and reads the rows once less.
    """
    keys = ["plan_type", "operator"]
    if approx:
        revenue = F.col("arpu_estimated")
        stats = (
            analytics.filter(revenue.isNotNull())
            .groupBy(*keys)
            .agg(
                F.avg(revenue).alias("mean"),
                F.percentile_approx(revenue.cast("double"), 0.5).alias("median"),
                F.count("*").alias("total"),
            )
            .join(
                S.value_counts(analytics, keys, "arpu_estimated")
                .groupBy(*keys)
                .agg(F.max(F.struct("n", (-revenue).alias("low"), revenue.alias("value")))["value"].alias("mode")),
                keys,
            )
        )
    else:
        stats = S.grouped_summary(analytics, keys, "arpu_estimated", few_groups=True)
    return stats.select(
        *keys,
        F.round("mean", 2).alias("mean_revenue"),
        F.col("median").alias("median_revenue"),
        F.col("mode").alias("mode_revenue"),
        F.col("total").alias("customers"),
    ).orderBy(_desc("mean_revenue"))


# --- payments ------------------------------------------------------------------------


def credit_score_distribution(analytics: DataFrame) -> DataFrame:
    return (
        analytics.groupBy("credit_score_range")
        .agg(_customers(), _mean_arpu("avg_arpu"))
        .orderBy(_desc("customers"))
    )


def credit_score_vs_payment_behavior(payments: DataFrame, analytics: DataFrame) -> DataFrame:
    """Share of each payment status by credit score range.

    Payments are counted per customer before the join, so that the join sees one
    row per customer on either side.
    """
    statuses = ("COMPLETED", "FAILED", "PENDING", "LATE")
    per_customer = payments.groupBy("customer_id").agg(
        F.count("*").alias("total"),
        *[F.count_if(F.col("payment_status") == s).alias(s) for s in statuses],
    )
    by_range = (
        per_customer.join(analytics.select("customer_id", "credit_score_range"), "customer_id")
        .groupBy("credit_score_range")
        .agg(F.sum("total").alias("total_payments"), *[F.sum(s).alias(s) for s in statuses])
    )
    hundred = F.lit(100).cast("decimal(4,1)")
    shares = [
        F.round(hundred * F.col(s) / F.col("total_payments"), 2).alias(f"pct_{s.lower()}")
        for s in statuses
    ]
    return by_range.select("credit_score_range", "total_payments", *shares).orderBy(
        *_asc("credit_score_range")
    )


def customers_pending_payments(analytics: DataFrame) -> DataFrame:
    return analytics.filter("has_pending_payments").select(
        "customer_id", "plan_type", "operator", "country", "city", "total_revenue", "arpu_estimated"
    )


def payment_issues_pct(analytics: DataFrame) -> DataFrame:
    issues = F.count_if("has_payment_issues").cast("decimal(20,0)")
    total = F.when(F.count("*") > 0, F.count("*"))
    return analytics.agg(F.round(issues / total * 100, 2).alias("pct_payment_issues"))


# --- devices -------------------------------------------------------------------------


def _known_brand(analytics: DataFrame) -> DataFrame:
    return analytics.filter(F.col("device_brand") != "Unknown")


def device_brand_by_country_operator(analytics: DataFrame) -> DataFrame:
    return (
        _known_brand(analytics)
        .groupBy("country", "operator", "device_brand")
        .agg(_customers())
        .orderBy(_desc("customers"))
    )


def device_brand_by_plan_type(analytics: DataFrame) -> DataFrame:
    return (
        _known_brand(analytics)
        .groupBy("plan_type", "device_brand")
        .agg(_customers())
        .orderBy(*_asc("plan_type"), _desc("customers"))
    )


def device_brand_popularity(analytics: DataFrame) -> DataFrame:
    return (
        _known_brand(analytics)
        .groupBy("device_brand")
        .agg(_customers())
        .orderBy(_desc("customers"))
    )


# --- services ------------------------------------------------------------------------


def _combinations(
    services: DataFrame, dim: DataFrame, analytics: DataFrame, how: str
) -> DataFrame:
    """Customers and revenue of every set of services taken together.

    A set is the sorted array of its numbers, at most as long as the dimension; its
    text is made once per set, not once per customer.
    """
    numbers = F.broadcast(dim.select("service_id"))  # the fixed list of services
    per_customer = (
        services.join(numbers, "service_id", "left_semi")
        .groupBy("customer_id")
        .agg(F.array_sort(F.collect_set("service_id")).alias("numbers"))
    )
    money = analytics.select("customer_id", "total_revenue", "arpu_estimated")
    zero = F.lit(0).cast("decimal(18,6)")
    sets = (
        per_customer.join(money, "customer_id", how)
        .groupBy("numbers")
        .agg(
            _customers(),
            F.sum(F.coalesce("total_revenue", zero)).alias("total_revenue"),
            F.round(F.avg(F.coalesce("arpu_estimated", zero.cast(M.ARPU))), 2).alias("avg_arpu"),
        )
    )
    return (
        sets.select("*", F.explode("numbers").alias("service_id"))
        .join(F.broadcast(dim), "service_id")
        .groupBy("numbers", "customers", "total_revenue", "avg_arpu")
        .agg(
            F.expr("listagg(service_code, ',') WITHIN GROUP (ORDER BY service_code)").alias("service_combo"),
            F.count("*").alias("services_count"),
        )
    )


def service_combinations_popularity(
    services: DataFrame, dim: DataFrame, analytics: DataFrame
) -> DataFrame:
    return (
        _combinations(services, dim, analytics, "inner")
        .withColumn("pct_customers", S.percent_of_total("customers"))
        .select(
            "service_combo", "services_count", "customers", "total_revenue", "avg_arpu", "pct_customers"
        )
        .orderBy(_desc("customers"))
    )


def service_combo_revenue(services: DataFrame, dim: DataFrame, analytics: DataFrame) -> DataFrame:
    """As above, but customers missing from the wide table count, with no revenue."""
    return (
        _combinations(services, dim, analytics, "left")
        .select("service_combo", "services_count", "total_revenue", "avg_arpu", "customers")
        .orderBy(_desc("total_revenue"))
    )


def services_popularity(services: DataFrame, dim: DataFrame, analytics: DataFrame) -> DataFrame:
    """Customers per service, as a percentage of the customers of the wide table.

    Customers of a service need not be in the wide table, so it may pass 100.
    """
    everyone = analytics.agg(F.count_distinct("customer_id")).scalar()
    customers = F.count_distinct("customer_id")
    hundred = F.lit(100).cast("decimal(4,1)")
    return (
        services.join(F.broadcast(dim), "service_id")  # the fixed list of services
        .groupBy("service_code")
        .agg(customers.alias("customers"))
        .withColumn("penetration_pct", F.round(F.col("customers") * hundred / everyone, 2))
        .orderBy(_desc("customers"))
    )

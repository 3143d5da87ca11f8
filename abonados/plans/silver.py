"""Silver layer: typed, cleaned and normalised tables from raw documents.

``bronze`` has the columns ``data`` (variant), ``_loaded_at`` and ``_row_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from abonados.functions import cleaning as C
from abonados.functions import documents as D
from abonados.functions import parsing as P
from abonados.functions import vocabulary as V
from abonados.operators import rejects as R
from abonados.operators.latest import keep_latest

CUSTOMER_COLUMNS = (
    "customer_id", "first_name", "last_name", "email", "phone_number", "age",
    "country_original", "country", "city", "latitude", "longitude", "operator",
    "plan_type", "monthly_data_gb", "monthly_bill_usd", "device_brand", "device_model",
    "registration_date", "last_payment_date", "customer_status", "credit_limit",
    "credit_score", "data_usage_current_month", "record_uuid", "_loaded_at",
)


def _newest_first() -> list[Column]:
    """Load order, then row number: loads are ties, the row number decides."""
    return [F.col("_loaded_at").desc_nulls_first(), F.col("_row_id").desc()]


def cleaned_customers(
    bronze: DataFrame, strict: bool = False, rejected: Observation | None = None
) -> DataFrame:
    """One cleaned row per document, before deduplication. ``rejected`` observes how many
    values of each field got lost, over all documents."""
    doc = F.col("data")

    def text(key: str) -> Column:
        return D.field_text(doc, key)

    # Texts and keys first: each rule below then reads a column.
    raw = bronze.select(
        P.customer_id(doc, F.col("_row_id"), strict).alias("customer_id"),
        F.trim(text("first_name")).alias("first_name"),
        F.trim(text("last_name")).alias("last_name"),
        F.lower(F.trim(text("email"))).alias("email"),
        text("phone_number").alias("phone"),
        D.field(doc, "age").alias("age_value"),
        C.folded(text("country")).alias("country_key"),
        C.plain_city(text("city")).alias("city_plain"),
        C.folded(text("operator")).alias("operator_key"),
        C.folded(text("plan_type")).alias("plan_key"),
        D.field(doc, "monthly_data_gb").alias("data_value"),
        D.field(doc, "monthly_bill_usd").alias("bill_value"),
        C.folded(text("device_brand")).alias("brand_key"),
        text("device_model").alias("model"),
        text("registration_date").alias("registered"),
        text("last_payment_date").alias("last_paid"),
        C.status_key(text("status")).alias("status_key"),
        D.field(doc, "credit_score").alias("score_value"),
        P.loose_number_field(doc, "credit_limit", P.MONEY, strict).alias("credit_limit"),
        P.loose_number_field(doc, "data_usage_current_month", P.MONEY, strict).alias(
            "data_usage_current_month"
        ),
        P.loose_number_field(doc, "latitude", P.COORDINATE, strict).alias("latitude"),
        P.loose_number_field(doc, "longitude", P.COORDINATE, strict).alias("longitude"),
        text("record_uuid").alias("record_uuid"),
        "_loaded_at",
        "_row_id",
        P.given_customer_id(doc, strict).isNull().alias("_surrogate"),
        *([R.with_reasons(R.customer_reasons(doc))] if rejected else []),
    )
    if rejected:
        raw = R.observed(raw, rejected)
    keyed = raw.withColumns(
        {
            "city_key": F.lower("city_plain"),
            "age_years": P.rounded(F.col("age_value"), strict),
            "score": P.rounded(F.col("score_value"), strict),
            "data_gb": P.parse_number(F.col("data_value"), P.MONEY, strict),
            "country_original": C.country_from_key(F.col("country_key")),
        }
    )
    cleaned = keyed.withColumns(
        {
            "city": C.city_from_key(F.col("city_key"), F.col("city_plain")),
            "age": P.age(F.col("age_years")),
            "operator": C.operator_from_key(F.col("operator_key")),
            "plan_type": C.plan_type_from_key(F.col("plan_key")),
            "monthly_data_gb": P.non_negative(F.col("data_gb")),
            "monthly_bill_usd": P.parse_number(F.col("bill_value"), P.MONEY, strict),
            "device_brand": C.device_brand_from_key(F.col("brand_key")),
            "device_model": C.clean_device_model(F.col("model")),
            "registration_date": P.parse_timestamp(F.col("registered"), strict),
            "last_payment_date": P.parse_timestamp(F.col("last_paid"), strict),
            "customer_status": C.customer_status_from_key(F.col("status_key")),
            "credit_score": P.non_negative(F.col("score")),
        }
    )
    return (
        cleaned.withColumn("country", C.home_of_city(F.col("country_original"), F.col("city")))
        .withColumn("phone_number", C.clean_phone(F.col("phone"), F.col("country")))
        .select(*CUSTOMER_COLUMNS, "_row_id", "_surrogate")
    )


def customers(
    bronze: DataFrame, strict: bool = False, rejected: Observation | None = None
) -> DataFrame:
    """One row per customer: the newest document, if its registration date is valid.

    The newest document is chosen first; an older one does not stand in for it. A customer
    whose surrogate id another one brings as its own stays besides it, and the check of
    the key reports the id.
    """
    newest = keep_latest(
        cleaned_customers(bronze, strict, rejected).filter(F.col("customer_id").isNotNull()),
        ["customer_id"],
        _newest_first(),
        apart="_surrogate",
    )
    return newest.filter(F.col("registration_date").isNotNull()).select(*CUSTOMER_COLUMNS)


def _payment_documents(bronze: DataFrame, strict: bool) -> DataFrame:
    """Documents whose payments count, with the payments as variants."""
    doc = F.col("data")
    return (
        bronze.filter(
            D.is_array(D.field(doc, "payment_history"))
            & D.is_usable(doc, "customer_id")
            & P.has_timestamp_shape(D.field_text(doc, "registration_date"))
        )
        .select(
            P.given_customer_id(doc, strict).alias("customer_id"),
            D.elements(doc, "payment_history").alias("payments"),
            "_loaded_at",
            "_row_id",
        )
        .filter(F.col("customer_id").isNotNull())
    )


def payments(
    bronze: DataFrame, strict: bool = False, rejected: Observation | None = None
) -> DataFrame:
    """One row per valid payment of the newest usable document of each customer.

    Elements are flattened and typed before the shuffle, so that narrow columns
    travel instead of documents. All elements of a document share one rank; a
    document without elements keeps one empty row, so that it still wins.
    """
    exploded = _payment_documents(bronze, strict).select(
        "customer_id", "_loaded_at", "_row_id", F.explode_outer("payments").alias("payment")
    )
    payment = F.col("payment")
    texts = exploded.select(
        "customer_id",
        "_loaded_at",
        "_row_id",
        P.payment_id(D.field_text(payment, "payment_id"), F.col("customer_id"), payment).alias(
            "payment_id"
        ),
        D.field_text(payment, "date").alias("date_text"),
        D.field(payment, "amount").alias("amount_value"),
        C.status_key(D.field_text(payment, "status")).alias("status_key"),
        *([R.with_reasons(R.payment_reasons(payment))] if rejected else []),
    )
    if rejected:
        texts = R.observed(texts, rejected)
    typed = texts.select(
        "customer_id",
        "_loaded_at",
        "_row_id",
        "payment_id",
        P.parse_timestamp(F.col("date_text"), strict).alias("payment_date"),
        P.parse_number(F.col("amount_value"), P.MONEY, strict).alias("payment_amount"),
        C.payment_status_from_key(F.col("status_key")).alias("payment_status"),
    )
    newest = keep_latest(typed, ["customer_id"], _newest_first(), with_ties=True)
    return newest.filter(
        F.col("payment_date").isNotNull() & (F.col("payment_amount") > 0)
    ).select(
        "payment_id", "customer_id", "payment_date", "payment_amount", "payment_status", "_loaded_at"
    )


def customer_services(
    bronze: DataFrame,
    services: DataFrame,
    as_of: Column | None = None,
    strict: bool = False,
    rejected: Observation | None = None,
) -> DataFrame:
    """One row per customer and contracted service.

    ``as_of`` stands for the contract date where the registration date is not
    valid; by default the time of the run.
    """
    doc = F.col("data")
    listed = D.field_text(doc, "contracted_services")
    documents = bronze.filter((listed != "") & (listed != "[]")).select(
        P.customer_id(doc, F.col("_row_id"), strict).alias("customer_id"),
        P.service_tokens(listed).alias("tokens"),
        P.parse_timestamp(D.field_text(doc, "registration_date"), strict).alias("registration_date"),
        C.clean_customer_status(D.field_text(doc, "status")).alias("status"),
        "_loaded_at",
        "_row_id",
        *([R.with_reasons(R.service_reasons(doc))] if rejected else []),
    )
    if rejected:
        documents = R.observed(documents, rejected)
    coded = documents.select("*", F.explode("tokens").alias("token")).withColumn(
        "service_code", F.upper(F.trim("token"))
    )
    now = F.current_timestamp() if as_of is None else as_of.cast("timestamp")
    matched = (
        coded.filter((F.trim("token") != "") & F.col("customer_id").isNotNull())
        # the dimension is the fixed list of five services, so it may be broadcast
        .join(F.broadcast(services), "service_code")
        .withColumn("contracted_date", F.coalesce("registration_date", now))
    )
    newest = keep_latest(
        matched.select(
            "customer_id", "service_id", "status", "contracted_date", "_loaded_at", "_row_id"
        ),
        ["customer_id", "service_id"],
        [
            F.col("_loaded_at").desc_nulls_first(),
            F.col("contracted_date").desc_nulls_first(),
            F.col("_row_id").desc(),
        ],
    )
    return newest.select(
        "customer_id", "service_id", "status", "contracted_date",
        F.col("_loaded_at").alias("last_updated"),
    )


def dim_services(spark: SparkSession) -> DataFrame:
    """The fixed list of services."""
    rows = ", ".join(f"({number}, '{code}')" for number, code in V.SERVICES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS services(service_id, service_code)")

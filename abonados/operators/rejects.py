"""What cleaning lost: values that were given but are not in the result, and why.

A value of the wrong ``shape`` is none of the accepted forms, one of the right shape may
fail in ``conversion`` (a day that does not exist, a number too large), and one that
converts may be out of ``range``. Blank texts and JSON nulls were not given.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from abonados.functions import documents as D
from abonados.functions import parsing as P
from abonados.functions import vocabulary as V

REASONS = ("shape", "conversion", "range")
#: Column that carries reasons by field, before it is taken off again.
REJECTED = "_rejected"


def _given(text: Column) -> Column:
    """The text, NULL where it is blank."""
    return F.when(F.trim(text) != "", text)


def number_reason(
    value: Column, dtype: str = P.MONEY, low: float | None = None, high: float | None = None,
    whole: bool = False, positive: bool = False,
) -> Column:
    """Why a JSON value is no number of this kind; NULL if it is one or was not given.

    Most values convert, so that is asked first; what converts was given in an accepted shape.
    """
    text, schema = _given(F.try_variant_get(value, "$", "string")), F.schema_of_variant(value)
    accepted = D.is_number_schema(schema) | ((schema == "STRING") & text.rlike(V.SIGNED_NUMBER))
    number = P.rounded(value) if whole else P.parse_number(value, dtype)
    outside = [F.lit(False)]
    if low is not None:
        outside.append(number <= low if positive else number < low)
    if high is not None:
        outside.append(number > high)
    return (
        F.when(number.isNotNull(), F.when(reduce(lambda a, b: a | b, outside), "range"))
        .when(text.isNull(), None)
        .when(~F.coalesce(accepted, F.lit(False)), "shape")
        .otherwise("conversion")
    )


def loose_number_reason(text: Column, dtype: str = P.MONEY) -> Column:
    """Why the text of a field is no number."""
    return F.when(text.try_cast(dtype).isNull() & _given(text).isNotNull(), "conversion")


def timestamp_reason(text: Column) -> Column:
    """Why the text of a field is no timestamp; most are, so that is asked first."""
    return (
        F.when(P.parse_timestamp(text).isNotNull(), None)
        .when(_given(text).isNull(), None)
        .when(~P.has_timestamp_shape(text), "shape")
        .otherwise("conversion")
    )


def customer_reasons(document: Column) -> dict[str, Column]:
    """By field of a document, why its value is not in the customer's row. Fields that the
    row reads as text are read as text here too: a scan builds no variants of them."""

    def value(key: str) -> Column:
        return D.field(document, key)

    def text(key: str) -> Column:
        return D.field_text(document, key)

    return {
        "customer_id": F.when(
            D.is_number(value("customer_id")) & P.given_customer_id(document).isNull(), "conversion"
        ),
        "age": number_reason(value("age"), whole=True, low=0, high=120),
        "credit_score": number_reason(value("credit_score"), whole=True, low=0),
        "monthly_data_gb": number_reason(value("monthly_data_gb"), low=0),
        "monthly_bill_usd": number_reason(value("monthly_bill_usd")),
        "registration_date": timestamp_reason(text("registration_date")),
        "last_payment_date": timestamp_reason(text("last_payment_date")),
        "credit_limit": loose_number_reason(text("credit_limit")),
        "data_usage_current_month": loose_number_reason(text("data_usage_current_month")),
        "latitude": loose_number_reason(text("latitude"), P.COORDINATE),
        "longitude": loose_number_reason(text("longitude"), P.COORDINATE),
    }


def payment_reasons(payment: Column) -> dict[str, Column]:
    """By field of a payment, why it is not in the payment's row, or the payment left out."""
    return {
        "payment_date": timestamp_reason(D.field_text(payment, "date")),
        "payment_amount": number_reason(D.field(payment, "amount"), low=0, positive=True),
    }


def service_reasons(document: Column) -> dict[str, Column]:
    text = _given(D.field_text(document, "contracted_services"))
    lost = text.rlike(r"^\s*\[") & F.from_json(text, "array<string>").isNull()
    return {"contracted_services": F.when(lost, "shape")}


def with_reasons(reasons: dict[str, Column]) -> Column:
    """The reasons as one column for ``observed``."""
    return F.struct(*[reason.alias(field) for field, reason in reasons.items()]).alias(REJECTED)


def observed(df: DataFrame, observation: Observation) -> DataFrame:
    """Counts the reasons that rows carry, as they pass, and takes them off."""
    fields = df.schema[REJECTED].dataType.names
    counts = [
        F.count_if(F.col(f"{REJECTED}.{field}") == reason).alias(f"{field} {reason}")
        for field in fields
        for reason in REASONS
    ]
    return df.observe(observation, *counts).drop(REJECTED)


def counted(table: str, counts: dict[str, int]) -> list[tuple[str, str, str, int]]:
    """Observed counts as rows ``table_name``, ``field``, ``reason``, ``rejected``."""
    return [(table, *name.split(" "), n) for name, n in counts.items()]


COUNTS_SCHEMA = "table_name string, field string, reason string, rejected bigint"


def quarantine(bronze: DataFrame) -> DataFrame:
    """Every rejected value: ``_row_id``, ``field``, ``position`` (of the payment in its
    document, else NULL), ``reason`` and ``value`` as JSON text."""
    doc = F.col("data")
    sources = {"payment_date": "date", "payment_amount": "amount"}

    def entries(reasons: dict[str, Column], holder: Column, position: Column) -> Column:
        return F.array(
            *[
                F.struct(
                    F.lit(field).alias("field"), position.alias("position"), reason.alias("reason"),
                    F.to_json(D.field(holder, sources.get(field, field))).alias("value"),
                )
                for field, reason in reasons.items()
            ]
        )

    none = F.lit(None).cast("int")
    of_documents = bronze.select(
        "_row_id", F.inline(entries({**customer_reasons(doc), **service_reasons(doc)}, doc, none))
    )
    listed = bronze.select("_row_id", F.posexplode(D.elements(doc, "payment_history")).alias("position", "payment"))
    of_payments = listed.select(
        "_row_id", F.inline(entries(payment_reasons(F.col("payment")), F.col("payment"), F.col("position")))
    )
    return of_documents.unionByName(of_payments).filter(F.col("reason").isNotNull())

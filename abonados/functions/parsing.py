"""Turning messy text and JSON values into typed columns.

Values that have an accepted shape but cannot be converted (``13-45-2023``, a
number that overflows) become NULL. With ``strict=True`` they raise instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from abonados.functions import documents as D
from abonados.functions import vocabulary as V

MONEY = "decimal(18,6)"
COORDINATE = "decimal(12,8)"
WIDE = "decimal(38,18)"


def convert(value: Column, dtype: str, strict: bool = False) -> Column:
    return value.cast(dtype) if strict else value.try_cast(dtype)


def parse_timestamp(text: Column, strict: bool = False) -> Column:
    """Accepts ISO with ``T``, ``MM-DD-YYYY`` and ``YYYY-MM-DD``; NULL otherwise.

    An offset in an ISO text is not applied: the wall-clock time is kept.
    """
    month_first = "MM-dd-yyyy"
    parsed = (
        F.to_timestamp(text, month_first)
        if strict
        else F.try_to_timestamp(text, F.lit(month_first))
    )
    return (
        F.when(text.rlike(V.ISO_DATETIME), convert(text, "timestamp_ntz", strict).cast("timestamp"))
        .when(text.rlike(V.MONTH_DAY_YEAR), parsed)
        .when(text.rlike(V.YEAR_MONTH_DAY), convert(text, "date", strict).cast("timestamp"))
    )


def has_timestamp_shape(text: Column) -> Column:
    return (
        text.rlike(V.ISO_DATETIME) | text.rlike(V.MONTH_DAY_YEAR) | text.rlike(V.YEAR_MONTH_DAY)
    )


def parse_number(value: Column, dtype: str, strict: bool = False) -> Column:
    """A JSON number, or a JSON string in the shape of a plain decimal number.

    The number 1e3 is accepted, the string "1e3" is not.
    """
    schema = F.schema_of_variant(value)
    text = F.try_variant_get(value, "$", "string")
    get = F.variant_get if strict else F.try_variant_get
    return F.when(
        schema == "STRING", F.when(text.rlike(V.SIGNED_NUMBER), convert(text, dtype, strict))
    ).when(D.is_number_schema(schema), get(value, "$", dtype))


def number_field(document: Column, key: str, dtype: str = MONEY, strict: bool = False) -> Column:
    return parse_number(D.field(document, key), dtype, strict)


def non_negative(number: Column) -> Column:
    return F.when(number >= 0, number)


def rounded(value: Column, strict: bool = False) -> Column:
    """The nearest whole number, halves away from zero."""
    return convert(F.round(parse_number(value, WIDE, strict), 0), "int", strict)


def age(years: Column) -> Column:
    return F.when(years.between(0, 120), years)


def age_field(document: Column, key: str = "age", strict: bool = False) -> Column:
    return age(rounded(D.field(document, key), strict))


def credit_score_field(document: Column, key: str = "credit_score", strict: bool = False) -> Column:
    return non_negative(rounded(D.field(document, key), strict))


def loose_number_field(document: Column, key: str, dtype: str, strict: bool = False) -> Column:
    """Whatever the engine can convert to a number, without a check of its shape."""
    return convert(D.field_text(document, key), dtype, strict)


def given_customer_id(document: Column, strict: bool = False) -> Column:
    """The id a document brings itself: a JSON number or a string of digits."""
    value = D.field(document, "customer_id")
    schema = F.schema_of_variant(value)
    text = F.try_variant_get(value, "$", "string")
    number = F.try_variant_get(value, "$", WIDE)
    whole = F.when(number == F.floor(number), number)
    if strict:
        fraction = F.raise_error(F.lit("customer_id is no whole number")).cast(WIDE)
        whole = F.coalesce(whole, F.when(number.isNotNull(), fraction))
    return (
        F.when(schema == "BIGINT", F.try_variant_get(value, "$", "bigint"))
        .when(schema == "STRING", F.when(text.rlike(V.DIGITS), convert(text, "bigint", strict)))
        .when(D.is_number_schema(schema), convert(whole, "bigint", strict))
    )


def customer_id(document: Column, row_id: Column, strict: bool = False) -> Column:
    """The given id, or a surrogate from the stored row number.

    A JSON number that is no whole number yields NULL rather than a surrogate.
    """
    surrogate = F.lit(V.SURROGATE_BASE) + row_id
    return F.coalesce(
        given_customer_id(document, strict),
        F.when(~D.is_number(D.field(document, "customer_id")), surrogate),
    )


def service_tokens(text: Column) -> Column:
    """Names in a JSON array or in a comma-separated list, as an array of text."""
    listed = F.regexp_replace(F.regexp_replace(text, r'[\[\]"]', ""), r"\s+", "")
    return F.when(text.rlike(r"^\s*\["), F.from_json(text, "array<string>")).otherwise(
        F.split(listed, ",")
    )


def payment_id(given: Column, customer: Column, payment: Column) -> Column:
    """The given id, or a hash of the customer and the payment's JSON text."""
    return F.coalesce(
        given, F.md5(F.concat(customer.cast("string"), F.lit("_"), D.json_text(payment)))
    )

"""Reading fields of raw documents held in a variant column.

A path that is read with a literal key and type reaches the Parquet scan, so a
query that reads three fields of a document reads three shredded columns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def field(document: Column, key: str) -> Column:
    """The field as a variant; NULL if the key is absent. A JSON null is not NULL."""
    return F.variant_get(document, f"$.{key}", "variant")


def field_text(document: Column, key: str) -> Column:
    """The field as text: strings as they are, JSON null as NULL, the rest as JSON."""
    return F.variant_get(document, f"$.{key}", "string")


def has_field(document: Column, key: str) -> Column:
    """Whether the key exists, be its value JSON null."""
    return field(document, key).isNotNull()


def json_kind(value: Column) -> Column:
    """``number``, ``string``, ``boolean``, ``array``, ``object`` or ``null``."""
    schema = F.schema_of_variant(value)
    return (
        F.when(value.isNull(), F.lit(None).cast("string"))
        .when(schema == "STRING", "string")
        .when(schema == "VOID", "null")
        .when(schema == "BOOLEAN", "boolean")
        .when(schema.startswith("ARRAY"), "array")
        .when(schema.startswith("OBJECT"), "object")
        .otherwise("number")
    )


def field_kind(document: Column, key: str) -> Column:
    return json_kind(field(document, key))


def is_usable(document: Column, key: str) -> Column:
    """The key exists, is not JSON null and is not the word ``null``."""
    text = field_text(document, key)
    return text.isNotNull() & (text != "null")


def is_number(value: Column) -> Column:
    """Whether a variant is a JSON number; false for an absent one."""
    return F.coalesce(is_number_schema(F.schema_of_variant(value)), F.lit(False))


def is_number_schema(schema: Column) -> Column:
    """Whether ``schema_of_variant`` names one of the kinds JSON numbers are read as."""
    return (schema == "BIGINT") | (schema == "DOUBLE") | schema.startswith("DECIMAL")


def is_array(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("ARRAY"), F.lit(False))


def elements(document: Column, key: str) -> Column:
    """Elements of an array field as variants; NULL for any other kind."""
    return F.try_variant_get(document, f"$.{key}", "array<variant>")


def json_text(value: Column) -> Column:
    """JSON text of a variant, with its keys sorted."""
    return F.to_json(value)

"""Fields of a JSON object held as VARIANT, with absent and null kept apart."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the text a null field turns into when it is made a string.
NULL_TEXT = "null"


def field(document: Column, name: str) -> Column:
    """SQL NULL if the key is absent, a variant (maybe the JSON null) if present."""
    return F.try_variant_get(document, f"$.{name}", "variant")


def text(value: Column) -> Column:
    """The field as text; SQL NULL for both an absent and a null field."""
    return F.try_variant_get(value, "$", "string")


def text_at(document: Column, name: str) -> Column:
    """``text`` of a field, for fields where absent and null are the same."""
    return F.try_variant_get(document, f"$.{name}", "string")


def text_or_default(value: Column, default: Column) -> Column:
    """``default`` only if the key is absent; a present null gives the text ``null``."""
    return F.when(value.isNull(), default).otherwise(F.coalesce(text(value), F.lit(NULL_TEXT)))


def object_or_null(value: Column) -> Column:
    """The field if it is a JSON object, else NULL."""
    return F.when(F.try_variant_get(value, "$", "map<string,variant>").isNotNull(), value)


# Spark's limit for one variant.
VARIANT_BYTES = 128 * 1024 * 1024


def is_object_text(json: Column) -> Column:
    """True for JSON text whose outermost value is an object, if it is valid at all."""
    return F.ltrim(json, F.lit(" \t\r\n")).startswith("{")


def read_json(json: Column) -> Column:
    """The text of an object as a variant, whatever the length of its fields; else NULL.

    ``try_parse_json`` stops at fields of 20 million characters. The variant
    itself may not exceed ``VARIANT_BYTES``.
    """
    parsed = F.from_json(json, "variant", {"maxStringLen": str(2**31 - 1)})
    return F.when(is_object_text(json), parsed)


def is_too_large(json: Column) -> Column:
    """True for a text that may be fine but is longer than a variant can be."""
    return is_object_text(json) & (F.octet_length(json) > VARIANT_BYTES)


def not_blank(value: Column) -> Column:
    """True if there is a character that is no white space, Unicode spaces included."""
    return F.coalesce(value.rlike(r"\P{javaWhitespace}"), F.lit(False))

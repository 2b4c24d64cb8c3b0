"""Content types, object keys and base64 content of images."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from eventpipe.functions.json_fields import not_blank

# Fixed values.
DEFAULT_CONTENT_TYPE = "image/jpeg"
EXTENSIONS = (("png", ".png"), ("webp", ".webp"), ("gif", ".gif"))
DEFAULT_EXTENSION = ".jpg"
KEY_PREFIX = "images/"

BASE64_ALPHABET = r"^[A-Za-z0-9+/]*={0,2}\z"


def effective_content_type(declared: Column, from_response: Column) -> Column:
    """The response's type if it has one, else the declared type if not blank."""
    return F.coalesce(
        from_response, F.when(not_blank(declared), declared), F.lit(DEFAULT_CONTENT_TYPE)
    )


def extension(content_type: Column) -> Column:
    lowered = F.lower(content_type)
    chain = F
    for word, ending in EXTENSIONS:
        chain = chain.when(lowered.contains(word), F.lit(ending))
    return chain.otherwise(F.lit(DEFAULT_EXTENSION))


def object_key(date: Column, id: Column, content_type: Column) -> Column:
    return F.concat(
        F.lit(KEY_PREFIX), F.date_format(date, "yyyy-MM-dd"), F.lit("/"), id, extension(content_type)
    )


def encode_base64(content: Column) -> Column:
    """Base64 in one line; the built-in function breaks lines after 76 characters."""
    return F.replace(F.base64(content), F.lit("\r\n"), F.lit(""))


def is_strict_base64(text: Column) -> Column:
    """RFC 4648 alphabet only, padding either whole or left out."""
    size = F.length(text)
    padded = text.endswith("=")
    return text.rlike(BASE64_ALPHABET) & F.when(padded, size % 4 == 0).otherwise(size % 4 != 1)


def decoded_size(text: Column) -> Column:
    """Number of bytes of strict base64 text, with or without padding."""
    digits = F.length(F.rtrim(text, F.lit("=")))
    return F.floor(digits * 3 / 4).cast("bigint")


def decode_base64(text: Column) -> Column:
    """The bytes, or NULL if the text is not strict base64."""
    return F.when(is_strict_base64(text), F.unbase64(text))

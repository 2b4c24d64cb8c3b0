"""From image events to stored objects."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from eventpipe.functions.images import (
    decode_base64,
    decoded_size,
    effective_content_type,
    is_strict_base64,
    object_key,
)
from eventpipe.functions.json_fields import not_blank
from eventpipe.operators.routing import IMAGE
from eventpipe.schemas import IMAGE_OBJECTS, PLACE

BASE64, URL, NOTHING = "base64", "url", "none"

BAD_BASE64 = "bad_base64"
FETCH_FAILED = "fetch_failed"
FETCH_STATUS = "fetch_status_"
FETCH_TOO_LARGE = "fetch_too_large"


def with_kind(images: DataFrame) -> DataFrame:
    """Where the bytes come from: base64 text goes before a URL; blank text is none."""
    return images.withColumn(
        "kind",
        F.when(not_blank(F.col("image_base64")), BASE64)
        .when(not_blank(F.col("image_url")), URL)
        .otherwise(NOTHING),
    )


def skipped_images(images: DataFrame) -> DataFrame:
    """Image events without bytes: no object and no row, yet they are counted."""
    return with_kind(images).where(F.col("kind") == NOTHING)


def resolve_images(images: DataFrame, fetch: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """One row per image event that has bytes, with object or reason.

    ``fetch`` takes the events whose bytes lie behind ``image_url`` and adds
    the columns of ``schemas.RESPONSE``; status NULL means there was no response.
    Base64 events are decoded where they are and take no part in the fetch.
    """
    return resolve_inline(images).unionByName(resolve_linked(images, fetch))


def resolve_inline(images: DataFrame) -> DataFrame:
    inline = with_kind(images).where(F.col("kind") == BASE64)
    strict = is_strict_base64(F.col("image_base64"))
    return _objects(
        inline.withColumn("content", decode_base64(F.col("image_base64")))
        # Worked out from the text: listings need no decoded bytes.
        .withColumn("size", F.when(strict, decoded_size(F.col("image_base64"))))
        .withColumn("response_type", F.lit(None).cast("string"))
        .withColumn("reason", F.when(~strict, BAD_BASE64))
    )


def resolve_linked(images: DataFrame, fetch: Callable[[DataFrame], DataFrame]) -> DataFrame:
    linked = with_kind(images).where(F.col("kind") == URL).drop("image_base64", "payload", "kind")
    ok = F.col("status").between(200, 299)
    failure = F.when(F.col("status").isNull(), F.lit(FETCH_FAILED)).when(
        ~ok, F.concat(F.lit(FETCH_STATUS), F.col("status").cast("string"))
    ).when(F.col("response_content").isNull(), FETCH_TOO_LARGE)
    return _objects(
        fetch(linked)
        .withColumn("content", F.when(ok, F.col("response_content")))
        .withColumn("size", F.octet_length("content").cast("bigint"))
        .withColumn("reason", failure)
    )


def _objects(resolved: DataFrame) -> DataFrame:
    content_type = effective_content_type(F.col("image_content_type"), F.col("response_type"))
    failed = F.col("reason").isNotNull()
    typed = resolved.withColumn("content_type", content_type)
    return (
        typed.withColumn(
            "object_key", F.when(~failed, object_key(F.col("date"), F.col("id"), F.col("content_type")))
        )
        # The raw record is kept for the quarantine only.
        .withColumn("value", F.when(failed, F.col("value")))
        .select(*IMAGE_OBJECTS.names)
    )


def stored_objects(resolved: DataFrame) -> DataFrame:
    return resolved.where(F.col("reason").isNull())


def failed_records(parsed: DataFrame) -> DataFrame:
    """Bad records and images with bad base64, in one pass over parsed records."""
    inline = (F.col("event_type") == IMAGE) & not_blank(F.col("image_base64"))
    broken = F.when(inline & ~is_strict_base64(F.col("image_base64")), BAD_BASE64)
    reasons = parsed.withColumn("reason", F.coalesce("reason", broken))
    return reasons.where(F.col("reason").isNotNull()).select("value", "reason", *PLACE)


def failed_images(resolved: DataFrame) -> DataFrame:
    return resolved.where(F.col("reason").isNotNull()).select("value", "reason", *PLACE)

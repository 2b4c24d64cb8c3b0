"""Producer side: requests and uploaded files to topic records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eventpipe.functions.images import encode_base64
from eventpipe.functions.instants import instant_text
from eventpipe.functions.json_fields import field, not_blank, read_json, text

# Fixed values.
SOURCE = "ui"
UPLOAD_TYPE = "IMAGE"
UPLOAD_CONTENT_TYPE = "application/octet-stream"

BAD_BODY = "bad_body"
BLANK_TYPE = "blank_event_type"
EMPTY_FILE = "empty_file"


def parse_requests(bodies: DataFrame, column: str = "body") -> DataFrame:
    """Request bodies (JSON text) to ``event_type``, ``payload``, ``image_url``, ``reason``.

    A body is turned down if it is no object, if the type is blank or not
    given, if type or URL is an object or array, or if the payload is given
    but is no object.
    """
    document = read_json(F.col(column))
    parsed = bodies.select("*", F.explode(F.array(document)).alias("document"))
    document = F.col("document")
    fields = parsed.select(
        *bodies.columns,
        document.isNull().alias("no_object"),
        *[field(document, n).alias(f"{n}_field") for n in ("eventType", "payload", "imageUrl")],
    )

    def is_nested(name: str) -> Column:
        value = F.col(f"{name}_field")
        return (
            F.try_variant_get(value, "$", "map<string,variant>").isNotNull()
            | F.try_variant_get(value, "$", "array<variant>").isNotNull()
        )

    given = F.when(~F.is_variant_null("payload_field"), F.col("payload_field"))
    payload = F.when(
        F.try_variant_get(given, "$", "map<string,variant>").isNotNull(), given
    )
    bad_body = (
        F.col("no_object")
        | is_nested("eventType")
        | is_nested("imageUrl")
        | (given.isNotNull() & payload.isNull())
    )
    event_type = text(F.col("eventType_field"))
    # Validation trims every character up to the blank, and only those.
    blank = ~F.coalesce(event_type.rlike(r"[^\x00-\x20]"), F.lit(False))
    return fields.select(
        *bodies.columns,
        event_type.alias("event_type"),
        payload.alias("payload"),
        text(F.col("imageUrl_field")).alias("image_url"),
        F.when(bad_body, BAD_BODY).when(blank, BLANK_TYPE).alias("reason"),
    )


def accepted(requests: DataFrame) -> DataFrame:
    return requests.where(F.col("reason").isNull()).drop("reason")


def rejected(requests: DataFrame) -> DataFrame:
    return requests.where(F.col("reason").isNotNull())


def _identity(id: Column | None, event_time: Column | None) -> tuple[Column, Column]:
    """New id and present time, unless the caller has its own columns for them."""
    return (
        F.uuid() if id is None else id,
        F.current_timestamp() if event_time is None else event_time,
    )


def build_envelopes(
    requests: DataFrame, id: Column | None = None, event_time: Column | None = None
) -> DataFrame:
    """Accepted requests to records ``key``, ``value``; ``id``, ``event_time`` are the answer.

    A random id differs whenever the plan is run again. Where records are sent
    and answered from one DataFrame, write it first or pass an ``id`` column.
    """
    id, event_time = _identity(id, event_time)
    drawn = requests.withColumn("id", id).withColumn("event_time", event_time)
    # Fields that are NULL are left out of the JSON.
    envelope = F.struct(
        F.col("id").alias("id"),
        F.col("event_type").alias("eventType"),
        instant_text(F.col("event_time")).alias("eventTime"),
        F.lit(SOURCE).alias("source"),
        F.col("payload").alias("payload"),
        F.when(not_blank(F.col("image_url")), F.col("image_url")).alias("imageUrl"),
    )
    return drawn.select(
        F.col("id").alias("key"), F.to_json(envelope).alias("value"), "id", "event_time"
    )


def validate_uploads(files: DataFrame) -> DataFrame:
    """Files (``content``, maybe ``content_type``) with ``reason`` set for empty ones."""
    empty = F.coalesce(F.length("content"), F.lit(0)) == 0
    return files.withColumn("reason", F.when(empty, EMPTY_FILE))


def build_upload_envelopes(
    files: DataFrame, id: Column | None = None, event_time: Column | None = None
) -> DataFrame:
    """Accepted files to image records that carry the bytes as base64."""
    id, event_time = _identity(id, event_time)
    declared = F.col("content_type") if "content_type" in files.columns else F.lit(None)
    drawn = files.withColumn("id", id).withColumn("event_time", event_time)
    envelope = F.struct(
        F.col("id").alias("id"),
        F.lit(UPLOAD_TYPE).alias("eventType"),
        instant_text(F.col("event_time")).alias("eventTime"),
        F.lit(SOURCE).alias("source"),
        encode_base64(F.col("content")).alias("imageBase64"),
        F.coalesce(declared, F.lit(UPLOAD_CONTENT_TYPE)).alias("imageContentType"),
    )
    return drawn.select(
        F.col("id").alias("key"), F.to_json(envelope).alias("value"), "id", "event_time"
    )

"""Topic records to typed events, and to reasons where a record is unusable."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventpipe.functions.identity import canonical_uuid, uuid_from_position
from eventpipe.functions.images import DEFAULT_CONTENT_TYPE
from eventpipe.functions.instants import parse_instant
from eventpipe.functions.json_fields import (
    field,
    is_too_large,
    object_or_null,
    read_json,
    text,
    text_at,
    text_or_default,
)
from eventpipe.schemas import PLACE

# What an event without the key gets.
DEFAULT_TYPE = "UNKNOWN"
DEFAULT_SOURCE = "unknown"

BAD_JSON = "bad_json"
TOO_LARGE = "too_large"
BAD_ID = "bad_id"
BAD_TIME = "bad_time"


def parse_events(records: DataFrame) -> DataFrame:
    """Read the JSON in ``value`` of topic records into event columns.

    ``reason`` is NULL for a usable event. An event without id or time gets
    its id from the record's place in the topic and its time from the record,
    so that every query and every replay sees the same event. Other columns
    that the records carry (``inserted_at``, say) are kept.
    """
    # Catalyst moves a filter below a projection and repeats the projected
    # expression in it. It does not move one below a generator, so the one-row
    # generator makes sure that JSON, the dear part, is read once per record.
    # (A second one, for id and time, lost columns in a large plan on Spark 4.1.2.)
    # Projections after it hold what the next step uses more than once.
    document = read_json(F.col("value"))
    documents = records.select("*", F.explode(F.array(document)).alias("document"))
    document = F.col("document")
    fields = documents.select(
        "*",
        *[field(document, n).alias(f"{n}_field") for n in ("id", "eventType", "eventTime", "source")],
    )
    texts = fields.select(
        "*",
        text(F.col("id_field")).alias("id_text"),
        F.upper(text(F.col("eventTime_field"))).alias("time_text"),
    )
    place = uuid_from_position(F.col("topic"), F.col("partition"), F.col("offset"))
    id = F.when(F.col("id_field").isNull(), place).otherwise(canonical_uuid(F.col("id_text")))
    event_time = F.when(F.col("eventTime_field").isNull(), F.col("timestamp")).otherwise(
        parse_instant(F.col("time_text"))
    )
    checked = texts.withColumn("id", id).withColumn("event_time", event_time)

    image_type = text_at(document, "imageContentType")
    kept = [c for c in records.columns if c not in ("key", "topic", "partition", "offset", "timestamp")]
    return checked.select(
        "id",
        F.upper(text_or_default(F.col("eventType_field"), F.lit(DEFAULT_TYPE))).alias("event_type"),
        "event_time",
        text_or_default(F.col("source_field"), F.lit(DEFAULT_SOURCE)).alias("source"),
        object_or_null(field(document, "payload")).alias("payload"),
        text_at(document, "imageUrl").alias("image_url"),
        text_at(document, "imageBase64").alias("image_base64"),
        F.coalesce(image_type, F.lit(DEFAULT_CONTENT_TYPE)).alias("image_content_type"),
        F.to_date("event_time").alias("date"),
        F.when(document.isNull() & is_too_large(F.col("value")), F.lit(TOO_LARGE))
        .when(document.isNull(), F.lit(BAD_JSON))
        .when(F.col("id").isNull(), F.lit(BAD_ID))
        .when(F.col("event_time").isNull(), F.lit(BAD_TIME))
        .alias("reason"),
        *kept,
        F.col("timestamp").alias("src_time"),
        F.col("partition").alias("src_partition"),
        F.col("offset").alias("src_offset"),
    )


def good_events(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNull())


def bad_records(parsed: DataFrame) -> DataFrame:
    """Records to quarantine, whole, with the reason."""
    return parsed.where(F.col("reason").isNotNull()).select("value", "reason", *PLACE)


def require_good(parsed: DataFrame) -> DataFrame:
    """Strict mode: the first unusable record fails the job."""
    place = F.concat_ws(":", F.col("src_partition").cast("string"), F.col("src_offset").cast("string"))
    message = F.concat(F.lit("unusable record at "), place, F.lit(": "), F.col("reason"))
    return parsed.where(
        F.when(F.col("reason").isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    )

"""Schemas of the tables that jobs read and write."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, INT, BIGINT, TIME, DATE = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.TimestampType(),
    T.DateType(),
)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Where a record stands among all of them, in order: when it entered the topic, then its place there. A place alone
# does not do: an id may move to another partition, and a topic made anew begins at 0 again. Records of one partition
# are in the order of their offsets if the broker stamps them (LogAppendTime) or their sender's clock does not go back.
PLACE = ("src_time", "src_partition", "src_offset")

# A record as it lies in a topic. File dumps of a topic have the same columns.
TOPIC = _schema(key=TEXT, value=TEXT, topic=TEXT, partition=INT, offset=BIGINT, timestamp=TIME)

PROCESSED_EVENTS = _schema(
    id=TEXT,
    event_type=TEXT,
    event_time=TIME,
    source=TEXT,
    payload=T.VariantType(),
    image_object_key=TEXT,
    inserted_at=TIME,
    src_time=TIME,
    src_partition=INT,
    src_offset=BIGINT,
)

EVENT_TYPE_COUNTS_5M = _schema(
    window_start=TIME, window_end=TIME, event_type=TEXT, event_count=BIGINT, updated_at=TIME
)

# Counts of closed windows in parts (``event_count``), and events that came too late for theirs (no count).
WINDOW_RESULTS = _schema(
    window_start=TIME, window_end=TIME, event_type=TEXT, event_count=BIGINT, watermark=TIME,
    id=TEXT, source=TEXT, event_time=TIME, src_time=TIME, src_partition=INT, src_offset=BIGINT,
)

# Additions and retractions: what rows count for, by hour and type.
ROW_TOTALS = _schema(hour=TIME, event_type=TEXT, n_rows=BIGINT, n_image_rows=BIGINT, n_objects=BIGINT)

# What a fetch adds to an event with an ``image_url``.
RESPONSE = _schema(status=INT, response_type=TEXT, response_content=T.BinaryType())

# Every resolved image of a batch, failed ones too (``reason`` set, no content).
IMAGE_OBJECTS = _schema(
    object_key=TEXT,
    content_type=TEXT,
    content=T.BinaryType(),
    size=BIGINT,
    date=DATE,
    id=TEXT,
    event_type=TEXT,
    event_time=TIME,
    source=TEXT,
    inserted_at=TIME,
    reason=TEXT,
    value=TEXT,
    src_time=TIME,
    src_partition=INT,
    src_offset=BIGINT,
)

QUARANTINE = _schema(value=TEXT, reason=TEXT, src_time=TIME, src_partition=INT, src_offset=BIGINT, seen_at=TIME)

"""Which events go to which table. Counts take all types and need no route."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

IMAGE = "IMAGE"
DATA = "DATA"


def image_events(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == IMAGE)


def data_events(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == DATA)


def unrouted_events(events: DataFrame) -> DataFrame:
    """Events of other types: counted per window, written to no row table."""
    return events.where(~F.col("event_type").isin(IMAGE, DATA))

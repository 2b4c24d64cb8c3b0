"""Events per type in five-minute event-time windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values.
WINDOW = "5 minutes"
LATENESS = "10 seconds"


def _by_window(events: DataFrame, *more: Column) -> DataFrame:
    counted = events.groupBy(F.window("event_time", WINDOW).alias("span"), "event_type").agg(
        F.count("*").alias("event_count"), *more
    )
    return counted.select(
        F.col("span.start").alias("window_start"),
        F.col("span.end").alias("window_end"),
        *[c for c in counted.columns if c != "span"],
    )


def count_by_window(events: DataFrame) -> DataFrame:
    """Count every event of every type, repeats included; empty windows give no row.

    Partial counts are made before the shuffle, so a type or window that holds
    most events sends one row per task.
    """
    return _by_window(events)


def count_stream(events: DataFrame) -> DataFrame:
    """Streaming form: in append mode a window comes out once, when it has closed."""
    return count_by_window(
        events.select("event_time", "event_type").withWatermark("event_time", LATENESS)
    )


def closed_counts(events: DataFrame) -> DataFrame:
    """Batch counterpart of append mode: windows that the latest event has closed.

    The latest time is worked out from the counts. Both uses of the counts need
    all their columns and neither can be moved below them, so that Spark runs
    the pass over the events once and takes its shuffle output twice.
    """
    counts = _by_window(events, F.max("event_time").alias("latest"))
    counted = (F.col("event_count") > 0) & F.col("latest").isNotNull()
    latest = counts.agg(F.max(F.when(counted, F.col("latest")))).scalar()
    closed = F.col("window_end") + F.expr(f"INTERVAL {LATENESS}") <= latest
    return counts.where(F.when(counted, closed)).drop("latest")

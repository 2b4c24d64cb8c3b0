"""Reports and dashboard series over processed events and window counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value.
LATEST_ROWS = 20


def count_by_type(processed: DataFrame) -> DataFrame:
    return (
        processed.groupBy("event_type")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "event_type")
    )


def _latest(processed: DataFrame, columns: list[str], rows: int) -> DataFrame:
    # One micro-batch stamps all its rows alike, so the id breaks ties.
    return processed.select(*columns).orderBy(F.desc("inserted_at"), "id").limit(rows)


def latest_events(processed: DataFrame, rows: int = LATEST_ROWS) -> DataFrame:
    columns = ["id", "event_type", "event_time", "source", "image_object_key", "inserted_at"]
    return _latest(processed, columns, rows)


def count_by_hour(processed: DataFrame) -> DataFrame:
    return (
        processed.groupBy(F.date_trunc("hour", "event_time").alias("hour"), "event_type")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("hour"), "event_type")
    )


def count_by_hour_from_totals(totals: DataFrame) -> DataFrame:
    """``count_by_hour`` from totals that are kept up to date; reads no rows."""
    hours = totals.where(F.col("n_rows") > 0)
    return hours.select("hour", "event_type", F.col("n_rows").alias("count")).orderBy(F.desc("hour"), "event_type")


def window_counts(counts: DataFrame) -> DataFrame:
    return counts.select("window_start", "window_end", "event_type", "event_count").orderBy(
        F.desc("window_start"), "event_type"
    )


def panel_count_by_type(processed: DataFrame) -> DataFrame:
    return (
        processed.groupBy(F.col("event_type").alias("type"))
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "type")
    )


def panel_latest_events(processed: DataFrame, rows: int = LATEST_ROWS) -> DataFrame:
    columns = ["id", "event_type", "event_time", "image_object_key", "inserted_at"]
    return _latest(processed, columns, rows)


def last_hours(hours: int = 6) -> tuple[Column, Column]:
    """The range a dashboard opens with: from some hours ago to now."""
    now = F.current_timestamp()
    return now - F.expr(f"INTERVAL {int(hours)} HOURS"), now


def panel_hourly(processed: DataFrame, low: Column, high: Column) -> DataFrame:
    """Events per epoch hour and type; both ends of the range count."""
    return (
        processed.where(F.col("event_time").between(low, high))
        .groupBy(F.window("event_time", "1 hour").start.alias("time"), "event_type")
        .agg(F.count("*").alias("value"))
        .select("time", "value", F.col("event_type").alias("metric"))
        .orderBy("time", "metric")
    )


def panel_window_counts(counts: DataFrame, low: Column, high: Column) -> DataFrame:
    """The window counts as a series; the range is one of window starts."""
    return (
        counts.where(F.col("window_start").between(low, high))
        .select(
            F.col("window_start").alias("time"),
            F.col("event_count").alias("value"),
            F.col("event_type").alias("metric"),
        )
        .orderBy("time", "metric")
    )

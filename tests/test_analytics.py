import datetime as dt

from pyspark.sql import functions as F

from eventpipe.operators.counts import closed_counts, count_by_window
from eventpipe.plans import analytics
from eventpipe.plans.reconcile import sum_image_counts
from eventpipe.schemas import EVENT_TYPE_COUNTS_5M, PROCESSED_EVENTS

UTC = dt.timezone.utc


def at(day, hour=0, minute=0, second=0):
    return dt.datetime(2024, 1, day, hour, minute, second, tzinfo=UTC)


def processed(spark, *events):
    rows = [
        (f"id{i:03d}", kind, when, "ui", None, None, inserted, inserted, 0, i)
        for i, (kind, when, inserted) in enumerate(events)
    ]
    return spark.createDataFrame(rows, PROCESSED_EVENTS)


def clock(frame, column):
    return [r[0] for r in frame.select(F.date_format(column, "dd HH:mm")).collect()]


def test_order_of_reports(spark):
    table = processed(
        spark, ("A", at(1, 5, 59), at(3)), ("B", at(1, 6), at(2)), ("B", at(1, 6, 30), at(2)), ("A", at(1, 6, 1), at(1))
    )
    assert [tuple(r) for r in analytics.count_by_type(table).collect()] == [("A", 2), ("B", 2)]
    hours = analytics.count_by_hour(table)
    assert clock(hours, "hour") == ["01 06:00", "01 06:00", "01 05:00"]
    assert [(r.event_type, r["count"]) for r in hours.collect()] == [("A", 1), ("B", 2), ("A", 1)]
    assert [r.id for r in analytics.latest_events(table).collect()] == ["id000", "id001", "id002", "id003"]
    assert analytics.latest_events(table, 2).count() == 2
    assert "source" not in analytics.panel_latest_events(table).columns


def test_latest_is_a_top_k_and_no_full_sort(spark):
    plan = analytics.latest_events(processed(spark, ("A", at(1), at(1))))._jdf.queryExecution().executedPlan()
    assert "TakeOrderedAndProject" in plan.toString()


def test_both_ends_of_a_range_count(spark):
    table = processed(spark, *[("A", at(1, h), at(1)) for h in (5, 6, 7, 8)])
    low, high = F.lit(at(1, 6)), F.lit(at(1, 7))
    assert clock(analytics.panel_hourly(table, low, high), "time") == ["01 06:00", "01 07:00"]
    counts = spark.createDataFrame(
        [(at(1, h), at(1, h, 5), "A", 1, at(1)) for h in (5, 6, 7, 8)], EVENT_TYPE_COUNTS_5M
    )
    assert clock(analytics.panel_window_counts(counts, low, high), "time") == ["01 06:00", "01 07:00"]
    assert clock(analytics.window_counts(counts), "window_start")[0] == "01 08:00"
    assert analytics.panel_hourly(table, *analytics.last_hours()).count() == 0


def test_sum_of_nothing_is_zero(spark):
    assert sum_image_counts(spark.createDataFrame([], EVENT_TYPE_COUNTS_5M)).first().total == 0


def test_windows_and_their_closing(spark):
    events = processed(
        spark, ("A", at(1, 0, 0), at(1)), ("A", at(1, 0, 4, 59), at(1)), ("B", at(1, 0, 5), at(1)), ("A", at(1, 0, 10, 9), at(1))
    )
    assert sorted(clock(count_by_window(events), "window_start")) == ["01 00:00", "01 00:05", "01 00:10"]
    assert [tuple(r)[2:] for r in closed_counts(events).collect()] == [("A", 2)]
    later = events.union(processed(spark, ("C", at(1, 0, 10, 10), at(1))))
    assert sorted(clock(closed_counts(later), "window_start")) == ["01 00:00", "01 00:05"]
    assert closed_counts(events.limit(0)).count() == 0


def test_closed_counts_read_the_events_once(spark):
    frame = closed_counts(processed(spark, ("A", at(1), at(1)), ("B", at(2), at(1))))
    frame.collect()
    assert "ReusedExchange" in frame._jdf.queryExecution().executedPlan().toString()

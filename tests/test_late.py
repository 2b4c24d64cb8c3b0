import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventpipe.streaming.jobs import start_counts, start_counts_and_late
from eventpipe.streaming.warehouse import Warehouse
from test_stream import ONCE, counted, feed, typed, warehouse  # noqa: F401


def late(warehouse):
    found = warehouse.late_events().select(F.date_format("event_time", "mm:ss").alias("at"), "event_type", F.date_format("window_start", "mm:ss").alias("start"))
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize(
    "batches, expected, too_late",
    [
        ([["D 01:00"], ["D 05:09.999"], ["D 04:00"]], {}, []),
        # The window has closed when the third batch begins: the row is late, and the engine's own aggregate would count it.
        (
            [["D 01:00"], ["D 05:10"], ["D 04:00", "I 05:01"], ["D 10:10"]],
            {("00:00", "D"): 1, ("00:05", "D"): 1, ("00:05", "I"): 1},
            [("04:00", "D", "00:00")],
        ),
        (
            [["D 01:00"], ["D 05:10"], ["D 06:00"], ["D 04:00", "X 03:00", "D 04:00"], ["D 30:00"]],
            {("00:00", "D"): 1, ("00:05", "D"): 2},
            [("03:00", "X", "00:00"), ("04:00", "D", "00:00"), ("04:00", "D", "00:00")],
        ),
        # Over ten seconds late, but the window is open.
        ([["D 04:00"], ["D 01:00"], ["D 06:00"]], {("00:00", "D"): 2}, []),
        ([["D 30:00", "D 01:00"]], {("00:00", "D"): 1}, []),
    ],
)
def test_rows_that_come_after_their_window_closed(feed, warehouse, tmp_path, batches, expected, too_late):  # noqa: F811
    for batch in batches:
        feed.put(*[typed(*text.split()) for text in batch])
    start_counts_and_late(feed.stream(), warehouse, str(tmp_path / "cp"), ONCE, slots=3).awaitTermination()
    assert counted(warehouse) == expected
    assert late(warehouse) == too_late


def test_state_survives_a_restart_and_a_replay(feed, warehouse, tmp_path):  # noqa: F811
    def run():
        start_counts_and_late(feed.stream(), warehouse, str(tmp_path / "cp"), ONCE, slots=3).awaitTermination()

    feed.put(typed("D", "01:00"), typed("D", "02:00"))
    run()
    feed.put(typed("D", "03:00"), typed("D", "06:00"))
    run()
    feed.put(typed("D", "04:00"), typed("D", "11:00"))
    run()
    assert counted(warehouse) == {("00:00", "D"): 3, ("00:05", "D"): 1} and late(warehouse) == [("04:00", "D", "00:00")]
    # The last batch runs again.
    commits = tmp_path / "cp/commits"
    last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
    for name in (str(last), f".{last}.crc"):
        (commits / name).unlink(missing_ok=True)
    run()
    assert counted(warehouse) == {("00:00", "D"): 3, ("00:05", "D"): 1} and late(warehouse) == [("04:00", "D", "00:00")]


def test_counts_are_those_of_the_window_aggregate_if_nothing_is_late(spark, feed, warehouse, tmp_path):  # noqa: F811
    start = dt.datetime(2024, 1, 1)
    for batch in range(3):
        feed.put(*[
            {"eventType": "ABC"[(i * i) % 3], "eventTime": (start + dt.timedelta(seconds=11 * i)).strftime("%Y-%m-%dT%H:%M:%SZ")}
            for i in range(batch * 100, batch * 100 + 100)
        ])
    start_counts_and_late(feed.stream(), warehouse, str(tmp_path / "cp"), ONCE, slots=5).awaitTermination()
    ours = counted(warehouse)
    assert late(warehouse) == []
    other = Warehouse(spark, str(tmp_path / "other"), buckets=4)
    start_counts(feed.stream(), other, str(tmp_path / "cp2"), ONCE).awaitTermination()
    assert ours == counted(other) and len(ours) >= 20

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from checks.queries import comparable
from eventpipe.operators.counts import count_by_window, count_stream
from eventpipe.operators.objects import current_objects, list_objects
from eventpipe.operators.parse import good_events, parse_events
from eventpipe.plans.adhoc import fill_time_macros, run_sql_file
from eventpipe.plans.reconcile import reconcile_images
from eventpipe.schemas import TOPIC
from eventpipe.sources.fetch import fetch_with
from eventpipe.sources.topic import stream_topic_files
from eventpipe.streaming.jobs import run_to_end, start_counts, start_rows
from eventpipe.streaming.warehouse import Warehouse, export_files

ONCE = {"availableNow": True}


class Feed:
    """Drops one file of topic records per call; a stream takes one file per batch."""

    def __init__(self, spark, root):
        self.spark, self.root, self.offset, self.files = spark, str(root), 0, 0
        os.makedirs(self.root)

    def put(self, *events):
        with open(f"{self.root}/.part", "w") as file:
            for event in events:
                value = event if isinstance(event, str) else json.dumps(event)
                record = {
                    "value": value, "topic": "events", "partition": 0, "offset": self.offset,
                    "timestamp": "2024-01-01T00:00:00Z",
                }
                file.write(json.dumps(record) + "\n")
                self.offset += 1
        name = f"{self.root}/{self.files:05d}.json"
        os.rename(f"{self.root}/.part", name)
        # Spark takes files by age.
        os.utime(name, (1704067200 + self.files, 1704067200 + self.files))
        self.files += 1

    def stream(self):
        return stream_topic_files(self.spark, self.root, "json", max_files_per_batch=1)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "topic")


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "tables"), buckets=4)


def typed(kind, clock):
    return {"eventType": kind, "eventTime": f"2024-01-01T00:{clock}Z"}


def counted(warehouse):
    frame = warehouse.event_type_counts().select(
        F.date_format("window_start", "HH:mm").alias("start"), "event_type", "event_count"
    )
    return {(r.start, r.event_type): r.event_count for r in frame.collect()}


@pytest.mark.parametrize(
    "batches, expected, dropped",
    [
        ([["D 01:00"], ["D 05:09.999"], ["D 04:00"]], {}, 0),
        (
            [["D 01:00"], ["D 05:10"], ["D 04:00", "I 05:01"], ["D 10:10"]],
            {("00:00", "D"): 2, ("00:05", "D"): 1, ("00:05", "I"): 1},
            0,
        ),
        (
            [["D 01:00"], ["D 05:10"], ["D 06:00"], ["D 04:00"], ["D 30:00"]],
            {("00:00", "D"): 1, ("00:05", "D"): 2},
            1,
        ),
        ([["D 04:00"], ["D 01:00"], ["D 06:00"]], {("00:00", "D"): 2}, 0),
        ([["D 30:00", "D 01:00"]], {("00:00", "D"): 1}, 0),
    ],
)
def test_windows_close_ten_seconds_after_their_end(feed, warehouse, tmp_path, batches, expected, dropped):
    for batch in batches:
        feed.put(*[typed(*text.split()) for text in batch])
    query = start_counts(feed.stream(), warehouse, str(tmp_path / "cp"), ONCE)
    query.awaitTermination()
    assert counted(warehouse) == expected
    late = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    assert late == dropped


def test_time_without_zone_is_refused(spark):
    events = spark.readStream.format("rate").load().select(
        F.col("timestamp").cast("timestamp_ntz").alias("event_time"), F.lit("D").alias("event_type")
    )
    with pytest.raises(Exception, match="EVENT_TIME_IS_NOT_ON_TIMESTAMP_TYPE"):
        count_stream(events).writeStream.format("noop").trigger(**ONCE).start().awaitTermination()


def uid(n):
    return f"00000000-0000-0000-0000-{n:012d}"


def data(n, k, **fields):
    return {"id": uid(n), "eventType": "DATA", "eventTime": "2024-01-01T00:01:00Z", "payload": {"k": k}, **fields}


def image(n, **fields):
    return {"id": uid(n), "eventType": "IMAGE", "eventTime": "2024-01-01T00:02:00Z", **fields}


def fill(feed):
    feed.put(data(1, 1), data(2, 2), image(3, imageBase64="aGk="), image(4), {"id": uid(5), "eventTime": "2024-01-01T00:00:00Z"})
    feed.put(data(1, 10), image(2, imageUrl="http://x/ok"), image(6, imageUrl="http://x/gone"), image(7, imageBase64="!"), "junk")
    feed.put(data(8, 8), image(3, imageBase64="bmV3", imageContentType="image/png"), data(9, 9, eventTime="2024-01-02T00:00:00Z"))


def fetch():
    # An inner function is sent to Python workers by value; they cannot import this file.
    def get(url):
        return (200, "image/gif", b"page") if url.endswith("ok") else (404, None, None)

    return fetch_with(get)


def rows(warehouse):
    frame = warehouse.processed_events().withColumn("payload", F.to_json("payload"))
    return {int(r.id[-3:]): (r.event_type, r.payload, r.image_object_key) for r in frame.collect()}


KEY = "images/2024-01-01/00000000-0000-0000-0000-00000000000"
EXPECTED = {
    1: ("DATA", '{"k":10}', None),
    2: ("IMAGE", None, f"{KEY}2.gif"),
    3: ("IMAGE", None, f"{KEY}3.png"),
    8: ("DATA", '{"k":8}', None),
    9: ("DATA", '{"k":9}', None),
}


def test_all_tables(spark, feed, warehouse, tmp_path):
    fill(feed)
    run_to_end(feed.stream(), warehouse, fetch(), str(tmp_path / "cp"))
    assert rows(warehouse) == EXPECTED
    stored = {r.object_key: r.content for r in current_objects(warehouse.image_objects()).collect()}
    assert stored == {f"{KEY}2.gif": b"page", f"{KEY}3.jpg": b"hi", f"{KEY}3.png": b"new"}
    bad = sorted((r.reason, r.src_offset) for r in warehouse.quarantine().collect())
    assert bad == [("bad_base64", 8), ("bad_json", 9), ("fetch_status_404", 7)]
    assert all(r.value for r in warehouse.quarantine().collect())
    # Skipped and failed images and repeats are counted, unusable records are not.
    assert counted(warehouse) == {
        ("00:00", "DATA"): 4, ("00:00", "IMAGE"): 6, ("00:00", "UNKNOWN"): 1,
    }
    [verdict] = reconcile_images(
        list_objects(warehouse.image_objects()), warehouse.processed_events(), warehouse.event_type_counts()
    ).collect()
    assert tuple(verdict) == (3, 2, 6, 1, False)

    export_files(warehouse.current_objects(), str(tmp_path / "out"))
    assert open(f"{tmp_path}/out/{KEY}3.png", "rb").read() == b"new"

    warehouse.register_views()
    (tmp_path / "q.sql").write_text(
        "-- two statements; one comment\nSELECT source, max(event_time) AS newest\nFROM processed_events\n"
        "WHERE payload IS NOT NULL GROUP BY source;\n"
        "SELECT min(event_count) AS least, sum(event_count) AS n FROM event_type_counts_5m WHERE event_type <> ';';\n"
    )
    first, second = run_sql_file(spark, str(tmp_path / "q.sql"))
    assert [r.source for r in first.collect()] == ["unknown"]
    assert second.first().n == 11
    panel = fill_time_macros(
        "SELECT $__timeGroupAlias(event_time, '30m'), count(DISTINCT id) AS ids "
        "FROM processed_events WHERE source = 'unknown' AND $__timeFilter(event_time) GROUP BY 1",
        "2024-01-01 00:00:00",
        "2024-01-01 23:59:59",
    )
    got = comparable(warehouse.sql(panel)).collect()
    assert [(r.ids, r.time.hour, r.time.minute) for r in got] == [(4, 0, 0)]
    with pytest.raises(ValueError):
        fill_time_macros(panel, "2024-01-01' OR true --", "2024-01-02")


def test_a_batch_that_runs_again_changes_nothing(feed, warehouse, tmp_path):
    fill(feed)
    checkpoint = str(tmp_path / "cp")
    run_to_end(feed.stream(), warehouse, fetch(), checkpoint)

    def state():
        events = warehouse.processed_events().withColumn("payload", F.to_json("payload"))
        counts = warehouse.event_type_counts()
        return [sorted(map(tuple, f.collect()), key=str) for f in (events, counts, warehouse.quarantine().drop("seen_at"))]

    before = state()
    for name in ("rows", "counts"):
        commits = f"{checkpoint}/{name}/commits"
        last = max(int(n) for n in os.listdir(commits) if n.isdigit())
        os.remove(f"{commits}/{last}")
        crc = f"{commits}/.{last}.crc"
        if os.path.exists(crc):
            os.remove(crc)
    time.sleep(1)
    run_to_end(feed.stream(), warehouse, fetch(), checkpoint)
    assert state() == before


def test_inserted_at_stays_that_of_the_first_insert(feed, warehouse, tmp_path):
    feed.put(data(1, 1))
    start_rows(feed.stream(), warehouse, fetch(), str(tmp_path / "cp"), ONCE).awaitTermination()
    first = warehouse.processed_events().first().inserted_at
    warehouse.compact()
    time.sleep(0.01)
    feed.put(data(1, 2))
    start_rows(feed.stream(), warehouse, fetch(), str(tmp_path / "cp"), ONCE).awaitTermination()
    assert rows(warehouse) == {1: ("DATA", '{"k":2}', None)}
    assert warehouse.processed_events().first().inserted_at == first


def test_a_sql_file_sees_the_tables_as_they_are(feed, warehouse, tmp_path):
    path = tmp_path / "n.sql"
    path.write_text("SELECT count(*) AS n FROM processed_events;\n-- all\nSELECT coalesce(max(event_count), 0) AS most FROM event_type_counts_5m;\n")
    for n in (1, 2):
        feed.put(data(n, n))
        start_rows(feed.stream(), warehouse, fetch(), str(tmp_path / "cp"), ONCE).awaitTermination()
        rows_now, most = warehouse.sql_file(str(path))
        assert (rows_now.first().n, most.first().most) == (n, 0)


def test_strict_mode_stops_the_stream(feed, warehouse, tmp_path):
    feed.put(data(1, 1), "junk")
    query = start_counts(feed.stream(), warehouse, str(tmp_path / "cp"), ONCE, strict=True)
    with pytest.raises(Exception, match="unusable record"):
        query.awaitTermination()


def test_snapshots(spark, feed, warehouse, tmp_path):
    fill(feed)
    run_to_end(feed.stream(), warehouse, fetch(), str(tmp_path / "cp"))
    warehouse.compact()
    table = warehouse.events_table
    # The newest batch may be written again and stays outside.
    assert rows(warehouse) == EXPECTED and [n for _, n in table._state()[1]] == [2]
    # Another session finds the snapshot by its folder.
    other = Warehouse(spark.newSession(), warehouse.root, buckets=4)
    assert rows(other) == EXPECTED
    # A later batch is the only side that is shuffled for the join.
    feed.put(data(1, 11), data(10, 10))
    start_rows(feed.stream(), warehouse, fetch(), str(tmp_path / "cp/rows"), ONCE).awaitTermination()
    current = warehouse.processed_events()
    plan = current._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and plan.count("Exchange") == 1
    assert_snapshot_is_not_sorted(current)
    expected = {**EXPECTED, 1: ("DATA", '{"k":11}', None), 10: ("DATA", '{"k":10}', None)}
    assert rows(warehouse) == expected
    warehouse.compact()
    assert rows(warehouse) == expected
    folder = f"{table.root}/snapshot/{table._state()[0][0]}"
    assert len([n for n in os.listdir(folder) if n.endswith(".parquet")]) <= 4
    # Nothing new, no new snapshot.
    warehouse.compact()
    assert len(os.listdir(f"{table.root}/snapshot")) == 2


def assert_snapshot_is_not_sorted(frame):
    """Nothing above the scan of the snapshot sorts or shuffles it."""
    lines = frame._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    at = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    above = [lines[i] for i in range(at) if all(depth[k] > depth[i] for k in range(i + 1, at + 1))]
    assert any("ShuffledHashJoin" in line for line in above)
    assert not any("Sort" in line or "Exchange" in line for line in above)


def test_a_new_checkpoint_loses_nothing(feed, warehouse, tmp_path):
    """Batches of a new checkpoint begin at 0 again, below the cut-off of the snapshot."""
    fill(feed)
    run_to_end(feed.stream(), warehouse, fetch(), str(tmp_path / "cp1"))
    bad = sorted(tuple(r) for r in warehouse.quarantine().drop("seen_at").collect())
    warehouse.compact()
    for n in (20, 21):
        feed.put(data(n, n))
        run_to_end(feed.stream(), warehouse, fetch(), str(tmp_path / "cp2"))
        assert rows(warehouse)[n] == ("DATA", f'{{"k":{n}}}', None)
    expected = {**EXPECTED, 20: ("DATA", '{"k":20}', None), 21: ("DATA", '{"k":21}', None)}
    assert rows(warehouse) == expected
    warehouse.compact()
    assert rows(warehouse) == expected and len(warehouse.events_table._state()[1]) == 2
    # What both runs have stored or turned down counts once.
    keys = [r.object_key for r in warehouse.current_objects().select("object_key").collect()]
    assert len(keys) == len(set(keys))
    assert sorted(tuple(r) for r in warehouse.quarantine().drop("seen_at").collect()) == bad


def test_an_unfinished_batch_is_not_read(spark, feed, warehouse, tmp_path):
    fill(feed)
    run_to_end(feed.stream(), warehouse, fetch(), str(tmp_path / "cp"))
    table = warehouse.events_table
    run = table.batches()[0][0]
    os.remove(f"{table.batch_path((run, 2))}/_SUCCESS")
    assert table.batches() == [(run, 0), (run, 1)]
    assert set(rows(warehouse)) == {1, 2, 3}


def test_empty_warehouse(warehouse):
    assert warehouse.processed_events().count() == 0
    assert warehouse.event_type_counts().count() == 0
    warehouse.compact()


def test_stream_counts_are_those_of_the_batch(spark, feed, warehouse, tmp_path):
    """For events in order of time nothing is late, however they are cut into batches."""
    start, n = 1704067200, 1000
    for batch in range(5):
        feed.put(*[
            {"eventType": "ABC"[(i * i) % 3], "eventTime": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime(start + i * 7))}
            for i in range(batch * n // 5, (batch + 1) * n // 5)
        ])
    start_counts(feed.stream(), warehouse, str(tmp_path / "cp"), ONCE).awaitTermination()
    records = spark.read.schema(TOPIC).json(feed.root)
    events = good_events(parse_events(records))
    latest = start + (n - 1) * 7
    closed = count_by_window(events).where(F.unix_timestamp("window_end") + 10 <= latest)
    got = warehouse.event_type_counts().drop("updated_at")
    assert got.count() > 20
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, closed.collect()))

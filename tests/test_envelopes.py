import base64
import json
import re

from pyspark.sql import functions as F

from eventpipe.operators.envelopes import (
    accepted,
    build_envelopes,
    build_upload_envelopes,
    parse_requests,
    rejected,
    validate_uploads,
)
from eventpipe.operators.parse import parse_events
from eventpipe.sources.topic import read_topic_files, with_places
from eventpipe.sources.uploads import list_files, read_uploads


def at():
    return F.lit("2024-01-01 00:00:00").cast("timestamp")



def requests(spark, *bodies):
    return parse_requests(spark.createDataFrame([(b,) for b in bodies], "body STRING"))


def test_which_requests_are_turned_down(spark):
    cases = {
        '{"eventType":"DATA"}': None,
        '{"eventType":5}': None,
        '{"eventType":"DATA","payload":null,"imageUrl":null,"more":1}': None,
        # The check trims up to the plain blank only.
        '{"eventType":"\\u00a0"}': None,
        "{}": "blank_event_type",
        '{"eventType":null}': "blank_event_type",
        '{"eventType":""}': "blank_event_type",
        '{"eventType":" \\t\\n"}': "blank_event_type",
        '{"eventType":["DATA"]}': "bad_body",
        '{"eventType":"DATA","payload":[1]}': "bad_body",
        '{"eventType":"DATA","payload":"x"}': "bad_body",
        '{"eventType":"DATA","imageUrl":{}}': "bad_body",
        "[]": "bad_body",
        "": "bad_body",
    }
    got = {r.body: r.reason for r in requests(spark, *cases).collect()}
    assert got == cases
    parsed = requests(spark, *cases)
    assert accepted(parsed).count() + rejected(parsed).count() == len(cases)


def test_envelopes_hold_only_what_is_given(spark):
    bodies = [
        '{"eventType":"data","payload":{"cart":["tea","jam"],"total":12.5,"gift":null}}',
        '{"eventType":"IMAGE","imageUrl":"https://example.org/a b"}',
        '{"eventType":"IMAGE","imageUrl":" "}',
    ]
    rows = build_envelopes(accepted(requests(spark, *bodies)), event_time=at()).collect()
    envelopes = [json.loads(r.value) for r in rows]
    assert envelopes[0]["payload"] == {"cart": ["tea", "jam"], "total": 12.5, "gift": None}
    assert envelopes[0]["eventType"] == "data" and "imageUrl" not in envelopes[0]
    assert envelopes[1]["imageUrl"] == "https://example.org/a b" and "payload" not in envelopes[1]
    assert set(envelopes[2]) == {"id", "eventType", "eventTime", "source"}
    for row, envelope in zip(rows, envelopes):
        assert row.key == envelope["id"] and re.fullmatch(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", row.key)
        assert envelope["eventTime"] == "2024-01-01T00:00:00.000000Z" and envelope["source"] == "ui"
    assert len({r.key for r in rows}) == 3


def test_uploads(spark, tmp_path):
    data = bytes(range(256)) * 3
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.bin").write_bytes(data)
    (tmp_path / "in" / "empty.bin").write_bytes(b"")
    files = read_uploads(spark, str(tmp_path / "in"), "*.bin")
    row = build_upload_envelopes(accepted(validate_uploads(files))).first()
    envelope = json.loads(row.value)
    assert base64.b64decode(envelope["imageBase64"], validate=True) == data
    assert (envelope["eventType"], envelope["imageContentType"]) == ("IMAGE", "application/octet-stream")
    empty = spark.createDataFrame([(b"",), (None,), (b"x",)], "content BINARY")
    assert [r.reason for r in validate_uploads(empty).collect()] == ["empty_file", "empty_file", None]
    assert [(r.object_key, r.size) for r in list_files(spark, str(tmp_path / "in"), "a").collect()] == [("a.bin", 768)]


def test_records_through_files_come_back_as_events(spark, tmp_path):
    sent = build_envelopes(accepted(requests(spark, '{"eventType":"data","payload":{"k":1}}')), event_time=at())
    path = str(tmp_path / "topic")
    with_places(sent, F.lit(3), partitions=4).write.json(path)
    row = parse_events(read_topic_files(spark, path, "json")).withColumn("second", F.unix_timestamp("event_time")).first()
    assert (row.event_type, row.source, row.src_offset, row.reason) == ("DATA", "ui", 3, None)
    assert row.second == 1704067200

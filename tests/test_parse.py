"""One case per parsing rule."""

import datetime as dt
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from eventpipe.operators.parse import bad_records, good_events, parse_events, require_good
from eventpipe.operators.routing import data_events, image_events, unrouted_events

ID = "a0eebc99-9c0b-4ef8-bb6d-6bb9bd380a11"
TIME = "2024-01-01T00:00:00Z"


def event(**fields):
    return json.dumps({"id": ID, "eventTime": TIME, **fields})


def rows(frame):
    shown = frame.withColumn("payload", F.to_json("payload")).withColumn(
        "event_time", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )
    return {r.src_offset: r for r in shown.collect()}


def check(topic, cases, column):
    got = rows(parse_events(topic(*[value for value, _ in cases])))
    for offset, (value, expected) in enumerate(cases):
        assert got[offset][column] == expected, value


def test_defaults(topic):
    row = rows(parse_events(topic("{}", start=7)))[7]
    digest = hashlib.md5(b"events:0:7").hexdigest()
    assert row.id == f"{digest[:8]}-{digest[8:12]}-{digest[12:16]}-{digest[16:20]}-{digest[20:]}"
    assert row.event_time == "2024-03-01 12:00:00.000000"
    assert (row.event_type, row.source, row.image_content_type) == ("UNKNOWN", "unknown", "image/jpeg")
    assert row.payload is row.image_url is row.image_base64 is row.reason is None
    assert row.date == dt.date(2024, 3, 1)


def test_event_type(topic):
    cases = [
        (event(), "UNKNOWN"),
        (event(eventType=None), "NULL"),
        (event(eventType="image"), "IMAGE"),
        (event(eventType=" data "), " DATA "),
        (event(eventType=5), "5"),
        (event(eventType=True), "TRUE"),
    ]
    check(topic, cases, "event_type")


def test_source(topic):
    cases = [(event(), "unknown"), (event(source=None), "null"), (event(source="Ui"), "Ui"), (event(source=1), "1")]
    check(topic, cases, "source")


def test_id(topic):
    cases = [
        (json.dumps({"id": value}), expected)
        for value, expected in [
            ("1-1-1-1-1", "00000001-0001-0001-0001-000000000001"),
            (ID.upper(), ID),
            ("123456789-1-1-1-1", "23456789-0001-0001-0001-000000000001"),
            ("0000000000000000001-1-1-1-1", "00000001-0001-0001-0001-000000000001"),
            ("+1-1-1-1-1", "00000001-0001-0001-0001-000000000001"),
            ("ffffffffffffffff-1-1-1-1", None),
            ("7fffffffffffffff-1-1-1-1", "ffffffff-0001-0001-0001-000000000001"),
            (None, None),
            ("x", None),
            ("", None),
            ("1-1-1-1", None),
            ("1-1-1-1-1-1", None),
            ("1--1-1-1", None),
            (ID.replace("-", ""), None),
            (ID + "0", None),
            (ID + "\n", None),
            (5, None),
        ]
    ]
    check(topic, cases, "id")
    check(topic, [(v, None if e else "bad_id") for v, e in cases], "reason")


def test_event_time(topic):
    cases = [
        (json.dumps({"id": ID, "eventTime": value}), expected)
        for value, expected in [
            ("2024-01-01T00:00:00Z", "2024-01-01 00:00:00.000000"),
            ("2024-01-01t00:00:00z", "2024-01-01 00:00:00.000000"),
            ("2024-01-01T02:00:00+02:00", "2024-01-01 00:00:00.000000"),
            ("2024-01-01T00:00:30+00:00:30", "2024-01-01 00:00:00.000000"),
            ("2024-01-01T00:00:00.5Z", "2024-01-01 00:00:00.500000"),
            ("2024-01-01T00:00:00.Z", "2024-01-01 00:00:00.000000"),
            ("2024-01-01T00:00:00.123456789Z", "2024-01-01 00:00:00.123456"),
            ("2024-01-01T24:00:00Z", "2024-01-02 00:00:00.000000"),
            ("2024-12-31T23:59:60Z", "2024-12-31 23:59:59.000000"),
            ("2024-01-01T24:00:01Z", None),
            ("2024-01-01T12:59:60Z", None),
            ("2024-01-01", None),
            ("2024-01-01 00:00:00Z", None),
            ("2024-01-01T00:00:00", None),
            ("2024-01-01T00:00Z", None),
            ("2024-02-30T00:00:00Z", None),
            ("2024-01-01T00:00:00+19:00", None),
            ("2024-01-01T00:00:00+02", None),
            ("2024-01-01T00:00:00Z\n", None),
            (None, None),
            (1704067200, None),
        ]
    ]
    check(topic, cases, "event_time")
    check(topic, [(v, None if e else "bad_time") for v, e in cases], "reason")


def test_date_is_the_one_in_utc(topic):
    check(topic, [(event(eventTime="2024-01-01T23:30:00-02:00"), dt.date(2024, 1, 2))], "date")


def test_payload(topic):
    cases = [
        (event(payload={"b": 1, "a": {"x": [1, 2.5]}}), '{"a":{"x":[1,2.5]},"b":1}'),
        (event(payload={}), "{}"),
        (event(payload=[1]), None),
        (event(payload="s"), None),
        (event(payload=None), None),
        (event(), None),
        ('{"payload":{"k": 2.50}}', '{"k":2.5}'),
    ]
    check(topic, cases, "payload")


def test_image_fields(topic):
    check(topic, [(event(imageUrl="u"), "u"), (event(imageUrl=None), None), (event(), None)], "image_url")
    check(topic, [(event(imageBase64="aGk="), "aGk="), (event(imageBase64=None), None)], "image_base64")
    cases = [("image/PNG", "image/PNG"), (None, "image/jpeg"), (" ", " ")]
    check(topic, [(event(imageContentType=v), e) for v, e in cases], "image_content_type")


def test_json(topic):
    cases = [
        ("[1]", "bad_json"),
        ("null", "bad_json"),
        ("5", "bad_json"),
        ('"{}"', "bad_json"),
        ("", "bad_json"),
        ("not json", "bad_json"),
        ("{", "bad_json"),
        (None, "bad_json"),
        (' \n{"a":1}', None),
        ('{"a":1} trailing', None),
    ]
    check(topic, cases, "reason")


@pytest.mark.parametrize("mib", [20, 40])
def test_long_fields_are_read(topic, mib):
    size = mib * 1024 * 1024
    got = parse_events(topic(event(imageBase64="A" * size))).select("reason", F.length("image_base64")).first()
    assert tuple(got) == (None, size)


def test_last_of_equal_keys_wins(topic):
    check(topic, [('{"eventType":"a","eventType":"b"}', "B")], "event_type")


def test_good_and_bad_add_up_and_bad_records_are_whole(topic):
    parsed = parse_events(topic("{}", "x", '{"id":"1"}', '{"eventTime":"1"}'))
    assert good_events(parsed).count() == 1
    bad = {(r.value, r.reason) for r in bad_records(parsed).collect()}
    assert bad == {("x", "bad_json"), ('{"id":"1"}', "bad_id"), ('{"eventTime":"1"}', "bad_time")}


def test_strict_mode_fails_on_the_first_bad_record(topic):
    assert require_good(parse_events(topic("{}"))).count() == 1
    with pytest.raises(Exception, match="unusable record at 0:1: bad_json"):
        require_good(parse_events(topic("{}", "x"))).select("event_type").collect()


def test_routes(topic):
    parsed = parse_events(topic(event(eventType="image"), event(eventType="Data"), event(eventType="x"), event()))
    assert [r.src_offset for r in image_events(parsed).collect()] == [0]
    assert [r.src_offset for r in data_events(parsed).collect()] == [1]
    assert sorted(r.src_offset for r in unrouted_events(parsed).collect()) == [2, 3]


def test_json_is_read_once_however_events_are_filtered(topic):
    frame = data_events(good_events(parse_events(topic("{}"))))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1

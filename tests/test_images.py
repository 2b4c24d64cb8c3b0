import base64
import json
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from eventpipe.functions.images import decoded_size
from eventpipe.operators.images import resolve_images, skipped_images, stored_objects
from eventpipe.operators.objects import (
    current_objects,
    fetch_object,
    fetch_objects,
    list_folder,
    list_objects,
)
from eventpipe.operators.parse import good_events, parse_events
from eventpipe.operators.routing import image_events
from eventpipe.sources import fetch as fetching
from eventpipe.sources.fetch import fetch_from, fetch_with, http_get

ID = "a0eebc99-9c0b-4ef8-bb6d-6bb9bd380a11"


def image(n=1, **fields):
    id = f"00000000-0000-0000-0000-{n:012d}"
    return json.dumps({"id": id, "eventType": "IMAGE", "eventTime": "2024-01-05T00:00:00Z", **fields})


def events(topic, *values, **kw):
    parsed = parse_events(topic(*values, **kw).withColumn("inserted_at", F.col("timestamp")))
    return image_events(good_events(parsed))


def answers(spark, *rows):
    return fetch_from(spark.createDataFrame(rows, "url STRING, status INT, content_type STRING, content BINARY"))


def by_offset(frame):
    return {r.src_offset: r for r in frame.collect()}


def test_base64_is_strict(spark, topic):
    cases = {
        "aGk=": b"hi",
        "aGk": b"hi",
        "aA==": b"h",
        "aA": b"h",
        "aGkh": b"hi!",
        "!!!!": None,
        "a Gk=": None,
        "aGk=\n": None,
        "aA=": None,
        "a": None,
        "aGk==": None,
        "aG=k": None,
        "aG-_": None,
        "====": None,
    }
    got = by_offset(resolve_images(events(topic, *[image(imageBase64=c) for c in cases]), answers(spark)))
    for offset, (text, expected) in enumerate(cases.items()):
        row = got[offset]
        assert (row.content, row.reason) == (expected, None if expected else "bad_base64"), text
        assert (row.value is None) == bool(expected)


def test_long_base64(spark, topic):
    data = bytes(range(256)) * 4000
    text = base64.b64encode(data).decode()
    row = resolve_images(events(topic, image(imageBase64=text)), answers(spark)).first()
    assert row.content == data and row.size == len(data)


def test_where_bytes_come_from(spark, topic):
    fetch = answers(spark, ("u", 200, None, b"page"))
    values = [
        image(imageBase64="aGk=", imageUrl="u"),
        image(imageBase64=" \t ", imageUrl="u"),
        image(imageUrl="u"),
        image(imageUrl="  "),
        image(),
    ]
    got = by_offset(resolve_images(events(topic, *values), fetch))
    assert {k: r.content for k, r in got.items()} == {0: b"hi", 1: b"page", 2: b"page"}
    assert sorted(by_offset(skipped_images(events(topic, *values)))) == [3, 4]


def test_fetch_outcomes_and_types(spark, topic):
    fetch = answers(
        spark,
        ("ok", 200, "Image/PNG; q=1", b"1"),
        ("untyped", 204, None, b""),
        ("gone", 404, "text/html", b"x"),
        ("moved", 301, None, b""),
    )
    urls = ["ok", "untyped", "gone", "moved", "nowhere"]
    got = by_offset(
        resolve_images(events(topic, *[image(imageUrl=u, imageContentType="image/gif") for u in urls]), fetch)
    )
    assert [got[i].reason for i in range(5)] == [
        None, None, "fetch_status_404", "fetch_status_301", "fetch_failed",
    ]
    assert got[0].content_type == "Image/PNG; q=1" and got[0].object_key.endswith(".png")
    assert got[1].content_type == "image/gif" and got[1].content == b"" and got[1].size == 0
    assert got[2].object_key is None and got[2].content is None


@pytest.mark.parametrize(
    "content_type, extension",
    [
        ("image/PNG", ".png"),
        ("image/webp", ".webp"),
        ("image/gif", ".gif"),
        ("image/webp+png", ".png"),
        ("application/octet-stream", ".jpg"),
        ("", ".jpg"),
        (None, ".jpg"),
    ],
)
def test_keys(spark, topic, content_type, extension):
    row = resolve_images(
        events(topic, image(imageBase64="aGk=", imageContentType=content_type)), answers(spark)
    ).first()
    assert row.object_key == f"images/2024-01-05/00000000-0000-0000-0000-000000000001{extension}"
    assert row.content_type == (content_type or "image/jpeg")


def test_fetch_with_calls_once_per_event_and_splits_large_batches(spark, topic, monkeypatch):
    monkeypatch.setattr(fetching, "BATCH_BYTES", 10)
    urls = ["same"] * 7 + ["other", "missing"]

    def get(url):
        return (None, None, None) if url == "missing" else (200, "image/png", url.encode())

    values = [image(n, imageUrl=u) for n, u in enumerate(urls)]
    rows = resolve_images(events(topic, *values), fetch_with(get, 3)).collect()
    assert Counter(r.content for r in rows) == {b"same": 7, b"other": 1, None: 1}
    assert [r.reason for r in rows if r.content is None] == ["fetch_failed"]


def test_batches_are_cut_by_size():
    batch = pd.DataFrame({"image_url": list("abcd")})
    part = fetching._joined(batch, [2, 1], [(200, None, b"x"), (None, None, None)])
    assert list(part.image_url) == ["c", "b"]
    assert part.status.isna().tolist() == [False, True]


def test_http_get_refuses_other_schemes():
    assert http_get()("file:///etc/hostname") == (None, None, None)
    assert http_get()("not a url") == (None, None, None)


def objects(spark, topic):
    values = [
        image(1, imageBase64="b2xk"),
        image(2, imageBase64="aGk=", imageContentType="image/png"),
        image(1, imageBase64="bmV3ISE="),
        json.dumps({"id": ID, "eventType": "IMAGE", "eventTime": "2024-02-01T00:00:00Z", "imageBase64": "aGk="}),
    ]
    return stored_objects(resolve_images(events(topic, *values), answers(spark)))


def test_last_put_of_a_key_wins(spark, topic):
    got = {r.object_key.split("-")[-1]: r.content for r in current_objects(objects(spark, topic)).collect()}
    assert got == {"000000000001.jpg": b"new!!", "000000000002.png": b"hi", "6bb9bd380a11.jpg": b"hi"}
    keys = {r.object_key: r.size for r in list_objects(objects(spark, topic)).collect()}
    assert len(keys) == 3 and keys["images/2024-01-05/00000000-0000-0000-0000-000000000001.jpg"] == 5


def test_one_put_that_two_batches_stored_is_one_row(spark, topic):
    table = objects(spark, topic)
    twice = table.withColumn("run", F.lit("r")).withColumn("batch_id", F.explode(F.array(F.lit(1), F.lit(2))))
    got = current_objects(twice)
    assert got.columns == table.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, current_objects(table).collect()))


def test_bytes_are_neither_sorted_nor_aggregated(spark, topic):
    plan = current_objects(objects(spark, topic))._jdf.queryExecution().sparkPlan().toString()
    for line in plan.splitlines():
        assert not (("Aggregate" in line or "Sort " in line) and "content#" in line), line
    assert "ShuffledHashJoin" in plan
    listed = list_objects(objects(spark, topic))._jdf.queryExecution().optimizedPlan().toString()
    assert "unbase64" not in listed


def test_size_of_base64_text_is_that_of_its_bytes(spark):
    texts = ["", "YQ==", "YQ", "YWI=", "YWI", "YWJj", "YWJjZA==", "YWJjZA"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = frame.select("t", decoded_size(F.col("t")), F.octet_length(F.unbase64("t"))).collect()
    assert all(r[1] == r[2] for r in got), got


def test_listing(spark, topic):
    table = objects(spark, topic)
    assert list_objects(table, "images/2024-01").count() == 2
    assert list_objects(table, "nothing").count() == 0
    assert {(r.name, r.size) for r in list_folder(table).collect()} == {("images/", None)}
    assert {r.name for r in list_folder(table, "images").collect()} == {"2024-01-05/", "2024-02-01/"}
    assert {(r.name, r.size) for r in list_folder(table, "images/2024-02-01/").collect()} == {(f"{ID}.jpg", 2)}


def test_fetching(spark, topic):
    table = objects(spark, topic)
    key = "images/2024-01-05/00000000-0000-0000-0000-000000000001.jpg"
    assert [r.content for r in fetch_object(table, key).collect()] == [b"new!!"]
    assert fetch_object(table, "images/none/x.jpg").count() == 0
    wanted = spark.createDataFrame([(key,), (key,), ("gone",), (None,)], "object_key STRING")
    assert [r.content for r in fetch_objects(table, wanted).collect()] == [b"new!!"]

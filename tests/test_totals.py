import json
from collections import Counter
from random import Random
from zlib import crc32

import pandas as pd
import pytest
from pyspark.sql import functions as F

from eventpipe.operators.objects import fetch_objects
from eventpipe.operators.totals import RowTotals, bundle_of
from eventpipe.plans.analytics import count_by_hour, count_by_hour_from_totals
from eventpipe.plans.backfill import Backfill
from eventpipe.plans.reconcile import image_totals, sum_image_counts
from eventpipe.streaming.jobs import start_totals
from eventpipe.streaming.warehouse import Warehouse

ONCE = {"availableNow": True}
SCHEMA = (
    "id STRING, event_type STRING, event_time TIMESTAMP, source STRING, image_object_key STRING, "
    "inserted_at TIMESTAMP, src_time TIMESTAMP, src_partition INT, src_offset BIGINT"
)


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "w"), buckets=2)


def put(warehouse, batch, *rows, run="r"):
    """Rows (id, type, hour, object key, minute of its record)."""
    table = [
        (id, kind, f"2024-01-01 {hour:02d}:30:00", "ui", key, "2024-01-01", f"2024-01-01 00:{minute:02d}:00", 0, minute)
        for id, kind, hour, key, minute in rows
    ]
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    text = SCHEMA.replace("TIMESTAMP", "STRING")
    frame = warehouse.spark.createDataFrame(table, text).select(*[
        F.col(n).cast("timestamp").alias(n) if f"{n} TIMESTAMP" in SCHEMA else F.col(n) for n in names
    ])
    frame = frame.withColumn("payload", F.lit(None).cast("variant"))
    warehouse.events_table.write(frame.repartition(2), batch, run)


def update(warehouse, tmp_path):
    start_totals(warehouse, str(tmp_path / "cp"), ONCE, slots=2).awaitTermination()


def check(warehouse, n_objects):
    rows = warehouse.processed_events()
    full = sorted(tuple(r) for r in count_by_hour(rows).collect())
    assert sorted(tuple(r) for r in count_by_hour_from_totals(warehouse.row_totals()).collect()) == full
    images = rows.where("event_type = 'IMAGE' AND image_object_key IS NOT NULL").count()
    assert tuple(image_totals(warehouse.row_totals()).first()) == (n_objects, images)


def test_totals_follow_repeats_type_changes_and_replays(warehouse, tmp_path):
    update(warehouse, tmp_path)
    check(warehouse, 0)
    put(warehouse, 0, ("a", "DATA", 1, None, 1), ("b", "DATA", 1, None, 2), ("c", "IMAGE", 2, "k/c.png", 3))
    update(warehouse, tmp_path)
    check(warehouse, 1)
    # Another hour, another type, another key of the same id, a repeat, and several changes of one id in a batch.
    put(
        warehouse, 1, ("a", "DATA", 5, None, 11), ("b", "IMAGE", 1, "k/b.png", 12), ("c", "IMAGE", 2, "k/c.gif", 13),
        ("d", "DATA", 3, None, 14), ("d", "IMAGE", 4, "k/d.png", 15), ("d", "DATA", 6, None, 16),
    )
    update(warehouse, tmp_path)
    check(warehouse, 4)
    # The batch runs again and says the same: nothing counts twice.
    put(
        warehouse, 1, ("a", "DATA", 5, None, 11), ("b", "IMAGE", 1, "k/b.png", 12), ("c", "IMAGE", 2, "k/c.gif", 13),
        ("d", "DATA", 3, None, 14), ("d", "IMAGE", 4, "k/d.png", 15), ("d", "DATA", 6, None, 16),
    )
    update(warehouse, tmp_path)
    check(warehouse, 4)
    # An older change comes later; it replaces nothing, but its object was put.
    put(warehouse, 2, ("a", "IMAGE", 9, "k/a.png", 5))
    update(warehouse, tmp_path)
    check(warehouse, 5)
    # Parts are summed when batches are put together.
    warehouse.totals_table.fold()
    warehouse.totals_table.expire(0)
    check(warehouse, 5)


def test_bytes_move_once_to_be_fetched(spark, warehouse):
    import datetime as dt

    schema = warehouse.images_table.schema
    at = dt.datetime(2024, 1, 1)
    rows = [
        (f"images/k{i}", "image/png", bytes([i, n]), 2, dt.date(2024, 1, 1), f"k{i}", "IMAGE", at, "ui", at, None, None, at, 0, 10 * i + n)
        for i in range(5)
        for n in range(3)
    ]
    objects = spark.createDataFrame(rows, schema)
    keys = spark.createDataFrame([("images/k1",), ("images/k1",), ("images/k3",), (None,), ("images/none",)], "object_key STRING")
    got = fetch_objects(objects, keys)
    assert {r.object_key: bytes(r.content) for r in got.collect()} == {"images/k1": b"\x01\x02", "images/k3": b"\x03\x02"}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    joins = [i for i, line in enumerate(plan.splitlines()) if "Join" in line]
    assert len(joins) == 2 and plan.count("content#") >= 1


class Cell:
    """A state that counts its calls; values go through JSON, as what is read is no longer what was written."""

    def __init__(self):
        self.values, self.calls = {}, 0

    def get(self):
        return self.getValue(())

    def update(self, value):
        self.updateValue((), value)

    def getValue(self, key):
        self.calls += 1
        return json.loads(self.values[key]) if key in self.values else None

    def updateValue(self, key, value):
        self.calls += 1
        self.values[key] = json.dumps(value)

    def removeKey(self, key):
        self.calls += 1
        self.values.pop(key, None)


class Handle:
    def __init__(self):
        self.cells = {}

    def getValueState(self, name, *schemas):
        return self.cells.setdefault(name, Cell())

    getMapState = getValueState


def test_state_calls_are_per_bundle_and_bundles_stay_small():
    random, handle, latest, objects, got = Random(7), Handle(), {}, set(), Counter()
    for batch in range(6):
        rows = []
        for i in range((40, 3000, 0, 1, 3000, 20)[batch]):
            n = random.randrange(4000)
            id = None if n == 0 else f"id-{n}"
            key = random.choice([None, f"k/{n}.png", f"k/{n}.gif"])
            rows.append((id, crc32(str(id).encode()) - 2**31, random.randrange(5), random.choice(["IMAGE", "DATA"]), key, random.randrange(9), 0, batch * 10_000 + i))
        for id, _, hour, kind, key, *place in rows:
            latest[id] = max(latest.get(id, ([-1],)), (place, hour, kind, key), key=lambda v: v[0])
            objects |= {key} - {None}
        frame = pd.DataFrame(rows, columns=["id", "id_hash", "hour_micros", "event_type", "object_key", "src_micros", "src_partition", "src_offset"])
        frame["object_key"] = frame["object_key"].astype(object).where(frame["object_key"].notna(), None)
        totals = RowTotals(bundle_ids=16, held_rows=500)
        totals.init(handle)
        before = handle.cells["bundles"].calls
        for found in totals.handleInputRows((0,), iter([frame[:700], frame[700:]]), None):
            for hour, kind, *n in found.itertuples(index=False):
                for name, m in zip(("rows", "images", "objects"), n):
                    got[hour, kind, name] += m
        calls = handle.cells["bundles"].calls - before
        # Two for a bundle that is met, two or three for one that is made.
        assert calls <= (2 * len(rows) if len(rows) < 50 else len(rows) * 2 / 3), (batch, calls)
    expected = Counter()
    for _, hour, kind, key in latest.values():
        expected[hour, kind, "rows"] += 1
        expected[hour, kind, "images"] += kind == "IMAGE" and key is not None
    assert {k: n for k, n in got.items() if n and k[2] != "objects"} == {k: n for k, n in expected.items() if n}
    assert sum(n for k, n in got.items() if k[2] == "objects") == len(objects)
    sizes = [len(json.loads(json.loads(v)[0])) for v in handle.cells["bundles"].values.values()]
    assert sum(sizes) == len(latest) and max(sizes) < 80


def test_bundles_split_one_at_a_time():
    for n in range(1, 70):
        for hashed in (*range(-50, 300), 2**63 - 1, -(2**63)):
            before, after = bundle_of(hashed, n), bundle_of(hashed, n + 1)
            assert 0 <= before < n and after in (before, n)
            assert after == before or before == n - (1 << n.bit_length() - 1)


def test_no_task_holds_the_sums_of_all_partitions(warehouse, tmp_path, monkeypatch):
    plans = []
    write = warehouse.totals_table.write

    def seen(rows, *where):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        write(rows, *where)

    monkeypatch.setattr(warehouse.totals_table, "write", seen)
    put(warehouse, 0, ("a", "DATA", 1, None, 1), ("b", "DATA", 1, None, 2))
    update(warehouse, tmp_path)
    check(warehouse, 0)
    assert plans and all("Coalesce" not in plan for plan in plans)
    assert len(list((tmp_path / "w/row_totals/log").glob("*/*/*.parquet"))) == len(plans)


def test_closed_counts_and_their_sum_take_one_pass(spark, topic):
    records = topic(*[f'{{"eventType": "{kind}", "eventTime": "2024-01-01T00:{minute:02d}:00Z"}}' for minute in range(20) for kind in ("image", "data")])
    counted = sum_image_counts(Backfill(records, None).closed_counts())
    assert [r["total"] for r in counted.collect()] == [15]
    assert "ReusedExchange" in counted._jdf.queryExecution().executedPlan().toString()

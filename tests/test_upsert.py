import datetime as dt

from pyspark.sql import functions as F

from eventpipe.operators.upsert import latest_per_key, merge_changes

KEYS, ORDER, FIRST = ["id"], ["p", "o"], ["at"]
SCHEMA = "id STRING, v STRING, at TIMESTAMP, p INT, o BIGINT"


def at(second):
    return dt.datetime(2024, 1, 1, 0, 0, second)


def changes(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def brute(rows):
    out = {}
    for row in sorted(rows, key=lambda r: (r[3], r[4])):
        first = min(row[2], out[row[0]][2]) if row[0] in out else row[2]
        out[row[0]] = (*row[:2], first, *row[3:])
    return set(out.values())


ROWS = [
    ("a", "1", at(5), 0, 1),
    ("b", None, at(6), 0, 2),
    ("a", "2", at(7), 0, 3),
    ("a", None, at(8), 1, 0),
    ("c", "x", at(9), 2, 9),
    ("c", "y", at(9), 2, 10),
]


def test_last_value_and_first_time(spark):
    got = latest_per_key(changes(spark, *ROWS), KEYS, ORDER, FIRST)
    assert {tuple(r) for r in got.collect()} == brute(ROWS)
    # A NULL in the last version stands: it is no gap to be filled.
    assert {r.id: r.v for r in got.collect()} == {"a": None, "b": None, "c": "y"}


def test_merge_is_the_same_as_collapsing_everything(spark):
    for cut in range(len(ROWS) + 1):
        base = latest_per_key(changes(spark, *ROWS[:cut]), KEYS, ORDER, FIRST)
        delta = latest_per_key(changes(spark, *ROWS[cut:]), KEYS, ORDER, FIRST)
        got = merge_changes(base, delta, KEYS, ORDER, FIRST)
        assert {tuple(r) for r in got.collect()} == brute(ROWS), cut


def test_older_change_does_not_overwrite(spark):
    base, delta = changes(spark, ("a", "new", at(5), 0, 9)), changes(spark, ("a", "old", at(4), 0, 1))
    assert merge_changes(base, delta, KEYS, ORDER, FIRST).collect() == [("a", "new", at(4), 0, 9)]


def test_a_hot_key_sends_one_row_per_task_to_the_shuffle(spark):
    n, tasks = 60000, 6
    rows = (
        spark.range(0, n, 1, tasks)
        .select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"),
            F.col("id").cast("string").alias("v"),
            F.timestamp_seconds("id").alias("at"),
            F.lit(0).alias("p"),
            F.col("id").alias("o"),
        )
    )
    got = latest_per_key(rows, KEYS, ORDER, FIRST)
    assert got.count() == 1 + n - n // 3
    hot = got.where("id = 'hot'").first()
    assert (hot.v, hot.o) == (str(n - 3), n - 3)
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan

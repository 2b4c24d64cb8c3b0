"""Run registered queries beside their SQL: ``python -m checks.compare DIR [name ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES
from eventpipe.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def rows_of_spark(frame: DataFrame) -> Counter:
    names = sorted(frame.columns)
    return Counter(tuple(r) for r in frame.select(*names).collect())


def rows_of_sql(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    result = con.sql(sql)
    names = sorted(result.columns)
    columns = ", ".join(f'"{n}"' for n in names)
    return names, Counter(con.sql(f"SELECT {columns} FROM ({sql})").fetchall())


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> str:
    """Empty if both sides agree, else what differs."""
    frame = QUERIES[name](spark, sf_dir)
    ours = rows_of_spark(frame)
    if name not in ORACLES:
        return ""
    names, theirs = rows_of_sql(con, ORACLES[name])
    if names != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} and {names}"
    if ours == theirs:
        return ""
    extra, missing = ours - theirs, theirs - ours
    return (
        f"rows {ours.total()} and {theirs.total()}, {extra.total()} extra, {missing.total()} missing; "
        f"extra {next(iter(extra), None)}; missing {next(iter(missing), None)}"
    )


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = build_session(
        "compare",
        "local[8]",
        8,
        {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            difference = compare(spark, con, sf_dir, name)
        except Exception as error:  # noqa: BLE001 - the other queries are to run as well
            difference = f"{type(error).__name__}: {str(error)[:500]}"
        bad += bool(difference)
        print(f"{name:28s} {time.time() - start:6.1f}s {difference or 'same'}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()

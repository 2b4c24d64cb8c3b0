"""Ad-hoc SQL over the tables, given as text or as a file."""

from __future__ import annotations

import re
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

PROCESSED_VIEW = "processed_events"
COUNTS_VIEW = "event_type_counts_5m"

_RANGE = re.compile(r"\$__timeFilter\(([^()]*)\)")
_BUCKET = re.compile(r"\$__timeGroupAlias\(([^(),]*),\s*'(\d+)([smhd])'\)")
_UNITS = {"s": "seconds", "m": "minutes", "h": "hours", "d": "days"}


def register_views(processed: DataFrame, counts: DataFrame) -> None:
    """Name the tables for SQL. A view holds the batches there are now: see ``Warehouse.sql``."""
    processed.createOrReplaceTempView(PROCESSED_VIEW)
    counts.createOrReplaceTempView(COUNTS_VIEW)


def run_sql(spark: SparkSession, text: str) -> DataFrame:
    return spark.sql(text)


def run_sql_file(spark: SparkSession, path: str) -> list[DataFrame]:
    """One DataFrame per statement. A statement ends with ``;`` at the end of a line."""
    lines = [l for l in Path(path).read_text().splitlines() if not l.lstrip().startswith("--")]
    statements = re.split(r";[ \t]*(?:\n|\Z)", "\n".join(lines))
    return [spark.sql(s) for s in statements if s.strip()]


def fill_time_macros(text: str, low: str, high: str) -> str:
    """Replace the two time macros that dashboard panels use by Spark SQL."""
    # Read as times first: only what a time prints as gets into the statement.
    low, high = (datetime.fromisoformat(t).isoformat(" ") for t in (low, high))
    between = rf"\1 BETWEEN TIMESTAMP '{low}' AND TIMESTAMP '{high}'"
    filled = _RANGE.sub(between, text)
    return _BUCKET.sub(
        lambda m: f"window({m[1]}, '{m[2]} {_UNITS[m[3]]}').start AS `time`", filled
    )

"""Session settings the operators rely on, and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Needed for right results: dates and hours are UTC ones, and of two equal
# JSON keys the last wins.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Needed for speed only.
ADVISED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Put the settings above on a session, whoever built it."""
    for key, value in {**REQUIRED_CONF, **ADVISED_CONF}.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app_name: str = "eventpipe",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new, not yet existing folder below the one every executor can reach.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local
    session without the setting falls back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="eventpipe-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"

"""Reading the table of image objects: overwrite by key, listing, fetching by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventpipe.operators.upsert import latest_per_key
from eventpipe.schemas import PLACE


def object_index(objects: DataFrame) -> DataFrame:
    """One row per object key, the last put winning; no bytes are read."""
    narrow = objects.select(
        "object_key", "content_type", "size", "date", "id", *PLACE
    )
    return latest_per_key(narrow, ["object_key"], PLACE)


def current_objects(objects: DataFrame) -> DataFrame:
    """The last put of every key, with its bytes: exactly one row per key.

    The winners are found from the narrow columns alone and joined to the bytes
    by hash, so that these move once and are never sorted. One put that two
    batches have stored is told apart by ``run`` and ``batch_id`` where the
    rows carry them.
    """
    return _winners(objects, objects)


def _winners(objects: DataFrame, narrow: DataFrame) -> DataFrame:
    """The rows of ``objects`` that are the last puts of the keys in ``narrow``, of which no bytes are read.

    A key holds its date, so the date of the last put may prune the partitions that bytes are read from.
    """
    stored = [c for c in ("run", "batch_id") if c in objects.columns]
    place = F.struct(*PLACE, *stored)
    last = narrow.groupBy("object_key").agg(F.max(place).alias("last"), F.max_by("date", place).alias("day"))
    last = last.select(F.col("object_key").alias("key"), "last", "day")
    wins = (objects["object_key"] == F.col("key")) & (place == F.col("last")) & objects["date"].eqNullSafe(F.col("day"))
    return objects.join(last.hint("shuffle_hash"), wins, "left_semi").drop(*stored)


def list_objects(objects: DataFrame, prefix: str = "") -> DataFrame:
    """Recursive listing: every key that begins with ``prefix``, and its size."""
    index = object_index(objects.where(F.col("object_key").startswith(prefix)) if prefix else objects)
    return index.select("object_key", "size")


def list_folder(objects: DataFrame, folder: str = "") -> DataFrame:
    """Listing of one level: objects by name, and sub-folders ending in ``/``."""
    base = folder.rstrip("/") + "/" if folder else ""
    listed = list_objects(objects, base)
    rest = F.substring(F.col("object_key"), len(base) + 1, 2**31 - 1)
    head = F.substring_index(rest, "/", 1)
    is_folder = rest.contains("/")
    return (
        listed.select(
            F.when(is_folder, F.concat(head, F.lit("/"))).otherwise(head).alias("name"),
            F.when(~is_folder, F.col("size")).alias("size"),
        )
        .groupBy("name")
        .agg(F.max("size").alias("size"))
    )


def fetch_object(objects: DataFrame, key: str) -> DataFrame:
    """Bytes of one key. The date in the key prunes to one partition of the table."""
    found = objects.where(F.col("object_key") == key)
    parts = key.split("/")
    if len(parts) == 3:
        day = F.try_to_date(F.lit(parts[1]))
        found = found.where(day.isNull() | (F.col("date") == day))
    return current_objects(found).select("object_key", "content_type", "content")


def fetch_objects(objects: DataFrame, keys: DataFrame) -> DataFrame:
    """Bytes of all keys in the column ``object_key`` of ``keys``.

    The last put of each key is found among narrow columns; bytes move once, to meet it.
    """
    stored = [c for c in ("run", "batch_id") if c in objects.columns]
    wanted = keys.select("object_key").where(F.col("object_key").isNotNull()).distinct()
    narrow = objects.select("object_key", "date", *PLACE, *stored).join(wanted, "object_key", "left_semi")
    return _winners(objects, narrow).select("object_key", "content_type", "content")

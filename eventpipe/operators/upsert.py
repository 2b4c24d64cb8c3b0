"""Insert-or-overwrite by key, as the latest row per key of a change log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from eventpipe.functions.images import effective_content_type, is_strict_base64, object_key
from eventpipe.operators.images import BASE64, with_kind
from eventpipe.operators.routing import DATA, IMAGE
from eventpipe.schemas import PLACE


def latest_per_key(
    changes: DataFrame, keys: Sequence[str], order: Sequence[str], first: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the last by ``order``, with the earliest value of ``first``.

    An aggregate and no window function: each task sends one row per key to
    the shuffle, so a key with very many versions does not end up in one task.
    """
    rest = [c for c in changes.columns if c not in keys and c not in first]
    return (
        changes.groupBy(*keys)
        .agg(
            F.max_by(F.struct(*rest), F.struct(*order)).alias("last"),
            *[F.min(c).alias(c) for c in first],
        )
        .select(*[c if c in keys or c in first else F.col(f"last.{c}") for c in changes.columns])
    )


def merge_changes(
    base: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    first: Sequence[str] = (),
) -> DataFrame:
    """``delta`` upserted into ``base``; both hold a key at most once."""
    b, d = base.alias("b"), delta.alias("d")
    on = [F.col(f"b.{k}") == F.col(f"d.{k}") for k in keys]
    in_base = F.col(f"b.{keys[0]}").isNotNull()
    in_delta = F.col(f"d.{keys[0]}").isNotNull()
    newer = F.struct(*[F.col(f"d.{c}") for c in order]) >= F.struct(*[F.col(f"b.{c}") for c in order])
    use_delta = in_delta & (~in_base | newer)

    def merged(c: str):
        if c in keys:
            return F.coalesce(f"d.{c}", f"b.{c}")
        if c in first:
            return F.least(f"d.{c}", f"b.{c}")
        return F.when(use_delta, F.col(f"d.{c}")).otherwise(F.col(f"b.{c}"))

    return b.join(d, on, "full_outer").select(*[merged(c).alias(c) for c in base.columns])


def data_changes(events: DataFrame) -> DataFrame:
    """DATA events as rows for the table of processed events."""
    return events.select(
        "id",
        "event_type",
        "event_time",
        "source",
        "payload",
        F.lit(None).cast("string").alias("image_object_key"),
        "inserted_at",
        *PLACE,
    )


def direct_changes(events: DataFrame) -> DataFrame:
    """DATA events and images that carry their bytes as rows, in one pass over the events."""
    kinds = with_kind(events)
    is_image = F.col("event_type") == IMAGE
    stored = is_image & (F.col("kind") == BASE64) & is_strict_base64(F.col("image_base64"))
    content_type = effective_content_type(F.col("image_content_type"), F.lit(None).cast("string"))
    key = object_key(F.col("date"), F.col("id"), content_type)
    return kinds.where((F.col("event_type") == DATA) | stored).select(
        "id",
        "event_type",
        "event_time",
        "source",
        F.when(~is_image, F.col("payload")).alias("payload"),
        F.when(is_image, key).alias("image_object_key"),
        "inserted_at",
        *PLACE,
    )


def image_changes(objects: DataFrame) -> DataFrame:
    """Stored images as rows for the table of processed events; no payload."""
    return objects.select(
        "id",
        "event_type",
        "event_time",
        "source",
        F.lit(None).cast("variant").alias("payload"),
        F.col("object_key").alias("image_object_key"),
        "inserted_at",
        *PLACE,
    )

"""Batch plans from topic records to the tables a stream would have built."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from eventpipe.operators.counts import closed_counts, count_by_window
from eventpipe.operators.images import (
    failed_images,
    failed_records,
    resolve_images,
    resolve_linked,
    stored_objects,
)
from eventpipe.operators.parse import good_events, parse_events
from eventpipe.operators.routing import image_events
from eventpipe.operators.upsert import direct_changes, image_changes, latest_per_key
from eventpipe.plans.reconcile import is_image_row
from eventpipe.schemas import PLACE

ROW_KEYS = ["id"]
ROW_ORDER = list(PLACE)
ROW_FIRST = ["inserted_at"]


@dataclass
class Backfill:
    """Lazy plans over a bounded set of records.

    ``inserted_at`` of a row is the time at which its record entered the topic.
    """

    records: DataFrame
    fetch: Callable[[DataFrame], DataFrame]

    def __post_init__(self) -> None:
        self.parsed = parse_events(self.records.withColumn("inserted_at", F.col("timestamp")))
        self.events = good_events(self.parsed)

    def resolved(self) -> DataFrame:
        return resolve_images(image_events(self.events), self.fetch)

    def image_objects(self) -> DataFrame:
        return stored_objects(self.resolved())

    def quarantine(self) -> DataFrame:
        """One pass for records that are bad as they stand, one for those to be fetched."""
        linked = failed_images(resolve_linked(image_events(self.events), self.fetch))
        return failed_records(self.parsed).unionByName(linked)

    def changes(self) -> DataFrame:
        """One pass for all events that carry what they need, one for those to be fetched."""
        linked = stored_objects(resolve_linked(image_events(self.events), self.fetch))
        return direct_changes(self.events).unionByName(image_changes(linked))

    def processed_events(self, *columns: str) -> DataFrame:
        """The current rows: whole, or only ``id`` and the named columns.

        An aggregate cannot be pruned from outside, so a reader that names its
        columns keeps the others, payloads above all, out of the shuffle.
        """
        changes = self.changes()
        if not columns:
            return latest_per_key(changes, ROW_KEYS, ROW_ORDER, ROW_FIRST)
        first = [c for c in ROW_FIRST if c in columns]
        narrow = changes.select(*dict.fromkeys([*ROW_KEYS, *columns, *ROW_ORDER]))
        return latest_per_key(narrow, ROW_KEYS, ROW_ORDER, first).drop(*[c for c in ROW_ORDER if c not in columns])

    def image_totals(self) -> DataFrame:
        """Numbers of stored objects and of image rows, from one aggregate per id.

        An object key holds the id, so keys of two ids are never equal.
        """
        order = F.struct(*ROW_ORDER)
        per_id = self.changes().groupBy("id").agg(
            F.max_by("event_type", order).alias("event_type"),
            F.max_by("image_object_key", order).alias("image_object_key"),
            F.size(F.collect_set("image_object_key")).alias("objects"),
        )
        return per_id.agg(
            F.coalesce(F.sum("objects"), F.lit(0)).cast("bigint").alias("n_objects"),
            F.count_if(is_image_row()).alias("n_rows"),
        )

    def counts(self) -> DataFrame:
        return count_by_window(self.events)

    def closed_counts(self) -> DataFrame:
        return closed_counts(self.events)

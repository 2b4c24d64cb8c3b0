"""The tables of the pipeline below one root folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventpipe import schemas
from eventpipe.operators.images import stored_objects
from eventpipe.operators.objects import current_objects
from eventpipe.operators.upsert import latest_per_key
from eventpipe.operators.totals import summed_totals
from eventpipe.plans.adhoc import register_views, run_sql, run_sql_file
from eventpipe.plans.backfill import ROW_FIRST, ROW_KEYS, ROW_ORDER
from eventpipe.streaming.tables import GRACE_SECONDS, BatchTable, KeyedTable

COUNT_KEYS = ["window_start", "event_type"]
COUNT_ORDER = ["updated_at"]


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.events_table = KeyedTable(
            spark, f"{self.root}/processed_events", schemas.PROCESSED_EVENTS,
            ROW_KEYS, ROW_ORDER, ROW_FIRST, buckets,
        )
        self.counts_table = KeyedTable(
            spark, f"{self.root}/event_type_counts_5m", schemas.EVENT_TYPE_COUNTS_5M,
            COUNT_KEYS, COUNT_ORDER, (), buckets,
        )
        # By date for listing and fetching; the filter finds the row group of one key.
        self.images_table = BatchTable(
            spark, f"{self.root}/image_objects", schemas.IMAGE_OBJECTS, ["date"],
            {"parquet.bloom.filter.enabled#object_key": "true"},
        )
        self.quarantine_table = BatchTable(spark, f"{self.root}/quarantine", schemas.QUARANTINE)
        # What the counting query with late rows gives out: parts of counts, and rows that came too late.
        self.late_table = BatchTable(spark, f"{self.root}/late_events", schemas.WINDOW_RESULTS)

        self.totals_table = BatchTable(
            spark, f"{self.root}/row_totals", schemas.ROW_TOTALS, combine=summed_totals
        )

    def processed_events(self) -> DataFrame:
        return self.events_table.current()

    def event_type_counts(self) -> DataFrame:
        return self.counts_table.current()

    def image_objects(self) -> DataFrame:
        """All puts, those that were overwritten later included."""
        return stored_objects(self.images_table.read())

    def current_objects(self) -> DataFrame:
        """The last put per key."""
        return current_objects(stored_objects(self.images_table.read(with_batch=True)))

    def quarantine(self) -> DataFrame:
        """One row per place in the topic, as last seen: another run reads the same records again."""
        return latest_per_key(self.quarantine_table.read(), schemas.PLACE, ["seen_at"])

    def late_events(self) -> DataFrame:
        """Events that came after their window had closed, one row per place in the topic."""
        late = self.late_table.read().where(F.col("event_count").isNull()).drop("event_count")
        return latest_per_key(late, schemas.PLACE, ["watermark"])

    def row_totals(self) -> DataFrame:
        """What the current rows count for, by hour and type, from additions and retractions."""
        return summed_totals(self.totals_table.read())

    def register_views(self) -> None:
        register_views(self.processed_events(), self.event_type_counts())

    def sql(self, text: str) -> DataFrame:
        """Run a statement over the tables as they are at this moment."""
        self.register_views()
        return run_sql(self.spark, text)

    def sql_file(self, path: str) -> list[DataFrame]:
        """Run the statements of a file over the tables as they are at this moment."""
        self.register_views()
        return run_sql_file(self.spark, path)

    def compact(self) -> None:
        """Snapshots of the keyed tables; small files of the others put together."""
        for table in (self.events_table, self.counts_table):
            table.compact()
        for table in (self.images_table, self.quarantine_table, self.late_table, self.totals_table):
            table.fold()

    def expire(self, grace_seconds: float = GRACE_SECONDS) -> None:
        """Remove what ``compact`` has replaced for longer than the time of grace."""
        for table in (self.events_table, self.counts_table, self.images_table, self.quarantine_table, self.late_table, self.totals_table):
            table.expire(grace_seconds)


def export_files(objects: DataFrame, root: str) -> None:
    """One file per object at ``root/object_key``, written by the tasks that hold the rows.

    ``root`` must be a folder that every executor has mounted. A file that is
    there already is overwritten, as a put of the same key would do. Give this
    ``Warehouse.current_objects``, so that a key has one row.
    """
    import os

    def write(rows) -> None:
        for row in rows:
            path = os.path.join(root, row.object_key)
            os.makedirs(os.path.dirname(path), exist_ok=True)
            part = f"{path}.{os.getpid()}.part"
            with open(part, "wb") as file:
                file.write(row.content)
            os.replace(part, path)

    objects.where(F.col("content").isNotNull()).select("object_key", "content").foreachPartition(write)

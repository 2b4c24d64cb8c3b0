"""The two streaming queries: event rows with images, and window counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from eventpipe.functions.images import is_strict_base64
from eventpipe.functions.json_fields import not_blank
from eventpipe.operators.counts import count_stream
from eventpipe.operators.images import failed_images, resolve_images, stored_objects
from eventpipe.operators.late import ROCKS_DB, SLOTS, STATE_STORE, summed_counts, window_results
from eventpipe.operators.parse import bad_records, good_events, parse_events, require_good
from eventpipe.operators.routing import IMAGE, data_events, image_events
from eventpipe.operators.totals import SLOTS as TOTAL_SLOTS, row_totals, summed_totals
from eventpipe.operators.upsert import data_changes, image_changes
from eventpipe.streaming.tables import DEFAULT_RUN
from eventpipe.streaming.warehouse import Warehouse

# Fixed value: how often the state of the queries is made durable.
INTERVAL = "10 seconds"

Fetch = Callable[[DataFrame], DataFrame]


def run_of(batch: DataFrame) -> str:
    """The id of the streaming query a micro-batch belongs to: that of its checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or DEFAULT_RUN


def write_rows(parsed: DataFrame, batch_id: int, warehouse: Warehouse, fetch: Fetch) -> None:
    """Write one micro-batch of parsed records to the row tables.

    Resolved images are written first and read back without their bytes: each
    URL is fetched once, and no bytes are held for the tables that follow.
    Every write overwrites the folder of this batch.
    """
    run = run_of(parsed)
    # The raw record is for the quarantine alone: one whose bytes are in good base64 cannot get there any more.
    stored = (F.col("event_type") == IMAGE) & not_blank(F.col("image_base64")) & is_strict_base64(F.col("image_base64"))
    stored = stored | (F.col("event_type") != IMAGE)
    parsed = parsed.withColumn("value", F.when(F.col("reason").isNotNull() | ~stored, F.col("value")))
    parsed.persist(StorageLevel.DISK_ONLY)
    try:
        events = good_events(parsed)
        images = warehouse.images_table
        images.write(resolve_images(image_events(events), fetch), batch_id, run)
        resolved = images.read([(run, batch_id)])
        changes = data_changes(data_events(events)).unionByName(image_changes(stored_objects(resolved)))
        warehouse.events_table.write(changes, batch_id, run)
        bad = bad_records(parsed).unionByName(failed_images(resolved))
        warehouse.quarantine_table.write(bad.withColumn("seen_at", F.current_timestamp()), batch_id, run)
    finally:
        parsed.unpersist()


def start_rows(
    records: DataFrame,
    warehouse: Warehouse,
    fetch: Fetch,
    checkpoint: str,
    trigger: dict | None = None,
    strict: bool = False,
) -> StreamingQuery:
    """Events to row tables, image objects and quarantine.

    In a streaming plan ``current_timestamp`` is the time of the micro-batch
    and kept in its log, so a batch that runs again stamps rows as before.
    """
    parsed = parse_events(records.withColumn("inserted_at", F.current_timestamp()))
    if strict:
        parsed = require_good(parsed)
    return (
        parsed.writeStream.foreachBatch(lambda batch, id: write_rows(batch, id, warehouse, fetch))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": INTERVAL}))
        .start()
    )


def start_counts(
    records: DataFrame,
    warehouse: Warehouse,
    checkpoint: str,
    trigger: dict | None = None,
    strict: bool = False,
) -> StreamingQuery:
    """Events of every type to counts per closed window.

    The plan reads the JSON, too, but none of the fields it does not need: no
    image travels to the count.
    """
    parsed = parse_events(records)
    events = require_good(parsed) if strict else good_events(parsed)
    counts = count_stream(events).withColumn("updated_at", F.current_timestamp())
    return (
        counts.writeStream.outputMode("append")
        .foreachBatch(lambda batch, id: warehouse.counts_table.write(batch, id, run_of(batch)))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": INTERVAL}))
        .start()
    )


def start_counts_and_late(
    records: DataFrame, warehouse: Warehouse, checkpoint: str, trigger: dict | None = None, slots: int = SLOTS
) -> StreamingQuery:
    """Counts per closed window, and the events that came after their window had closed.

    The results of a batch are written once, then read back for the counts: the
    state is gone through once. Use another checkpoint than for ``start_counts``:
    the two keep other state.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        run, table = run_of(batch), warehouse.late_table
        table.write(batch, batch_id, run)
        # A window closes once, so any time will do that a replay finds again.
        counts = summed_counts(table.read([(run, batch_id)]))
        warehouse.counts_table.write(counts.withColumnRenamed("closed_by", "updated_at"), batch_id, run)

    results = window_results(good_events(parse_events(records)), slots)
    return _start_with_state(results, "append", write, checkpoint, trigger)


def start_totals(warehouse: Warehouse, checkpoint: str, trigger: dict | None = None, slots: int = TOTAL_SLOTS) -> StreamingQuery:
    """Row changes, as the row query writes them, to totals by hour and type."""

    def write(batch: DataFrame, batch_id: int) -> None:
        # One small file. A plain coalesce would have one task hold the hash tables of all partitions of the sum.
        warehouse.totals_table.write(summed_totals(batch).repartition(1), batch_id, run_of(batch))

    totals = row_totals(warehouse.events_table.stream(), slots)
    return _start_with_state(totals, "update", write, checkpoint, trigger)


def _start_with_state(
    frame: DataFrame, mode: str, write: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None
) -> StreamingQuery:
    """The query keeps the session's settings as they are when it starts."""
    conf = frame.sparkSession.conf
    before = conf.get(STATE_STORE)
    conf.set(STATE_STORE, ROCKS_DB)
    try:
        return (
            frame.writeStream.outputMode(mode)
            .foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": INTERVAL}))
            .start()
        )
    finally:
        conf.set(STATE_STORE, before)


def run_to_end(
    records: DataFrame, warehouse: Warehouse, fetch: Fetch, checkpoint: str, rows: bool = True, counts: bool = True
) -> None:
    """Both queries, or the one asked for, over all records there are now, then stop."""
    once = {"availableNow": True}
    queries = []
    if rows:
        queries.append(start_rows(records, warehouse, fetch, f"{checkpoint}/rows", once))
    if counts:
        queries.append(start_counts(records, warehouse, f"{checkpoint}/counts", once))
    for query in queries:
        query.awaitTermination()

"""Registered queries: each takes a session and a folder of tables.

Times are given out without zone (they are UTC), payloads as JSON text and
bytes as size and md5, so that other engines can be compared with.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from checks.topic import START, event_id, minutes_after_start, page_answers, table, topic_records
from eventpipe.operators import envelopes, objects, routing
from eventpipe.operators.counts import count_by_window
from eventpipe.operators.images import resolve_linked, skipped_images
from eventpipe.operators.parse import bad_records
from eventpipe.operators.upsert import latest_per_key
from eventpipe.plans import adhoc, analytics
from eventpipe.plans.backfill import Backfill
from eventpipe.plans.reconcile import count_image_rows, image_totals, reconcile_totals, sum_image_counts
from eventpipe.session import configure, work_dir
from eventpipe.sources.fetch import fetch_from, fetch_with
from eventpipe.sources.topic import stream_topic_files, with_places, write_topic_files
from eventpipe.streaming.jobs import run_to_end, start_counts_and_late, start_totals
from eventpipe.streaming.warehouse import COUNT_KEYS, COUNT_ORDER, Warehouse

Query = Callable[[SparkSession, str], DataFrame]

# The dashboard range the panels are asked for.
RANGE = ("2024-01-08 00:00:00", "2024-01-22 12:00:00")


def comparable(frame: DataFrame) -> DataFrame:
    """Times without zone, variants as text."""

    def shown(name: str, kind: str) -> Column:
        if kind == "timestamp":
            return F.col(name).cast("timestamp_ntz").alias(name)
        if kind == "variant":
            return F.to_json(name).alias(name)
        return F.col(name)

    return frame.select(*[shown(name, kind) for name, kind in frame.dtypes])


def _backfill(spark: SparkSession, sf_dir: str) -> Backfill:
    configure(spark)
    return Backfill(topic_records(spark, sf_dir), fetch_from(page_answers(spark, sf_dir)))


def _batch(build: Callable[[Backfill], DataFrame]) -> Query:
    return lambda spark, sf_dir: comparable(build(_backfill(spark, sf_dir)))


def _range() -> tuple[Column, Column]:
    low, high = (F.lit(t).cast("timestamp") for t in RANGE)
    return low, high


# -- parsing and routing ------------------------------------------------------

EVENT_COLUMNS = ["id", "event_type", "event_time", "source", "payload", "src_partition", "src_offset"]


def parsed_events(b: Backfill) -> DataFrame:
    return b.events.select(
        *EVENT_COLUMNS,
        "image_url",
        F.md5("image_base64").alias("image_base64_md5"),
        "image_content_type",
        "date",
    )


def quarantined(frame: DataFrame) -> DataFrame:
    return frame.select("reason", "src_partition", "src_offset", F.md5("value").alias("value_md5"))


def payload_objects(b: Backfill) -> DataFrame:
    with_payload = b.events.where(F.col("payload").isNotNull())
    return with_payload.select(
        "id", "src_offset", F.try_variant_get("payload", "$.k", "bigint").alias("k"), "payload"
    )


def routed(route: Callable[[DataFrame], DataFrame]) -> Query:
    columns = ["id", "event_type", "event_time", "source", "src_partition", "src_offset"]
    return _batch(lambda b: route(b.events).select(*columns))


# -- images -------------------------------------------------------------------


def object_rows(frame: DataFrame) -> DataFrame:
    return frame.select(
        "object_key",
        "content_type",
        F.length("content").cast("bigint").alias("size"),
        F.md5("content").alias("content_md5"),
    )


def stored_images(b: Backfill) -> DataFrame:
    return object_rows(objects.current_objects(b.image_objects()))


def fetched_objects(b: Backfill) -> DataFrame:
    keys = b.processed_events("image_object_key").select(F.col("image_object_key").alias("object_key"))
    return object_rows(objects.fetch_objects(b.image_objects(), keys))


def folder_sizes(b: Backfill) -> DataFrame:
    return objects.list_folder(b.image_objects(), "images")


# -- tables -------------------------------------------------------------------

LATEST = ["event_type", "event_time", "source", "image_object_key", "inserted_at"]
ROW_COLUMNS = ["id", "event_type", "event_time", "source", "payload", "image_object_key", "inserted_at"]


def current_rows(b: Backfill) -> DataFrame:
    return b.processed_events().select(*ROW_COLUMNS)


def counts_upsert(b: Backfill) -> DataFrame:
    """A first count of all deliveries, overwritten by one without repeats."""
    first = b.counts().withColumn("updated_at", F.lit("2024-02-01").cast("timestamp"))
    once = b.events.where(F.col("source") != "retry")
    second = count_by_window(once).withColumn("updated_at", F.lit("2024-02-02").cast("timestamp"))
    return latest_per_key(first.unionByName(second), COUNT_KEYS, COUNT_ORDER)


def reconciled(b: Backfill) -> DataFrame:
    return reconcile_totals(b.image_totals(), b.closed_counts())


def by_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _backfill(spark, sf_dir)
    adhoc.register_views(b.processed_events(), b.closed_counts())
    return adhoc.run_sql(
        spark,
        "SELECT source, event_type, count(*) AS n, count(payload) AS with_payload, "
        "count(image_object_key) AS with_image FROM processed_events GROUP BY source, event_type",
    )


# -- producers ----------------------------------------------------------------


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request bodies: events (errors with a blank type), pages, benchmark (payload no object)."""
    configure(spark)
    events = table(spark, sf_dir, "events").select(
        event_id("request", "event_id").alias("id"),
        F.col("ts").cast("timestamp").alias("at"),
        F.to_json(
            F.struct(
                F.when(F.col("event_type") == "error", F.lit(" \t"))
                .when(F.col("event_type") == "purchase", F.lit("Data"))
                .otherwise(F.col("event_type"))
                .alias("eventType"),
                F.when(F.col("event_type") != "view", F.try_parse_json("props")).alias("payload"),
                F.when(F.col("event_type") == "view", F.lit("  ")).alias("imageUrl"),
            )
        ).alias("body"),
    )
    pages = table(spark, sf_dir, "pages").select(
        event_id("page-request", "page_id").alias("id"),
        minutes_after_start("page_id").alias("at"),
        F.to_json(F.struct(F.lit("IMAGE").alias("eventType"), F.col("url").alias("imageUrl"))).alias("body"),
    )
    items = table(spark, sf_dir, "benchmark").select(
        event_id("item-request", "item_id").alias("id"),
        minutes_after_start("item_id").alias("at"),
        F.to_json(F.struct(F.lit("DATA").alias("eventType"), F.array("text").alias("payload"))).alias("body"),
    )
    return envelopes.parse_requests(events.unionByName(pages).unionByName(items))


def _envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = envelopes.accepted(_requests(spark, sf_dir))
    return envelopes.build_envelopes(good, F.col("id"), F.col("at"))


def sent_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _envelopes(spark, sf_dir).select("key", "value")


def acknowledged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_envelopes(spark, sf_dir).select("id", "event_time"))


def rejected_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelopes.rejected(_requests(spark, sf_dir)).select("id", "reason", F.md5("body").alias("body_md5"))


def _uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files; those of one source are empty, English ones name a type."""
    configure(spark)
    return envelopes.validate_uploads(
        table(spark, sf_dir, "documents").select(
            event_id("upload", "doc_id").alias("id"),
            minutes_after_start("doc_id").alias("at"),
            F.when(F.col("source") == "src0", F.lit("")).otherwise(F.col("text")).cast("binary").alias("content"),
            F.when(F.col("lang") == "en", F.lit("text/plain")).alias("content_type"),
        )
    )


def upload_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = envelopes.accepted(_uploads(spark, sf_dir))
    return comparable(
        envelopes.build_upload_envelopes(good, F.col("id"), F.col("at")).select(
            "key", F.md5("value").alias("value_md5"), "id", "event_time"
        )
    )


def rejected_uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelopes.rejected(_uploads(spark, sf_dir)).select("id", "reason")


def _sent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_places(_envelopes(spark, sf_dir), F.unix_micros("event_time"), partitions=4)


def topic_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was sent, written to topic files, read by the file stream and upserted."""
    path, warehouse = work_dir(spark, "topic"), Warehouse(spark, work_dir(spark, "tables"))
    write_topic_files(_sent(spark, sf_dir), path)
    fetch = fetch_from(page_answers(spark, sf_dir))
    run_to_end(stream_topic_files(spark, path), warehouse, fetch, work_dir(spark, "checkpoint"), counts=False)
    columns = ["id", "event_type", "event_time", "source", "payload", "image_object_key"]
    return comparable(warehouse.processed_events().select(*columns))


def sent_and_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Producer to table: what was sent, read as topic and upserted."""
    b = Backfill(_sent(spark, sf_dir), fetch_from(page_answers(spark, sf_dir)))
    return comparable(b.processed_events().select("id", "event_type", "event_time", "source", "payload", "image_object_key"))


# -- streams ------------------------------------------------------------------


def _run(spark: SparkSession, sf_dir: str, warehouse: Warehouse, rows: bool = True) -> Warehouse:
    """One of the two streaming queries over the whole topic, with a checkpoint of its own."""
    records, fetch = topic_records(spark, sf_dir, streaming=True), fetch_from(page_answers(spark, sf_dir))
    run_to_end(records, warehouse, fetch, work_dir(spark, "checkpoint"), rows=rows, counts=not rows)
    return warehouse


def _streamed(spark: SparkSession, sf_dir: str, rows: bool = True) -> Warehouse:
    configure(spark)
    return _run(spark, sf_dir, Warehouse(spark, work_dir(spark, "tables")), rows)


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot of what one checkpoint has read, then the topic anew with another checkpoint."""
    configure(spark)
    warehouse = Warehouse(spark, work_dir(spark, "tables"))
    b = _backfill(spark, sf_dir)
    warehouse.events_table.write(b.changes().where(F.col("source") != "retry"), 7)
    warehouse.compact()
    columns = [c for c in ROW_COLUMNS if c != "inserted_at"]
    return comparable(_run(spark, sf_dir, warehouse).processed_events().select(*columns))


def fetched_in_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image URLs fetched by Python in tasks; what stands behind a URL follows from it by rule."""
    b = _backfill(spark, sf_dir)

    def get(url: str):
        if url.startswith("https:"):
            return 200, "image/png", url.encode()
        return (404, None, None) if len(url) % 2 else (None, None, None)

    resolved = resolve_linked(routing.image_events(b.events), fetch_with(get))
    return resolved.select(
        "id", "object_key", "size", "reason", F.md5("content").alias("content_md5"), "src_partition", "src_offset"
    )


def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_streamed(spark, sf_dir, rows=False).event_type_counts().drop("updated_at"))


def stream_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [c for c in ROW_COLUMNS if c != "inserted_at"]
    return comparable(_streamed(spark, sf_dir).processed_events().select(*columns))


def stream_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return object_rows(_streamed(spark, sf_dir).current_objects())


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantined(_streamed(spark, sf_dir).quarantine())


def compacted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First deliveries, a snapshot of them, repeats, and the view over both."""
    b = _backfill(spark, sf_dir)
    rows = Warehouse(spark, work_dir(spark, "tables")).events_table
    changes = b.changes()
    rows.write(changes.where(F.col("source") != "retry"), 0)
    rows.compact()
    rows.write(changes.where(F.col("source") == "retry"), 1)
    return comparable(rows.current().select(*ROW_COLUMNS))


DEALS = 4


def _dealt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic with ``deal``: by ten days of record time, every seventh record one deal later."""
    days = F.floor((F.unix_timestamp("timestamp") - F.unix_timestamp(F.lit(START).cast("timestamp"))) / 864000)
    late = (F.col("offset") % 7 == 3).cast("int")
    deal = F.least(F.lit(DEALS - 1), F.greatest(F.lit(0), days) + late)
    return topic_records(spark, sf_dir).withColumn("deal", deal)


def _counted_by_state(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The topic in four deals, each a file dump that one run of the query reads to its end."""
    configure(spark)
    path, checkpoint = work_dir(spark, "topic"), work_dir(spark, "checkpoint")
    warehouse = Warehouse(spark, work_dir(spark, "tables"))
    dealt = _dealt(spark, sf_dir)
    for deal in range(DEALS):
        write_topic_files(dealt.where(F.col("deal") == deal), path)
        records = stream_topic_files(spark, path, max_files_per_batch=None)
        start_counts_and_late(records, warehouse, checkpoint, {"availableNow": True}).awaitTermination()
    return warehouse


def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = _counted_by_state(spark, sf_dir).late_events()
    return comparable(late.select("id", "event_type", "event_time", "source", "window_start", "window_end", "watermark", "src_partition", "src_offset"))


def counts_without_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_counted_by_state(spark, sf_dir).event_type_counts().drop("updated_at"))


def moved_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that move to a lower partition with lower offsets: a snapshot of the first deliveries, then the repeats."""
    configure(spark)
    again = (F.col("partition") == 0) & (F.col("offset") % 2 == 1)
    moved = topic_records(spark, sf_dir).withColumn("partition", F.when(again, 0).otherwise(F.col("partition") + 1))
    moved = moved.withColumn("offset", F.when(again, F.col("offset") - 2 * 10**9).otherwise(F.col("offset")))
    b = Backfill(moved, fetch_from(page_answers(spark, sf_dir)))
    rows = Warehouse(spark, work_dir(spark, "tables")).events_table
    changes = b.changes()
    rows.write(changes.where(F.col("src_partition") > 0), 0)
    rows.compact()
    rows.write(changes.where(F.col("src_partition") == 0), 1)
    return comparable(rows.current().select(*ROW_COLUMNS))


def _with_totals(spark: SparkSession, sf_dir: str) -> tuple[Backfill, Warehouse]:
    """First deliveries, totals of them, then repeats (some of another type), and the totals brought up to date."""
    b = _backfill(spark, sf_dir)
    warehouse, checkpoint = Warehouse(spark, work_dir(spark, "tables")), work_dir(spark, "checkpoint")
    # Worked out once for both deliveries: each pass reads all JSON of the topic.
    changes, path, repeat = b.changes(), work_dir(spark, "changes"), F.col("source") == "retry"
    changes.write.parquet(path)
    changes = spark.read.schema(changes.schema).parquet(path)
    for batch, part in enumerate((~repeat, repeat)):
        warehouse.events_table.write(changes.where(part), batch)
        start_totals(warehouse, checkpoint, {"availableNow": True}).awaitTermination()
    return b, warehouse


def hours_from_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, warehouse = _with_totals(spark, sf_dir)
    return comparable(analytics.count_by_hour_from_totals(warehouse.row_totals()))


def reconciled_from_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, warehouse = _with_totals(spark, sf_dir)
    return reconcile_totals(image_totals(warehouse.row_totals()), b.closed_counts())


QUERIES: dict[str, Query] = {
    "parse_events": _batch(parsed_events),
    "parse_quarantine": _batch(lambda b: quarantined(bad_records(b.parsed))),
    "quarantine": _batch(lambda b: quarantined(b.quarantine())),
    "payload_objects": _batch(payload_objects),
    "count_by_type_5m": _batch(lambda b: b.counts()),
    "count_by_type_5m_closed": _batch(lambda b: b.closed_counts()),
    "route_image": routed(routing.image_events),
    "route_data": routed(routing.data_events),
    "route_unrouted": routed(routing.unrouted_events),
    "image_objects": _batch(stored_images),
    "image_skipped": _batch(
        lambda b: skipped_images(routing.image_events(b.events)).select("id", "event_time", "src_offset")
    ),
    "list_objects": _batch(lambda b: objects.list_objects(b.image_objects())),
    "list_folder": _batch(folder_sizes),
    "fetch_objects": _batch(fetched_objects),
    "processed_events_current": _batch(current_rows),
    "counts_upsert": _batch(counts_upsert),
    "compacted_rows": compacted_rows,
    "q1_count_by_type": _batch(lambda b: analytics.count_by_type(b.processed_events("event_type"))),
    "q2_latest_20": _batch(lambda b: analytics.latest_events(b.processed_events(*LATEST))),
    "q3_by_hour": _batch(lambda b: analytics.count_by_hour(b.processed_events("event_time", "event_type"))),
    "q4_counts_5m": _batch(lambda b: analytics.window_counts(b.closed_counts())),
    "d1_count_by_type": _batch(lambda b: analytics.panel_count_by_type(b.processed_events("event_type"))),
    "d2_latest_20": _batch(lambda b: analytics.panel_latest_events(b.processed_events(*LATEST))),
    "d3_hourly_series": _batch(lambda b: analytics.panel_hourly(b.processed_events("event_time", "event_type"), *_range())),
    "d4_counts_series": _batch(lambda b: analytics.panel_window_counts(b.closed_counts(), *_range())),
    "count_image_rows": _batch(lambda b: count_image_rows(b.processed_events("event_type", "image_object_key"))),
    "sum_image_counts": _batch(lambda b: sum_image_counts(b.closed_counts())),
    "reconcile_images": _batch(reconciled),
    "adhoc_sql": by_sql,
    "build_envelopes": sent_records,
    "acknowledgements": acknowledged,
    "rejected_requests": rejected_requests,
    "build_upload_envelopes": upload_records,
    "rejected_uploads": rejected_uploads,
    "sent_and_parsed": sent_and_parsed,
    "stream_counts_5m": stream_counts,
    "stream_processed_events": stream_rows,
    "stream_image_objects": stream_objects,
    "topic_round_trip": topic_round_trip,
    "stream_restart": stream_restart,
    "fetch_in_tasks": fetched_in_tasks,
    "stream_quarantine": stream_quarantine,
    "stream_late_rows": late_rows,
    "stream_counts_late": counts_without_late_rows,
    "moved_partitions": moved_partitions,
    "hours_from_totals": hours_from_totals,
    "reconcile_from_totals": reconciled_from_totals,
}

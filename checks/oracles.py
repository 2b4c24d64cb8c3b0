"""What the queries must give, as SQL over the given tables.

The SQL works out events from the tables themselves and never sees JSON
records, so it shares no step with the code it checks.
"""

from __future__ import annotations


def _uuid(text: str) -> str:
    return f"regexp_replace(md5({text}), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5')"


def _b64(text: str) -> str:
    return f"to_base64(encode({text}))"


_START = "TIMESTAMP '2024-01-01 00:00:00'"
_JSON = "replace(props, ' ', '')"

# Every usable event, with the columns of a parsed one and where its bytes are.
GOOD = f"""
copies AS (
  SELECT e.*, c AS copy, c = 1 AS retry
  FROM events e, LATERAL (SELECT unnest(CASE WHEN event_type IN ('purchase', 'signup') THEN [0, 1] ELSE [0] END) AS c)
),
good AS (
  SELECT
    CASE WHEN event_type = 'click' THEN {_uuid("'events:0:' || (event_id * 2 + copy)::VARCHAR")}
         ELSE {_uuid("'event-' || event_id::VARCHAR")} END AS id,
    CASE WHEN event_type = 'error' THEN 'UNKNOWN'
         WHEN event_type = 'view' OR (event_type = 'signup' AND retry) THEN 'IMAGE'
         ELSE 'DATA' END AS event_type,
    ts AS event_time,
    CASE WHEN retry THEN 'retry' WHEN user_id % 3 <> 0 THEN 'ui' ELSE 'unknown' END AS source,
    CASE WHEN event_type IN ('click', 'purchase', 'signup') THEN {_JSON} END AS payload,
    NULL::VARCHAR AS image_url,
    CASE WHEN event_type = 'signup' AND retry THEN {_b64("props")} END AS image_base64,
    CASE WHEN event_type = 'signup' AND retry THEN encode(props) END AS bytes,
    'image/jpeg' AS image_content_type,
    'image/jpeg' AS content_type,
    0 AS src_partition,
    event_id * 2 + copy AS src_offset,
    CASE WHEN retry THEN ts + INTERVAL 1 HOUR ELSE ts END AS inserted_at,
    NULL::VARCHAR AS failure
  FROM copies
  UNION ALL
  SELECT
    {_uuid("'document-' || doc_id::VARCHAR")}, 'IMAGE', {_START} + to_minutes(doc_id), source, NULL, NULL,
    CASE WHEN source = 'src13' THEN '!' || text ELSE {_b64("text")} END,
    CASE WHEN source <> 'src13' THEN encode(text) END,
    CASE lang WHEN 'en' THEN 'image/PNG' WHEN 'fr' THEN 'image/webp' WHEN 'de' THEN 'IMAGE/GIF'
      ELSE ' ' || chr(9) END,
    CASE lang WHEN 'en' THEN 'image/PNG' WHEN 'fr' THEN 'image/webp' WHEN 'de' THEN 'IMAGE/GIF'
      ELSE 'image/jpeg' END,
    1, doc_id, {_START} + to_minutes(doc_id),
    CASE WHEN source = 'src13' THEN 'bad_base64' END
  FROM documents
  UNION ALL
  SELECT
    {_uuid("'page-' || page_id::VARCHAR")}, 'IMAGE', {_START} + to_minutes(page_id), 'crawl', NULL, url, NULL,
    CASE WHEN url LIKE 'https:%' THEN encode(html) END,
    'image/gif',
    CASE WHEN url LIKE '%.com/%' THEN 'text/html' ELSE 'image/gif' END,
    2, page_id, {_START} + to_minutes(page_id),
    CASE WHEN url NOT LIKE 'https:%' THEN 'fetch_status_404' END
  FROM pages
)"""

# What the records of the other tables, and the failed images, are quarantined for.
BAD = f"""
bad AS (
  SELECT 'bad_json' AS reason, 3 AS src_partition, conv_id * 100000 + turn AS src_offset, md5(text) AS value_md5
  FROM conversations
  UNION ALL
  SELECT 'bad_id', 4, doc_id,
    md5('{{"id":"doc-' || doc_id::VARCHAR || '","eventType":"DATA","payload":{{"quality":' || quality::VARCHAR
      || ',"toxic":' || toxic::VARCHAR || '}}}}')
  FROM labels
  UNION ALL
  SELECT 'bad_time', 5, item_id,
    md5('{{"id":"' || {_uuid("'item-' || item_id::VARCHAR")} || '","eventType":"DATA","eventTime":"2024-01-01","payload":{{"text":'
      || to_json(text)::VARCHAR || '}}}}')
  FROM benchmark
),
failed AS (
  SELECT 'bad_base64' AS reason, 1 AS src_partition, doc_id AS src_offset,
    md5('{{"id":"' || {_uuid("'document-' || doc_id::VARCHAR")} || '","eventType":"Image","eventTime":"'
      || strftime({_START} + to_minutes(doc_id) + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S') || '+02:00","source":"' || source
      || '","imageBase64":' || to_json('!' || text)::VARCHAR || ',"imageContentType":'
      || to_json(CASE lang WHEN 'en' THEN 'image/PNG' WHEN 'fr' THEN 'image/webp' WHEN 'de' THEN 'IMAGE/GIF'
           ELSE ' ' || chr(9) END)::VARCHAR || '}}') AS value_md5
  FROM documents WHERE source = 'src13'
  UNION ALL
  SELECT 'fetch_status_404', 2, page_id,
    md5('{{"id":"' || {_uuid("'page-' || page_id::VARCHAR")} || '","eventType":"IMAGE","eventTime":"'
      || strftime({_START} + to_minutes(page_id), '%Y-%m-%dT%H:%M:%S') || '.000000Z","source":"crawl","imageUrl":'
      || to_json(url)::VARCHAR || ',"imageContentType":"image/gif"}}')
  FROM pages WHERE url NOT LIKE 'https:%'
)"""

IMAGES = """
images AS (
  SELECT *, 'images/' || strftime(event_time, '%Y-%m-%d') || '/' || id
    || CASE WHEN contains(lower(content_type), 'png') THEN '.png'
            WHEN contains(lower(content_type), 'webp') THEN '.webp'
            WHEN contains(lower(content_type), 'gif') THEN '.gif' ELSE '.jpg' END AS object_key
  FROM good WHERE event_type = 'IMAGE' AND bytes IS NOT NULL
)"""

ROWS = """
changes AS (
  SELECT id, event_type, event_time, source, payload, NULL::VARCHAR AS image_object_key, inserted_at,
    src_partition, src_offset
  FROM good WHERE event_type = 'DATA'
  UNION ALL
  SELECT id, event_type, event_time, source, NULL, object_key, inserted_at, src_partition, src_offset FROM images
),
processed AS (
  SELECT id, event_type, event_time, source, payload, image_object_key,
    min(inserted_at) OVER (PARTITION BY id) AS inserted_at
  FROM changes
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY src_partition DESC, src_offset DESC) = 1
)"""

COUNTS = """
counts AS (
  SELECT time_bucket(INTERVAL '5 minutes', event_time) AS window_start,
    time_bucket(INTERVAL '5 minutes', event_time) + INTERVAL '5 minutes' AS window_end,
    event_type, count(*) AS event_count
  FROM good GROUP BY ALL
),
closed AS (
  SELECT * FROM counts
  WHERE window_end + INTERVAL '10 seconds' <= (SELECT max(event_time) FROM good)
)"""

# The topic in four deals; the watermark of a deal is ten seconds behind the newest event of those before it.
DEALT = f"""
dealt AS (
  SELECT *, least(3, greatest(0, floor(epoch(inserted_at - {_START}) / 864000)) + (src_offset % 7 = 3)::INT)::INT AS deal,
    time_bucket(INTERVAL '5 minutes', event_time) + INTERVAL '5 minutes' AS window_end
  FROM good
),
marked AS (
  SELECT d.*, (SELECT date_trunc('milliseconds', max(o.newest)) - INTERVAL '10 seconds'
    FROM (SELECT deal, max(event_time) AS newest FROM dealt GROUP BY deal) o WHERE o.deal < d.deal) AS watermark
  FROM dealt d
)"""

REQUESTS = f"""
requests AS (
  SELECT {_uuid("'request-' || event_id::VARCHAR")} AS id, ts AS sent_at,
    CASE WHEN event_type = 'purchase' THEN 'Data' ELSE event_type END AS event_type,
    CASE WHEN event_type <> 'view' THEN {_JSON} END AS payload, NULL::VARCHAR AS image_url,
    CASE WHEN event_type = 'error' THEN 'blank_event_type' END AS reason,
    '{{"eventType":"' || CASE WHEN event_type = 'error' THEN ' \\t' ELSE event_type END || '"'
      || CASE WHEN event_type <> 'view' THEN ',"payload":' || {_JSON} ELSE ',"imageUrl":"  "' END || '}}' AS body
  FROM events
  UNION ALL
  SELECT {_uuid("'page-request-' || page_id::VARCHAR")}, {_START} + to_minutes(page_id), 'IMAGE', NULL, url, NULL, NULL
  FROM pages
  UNION ALL
  SELECT {_uuid("'item-request-' || item_id::VARCHAR")}, {_START} + to_minutes(item_id), 'DATA', NULL, NULL, 'bad_body',
    '{{"eventType":"DATA","payload":[' || to_json(text)::VARCHAR || ']}}'
  FROM benchmark
)"""

RANGE = "BETWEEN TIMESTAMP '2024-01-08 00:00:00' AND TIMESTAMP '2024-01-22 12:00:00'"
_OBJECT = "object_key, content_type, octet_length(bytes)::BIGINT AS size, md5(bytes) AS content_md5"
_LATEST = "FROM processed ORDER BY inserted_at DESC, id LIMIT 20"


def _with(select: str, *parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


def _route(condition: str) -> str:
    return _with(
        f"SELECT id, event_type, event_time, source, src_partition, src_offset FROM good WHERE {condition}", GOOD
    )


def _rows(select: str) -> str:
    return _with(select, GOOD, IMAGES, ROWS)


def _counts(select: str) -> str:
    return _with(select, GOOD, COUNTS)


_ROW = "id, event_type, event_time, source, payload, image_object_key"
_QUARANTINE = _with("SELECT * FROM bad UNION ALL SELECT * FROM failed", BAD)
_CURRENT = _rows(f"SELECT {_ROW}, inserted_at FROM processed")
_CLOSED = _counts("SELECT window_start, window_end, event_type, event_count FROM closed")
_OBJECTS = _with(f"SELECT {_OBJECT} FROM images", GOOD, IMAGES)

ORACLES: dict[str, str] = {
    "parse_events": _with(
        "SELECT id, event_type, event_time, source, payload, src_partition, src_offset, image_url, "
        "md5(image_base64) AS image_base64_md5, image_content_type, event_time::DATE AS date FROM good",
        GOOD,
    ),
    "parse_quarantine": _with("SELECT * FROM bad", BAD),
    "quarantine": _QUARANTINE,
    "payload_objects": _with(
        "SELECT id, src_offset, (payload::JSON ->> 'k')::BIGINT AS k, payload FROM good WHERE payload IS NOT NULL", GOOD
    ),
    "count_by_type_5m": _counts("SELECT * FROM counts"),
    "count_by_type_5m_closed": _CLOSED,
    "route_image": _route("event_type = 'IMAGE'"),
    "route_data": _route("event_type = 'DATA'"),
    "route_unrouted": _route("event_type NOT IN ('IMAGE', 'DATA')"),
    "image_objects": _OBJECTS,
    "image_skipped": _with(
        "SELECT id, event_time, src_offset FROM good WHERE event_type = 'IMAGE' AND bytes IS NULL AND failure IS NULL",
        GOOD,
    ),
    "list_objects": _with("SELECT object_key, octet_length(bytes)::BIGINT AS size FROM images", GOOD, IMAGES),
    "list_folder": _with(
        "SELECT DISTINCT strftime(event_time, '%Y-%m-%d') || '/' AS name, NULL::BIGINT AS size FROM images", GOOD, IMAGES
    ),
    "fetch_objects": _rows(
        f"SELECT {_OBJECT} FROM images WHERE object_key IN (SELECT image_object_key FROM processed)"
    ),
    "processed_events_current": _CURRENT,
    "counts_upsert": _counts(
        "SELECT window_start, window_end, event_type, coalesce(n, event_count) AS event_count, "
        "CASE WHEN n IS NULL THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-02-02' END AS updated_at "
        "FROM counts LEFT JOIN (SELECT time_bucket(INTERVAL '5 minutes', event_time) AS window_start, event_type, "
        "count(*) AS n FROM good WHERE source <> 'retry' GROUP BY ALL) USING (window_start, event_type)"
    ),
    "compacted_rows": _CURRENT,
    "q1_count_by_type": _rows("SELECT event_type, count(*) AS count FROM processed GROUP BY 1"),
    "q2_latest_20": _rows(f"SELECT id, event_type, event_time, source, image_object_key, inserted_at {_LATEST}"),
    "q3_by_hour": _rows(
        "SELECT date_trunc('hour', event_time) AS hour, event_type, count(*) AS count FROM processed GROUP BY 1, 2"
    ),
    "q4_counts_5m": _CLOSED,
    "d1_count_by_type": _rows("SELECT event_type AS type, count(*) AS count FROM processed GROUP BY 1"),
    "d2_latest_20": _rows(f"SELECT id, event_type, event_time, image_object_key, inserted_at {_LATEST}"),
    "d3_hourly_series": _rows(
        "SELECT to_timestamp(floor(epoch(event_time) / 3600) * 3600)::TIMESTAMP AS time, count(*) AS value, "
        f"event_type AS metric FROM processed WHERE event_time {RANGE} GROUP BY ALL"
    ),
    "d4_counts_series": _counts(
        "SELECT window_start AS time, event_count AS value, event_type AS metric FROM closed "
        f"WHERE window_start {RANGE}"
    ),
    "count_image_rows": _rows(
        "SELECT count(*) AS total FROM processed WHERE event_type = 'IMAGE' AND image_object_key IS NOT NULL"
    ),
    "sum_image_counts": _counts(
        "SELECT coalesce(sum(event_count), 0)::BIGINT AS total FROM closed WHERE event_type = 'IMAGE'"
    ),
    "reconcile_images": _with(
        "SELECT *, n_objects - n_rows AS diff, n_objects = n_rows AS matches FROM (SELECT "
        "(SELECT count(DISTINCT object_key) FROM images) AS n_objects, "
        "(SELECT count(*) FROM processed WHERE event_type = 'IMAGE' AND image_object_key IS NOT NULL) AS n_rows, "
        "(SELECT coalesce(sum(event_count), 0)::BIGINT FROM closed WHERE event_type = 'IMAGE') AS n_counted)",
        GOOD, IMAGES, ROWS, COUNTS,
    ),
    "adhoc_sql": _rows(
        "SELECT source, event_type, count(*) AS n, count(payload) AS with_payload, "
        "count(image_object_key) AS with_image FROM processed GROUP BY 1, 2"
    ),
    "build_envelopes": _with(
        "SELECT id AS key, '{\"id\":\"' || id || '\",\"eventType\":\"' || event_type || '\",\"eventTime\":\"' "
        "|| strftime(sent_at, '%Y-%m-%dT%H:%M:%S.%f') || 'Z\",\"source\":\"ui\"' "
        "|| coalesce(',\"payload\":' || payload, '') || coalesce(',\"imageUrl\":' || to_json(image_url)::VARCHAR, '') "
        "|| '}' AS value FROM requests WHERE reason IS NULL",
        REQUESTS,
    ),
    "acknowledgements": _with("SELECT id, sent_at AS event_time FROM requests WHERE reason IS NULL", REQUESTS),
    "rejected_requests": _with(
        "SELECT id, reason, md5(body) AS body_md5 FROM requests WHERE reason IS NOT NULL", REQUESTS
    ),
    "build_upload_envelopes": f"""
SELECT id AS key, md5('{{"id":"' || id || '","eventType":"IMAGE","eventTime":"' || strftime(sent_at, '%Y-%m-%dT%H:%M:%S.%f')
    || 'Z","source":"ui","imageBase64":"' || {_b64("text")} || '","imageContentType":"'
    || CASE WHEN lang = 'en' THEN 'text/plain' ELSE 'application/octet-stream' END || '"}}') AS value_md5,
  id, sent_at AS event_time
FROM (SELECT *, {_uuid("'upload-' || doc_id::VARCHAR")} AS id, {_START} + to_minutes(doc_id) AS sent_at FROM documents)
WHERE source <> 'src0'""",
    "rejected_uploads": f"""
SELECT {_uuid("'upload-' || doc_id::VARCHAR")} AS id, 'empty_file' AS reason FROM documents WHERE source = 'src0'""",
    "sent_and_parsed": _with(
        """SELECT id, upper(event_type) AS event_type, sent_at AS event_time, 'ui' AS source, payload,
  CASE WHEN event_type = 'IMAGE' THEN 'images/' || strftime(sent_at, '%Y-%m-%d') || '/' || id || '.jpg' END
    AS image_object_key
FROM requests WHERE event_type = 'Data' OR image_url LIKE 'https:%'""",
        REQUESTS,
    ),
    "stream_counts_5m": _CLOSED,
    "stream_processed_events": _rows(f"SELECT {_ROW} FROM processed"),
    "stream_restart": _rows(f"SELECT {_ROW} FROM processed"),
    "fetch_in_tasks": f"""
SELECT id, CASE WHEN url LIKE 'https:%' THEN 'images/' || strftime(sent_at, '%Y-%m-%d') || '/' || id || '.png' END AS object_key,
  CASE WHEN url LIKE 'https:%' THEN strlen(url) END::BIGINT AS size,
  CASE WHEN url LIKE 'https:%' THEN NULL WHEN length(url) % 2 = 1 THEN 'fetch_status_404' ELSE 'fetch_failed' END AS reason,
  CASE WHEN url LIKE 'https:%' THEN md5(url) END AS content_md5, 2 AS src_partition, page_id AS src_offset
FROM (SELECT *, {_uuid("'page-' || page_id::VARCHAR")} AS id, {_START} + to_minutes(page_id) AS sent_at FROM pages)""",
    "stream_late_rows": _with(
        "SELECT id, event_type, event_time, source, window_end - INTERVAL '5 minutes' AS window_start, window_end, watermark, "
        "src_partition, src_offset FROM marked WHERE window_end <= watermark",
        GOOD, DEALT,
    ),
    "stream_counts_late": _with(
        "SELECT window_end - INTERVAL '5 minutes' AS window_start, window_end, event_type, count(*) AS event_count "
        "FROM marked WHERE watermark IS NULL OR window_end > watermark GROUP BY window_end, event_type "
        "HAVING window_end + INTERVAL '10 seconds' <= (SELECT max(event_time) FROM good)",
        GOOD, DEALT,
    ),
    # What an id is and when it came is all that counts; ids made of places name the new partition.
    "moved_partitions": _rows(f"SELECT {_ROW}, inserted_at FROM processed").replace("'events:0:'", "'events:1:'"),
    "stream_image_objects": _OBJECTS,
    "stream_quarantine": _QUARANTINE,
}
# The same rows by way of topic files.
ORACLES["hours_from_totals"] = ORACLES["q3_by_hour"]
ORACLES["reconcile_from_totals"] = ORACLES["reconcile_images"]
ORACLES["topic_round_trip"] = ORACLES["sent_and_parsed"]

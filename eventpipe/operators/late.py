"""Window counts that also give out the events that come too late.

An event is late if the watermark has reached the end of its window when its
micro-batch begins. The engine's own window aggregate drops such rows without a
trace; here state and timers are kept by hand. State lies in slots: windows and
types are dealt over them, each in several parts, so that neither a hot window
nor a hot type makes a hot slot. A slot holds the counts of its open windows and
a timer at the end of the first of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from eventpipe.operators.counts import LATENESS, WINDOW
from eventpipe.schemas import PLACE

# Tasks that keep state, and parts that a window and type is counted in. A query keeps the numbers it began with.
SLOTS, PARTS = 64, 8
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_EVENT = ["id", "source", "event_micros", "src_micros", "src_partition", "src_offset"]
_RESULT = (
    "window_end_ms long, event_type string, event_count long, watermark_ms long, "
    "id string, source string, event_micros long, src_micros long, src_partition int, src_offset long"
)
_COLUMNS = [part.split()[0] for part in _RESULT.split(", ")]
_WHOLE = {"event_count": "Int64", "event_micros": "Int64", "src_micros": "Int64", "src_partition": "Int32", "src_offset": "Int64"}


class WindowCounter(StatefulProcessor):
    """Counts the events of a slot by window and type; gives a number out when its window closes."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "ends array<long>, types array<string>, counts array<long>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        counts = self._load()
        for batch in rows:
            late = batch["window_end_ms"] <= watermark
            for window, n in batch[~late].groupby(["window_end_ms", "event_type"]).size().items():
                counts[window] = counts.get(window, 0) + int(n)
            if late.any():
                yield batch.loc[late, ["window_end_ms", "event_type", *_EVENT]].assign(event_count=None, watermark_ms=watermark)[_COLUMNS].astype(_WHOLE)
        self._store(counts)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        counts = self._load()
        closed = sorted(window for window in counts if window[0] <= watermark)
        found = [{"window_end_ms": end, "event_type": kind, "event_count": counts.pop((end, kind)), "watermark_ms": watermark} for end, kind in closed]
        yield pd.DataFrame(found).reindex(columns=_COLUMNS).astype({"id": object, "source": object, **_WHOLE})
        self._store(counts)

    def _load(self) -> dict[tuple[int, str], int]:
        if not self.open.exists():
            return {}
        ends, types, counts = self.open.get()
        return dict(zip(zip(ends, types, strict=True), counts, strict=True))

    def _store(self, counts: dict[tuple[int, str], int]) -> None:
        if not counts:
            self.open.clear()
            return
        windows = sorted(counts)
        self.open.update(([end for end, _ in windows], [kind for _, kind in windows], [counts[w] for w in windows]))
        if windows[0][0] not in set(self.handle.listTimers()):
            self.handle.registerTimer(windows[0][0])

    def close(self) -> None:
        pass


def window_results(events: DataFrame, slots: int = SLOTS, parts: int = PARTS) -> DataFrame:
    """Parts of counts of closed windows, and late events, with the columns of ``schemas.WINDOW_RESULTS``.

    Needs the state store ``ROCKS_DB``. All parts of a window come out in the same
    micro-batch, as one watermark closes them.
    """
    marked = events.select("id", "event_type", "event_time", "source", *PLACE).withWatermark("event_time", LATENESS)
    size = F.expr(f"unix_millis(timestamp_seconds(0) + INTERVAL {WINDOW})")
    at = F.unix_millis("event_time")
    # The time itself stays behind: the engine would drop rows older than the watermark, though their window is open.
    end = at - F.pmod(at, size) + size
    part = F.pmod(F.xxhash64(*PLACE), F.lit(parts))
    keyed = marked.select(
        F.pmod(F.xxhash64(end, "event_type", part), F.lit(slots)).cast("int").alias("slot"),
        end.alias("window_end_ms"),
        "event_type",
        "id",
        "source",
        F.unix_micros("event_time").alias("event_micros"),
        F.unix_micros("src_time").alias("src_micros"),
        "src_partition",
        "src_offset",
    )
    results = keyed.groupBy("slot").transformWithStateInPandas(WindowCounter(), _RESULT, "Append", "EventTime")
    end = F.timestamp_millis("window_end_ms")
    return results.select(
        (end - F.expr(f"INTERVAL {WINDOW}")).alias("window_start"),
        end.alias("window_end"),
        "event_type",
        "event_count",
        F.timestamp_millis("watermark_ms").alias("watermark"),
        "id",
        "source",
        F.timestamp_micros("event_micros").alias("event_time"),
        F.timestamp_micros("src_micros").alias("src_time"),
        "src_partition",
        "src_offset",
    )


def summed_counts(results: DataFrame) -> DataFrame:
    """Counts per window and type from the parts that closed together; ``closed_by`` is the watermark that did it."""
    parts = results.where(F.col("event_count").isNotNull())
    return parts.groupBy("window_start", "window_end", "event_type").agg(
        F.sum("event_count").alias("event_count"), F.max("watermark").alias("closed_by")
    )

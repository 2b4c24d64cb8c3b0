"""Totals over the current rows, kept up to date by additions and retractions.

The latest row per id is a view over all history. Here the state knows for each
id what its row counts for at present: when a change replaces the row, one is
taken from the hour and type of the old version and given to those of the new
one. A report is then a sum over a small table, whatever the age of the rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from eventpipe.operators.routing import IMAGE
from eventpipe.schemas import PLACE

# Tasks that keep state; ids are dealt over them. A query keeps the number it began with.
SLOTS = 64
# Ids in a bundle of the state, on average, and rows of a slot that are taken together.
BUNDLE_IDS, HELD_ROWS = 128, 200_000

_RESULT = "hour_micros long, event_type string, n_rows long, n_image_rows long, n_objects long"
_COLUMNS = [part.split()[0] for part in _RESULT.split(", ")]
_PLACE = ["src_micros", "src_partition", "src_offset"]


class RowTotals(StatefulProcessor):
    """Knows of each id of its slot the place, hour, type and object key of its row, and all its object keys.

    A state call takes far longer than the row it is for, so ids lie in bundles and the rows that meet a bundle
    are taken together. Bundles are split one after the other as ids come in (linear hashing): they
    stay small whatever the age of the state, and a small micro-batch touches few of them. A bundle is JSON text,
    as the state converts nested values cell by cell.
    """

    def __init__(self, bundle_ids: int = BUNDLE_IDS, held_rows: int = HELD_ROWS) -> None:
        self.bundle_ids, self.held_rows = bundle_ids, held_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.size = handle.getValueState("size", "n_ids long, n_bundles int")
        self.bundles = handle.getMapState("bundles", "bundle int", "rows string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        totals: dict[tuple[int, str], list[int]] = {}

        def add(hour: int, kind: str, n_rows: int, n_images: int, n_objects: int) -> None:
            total = totals.setdefault((hour, kind), [0, 0, 0])
            for i, n in enumerate((n_rows, n_images, n_objects)):
                total[i] += n

        n_ids, n_bundles = self.size.get() or (0, 1)
        for changes in self._held(rows):
            if len(changes) > n_ids:
                # Most are new. Otherwise most may be known, and are counted first.
                n_bundles = self._split(n_ids, n_bundles, -(-(n_ids + len(changes)) // self.bundle_ids))
            met: dict[int, list] = {}
            for id, (hashed, versions) in changes.items():
                met.setdefault(bundle_of(hashed, n_bundles), []).append((id, hashed, versions))
            for bundle, found in met.items():
                held = self._load(bundle) if n_ids else {}
                before = len(held)
                for id, hashed, versions in found:
                    known = held.get(id)
                    _, place, hour, kind, object_key, keys = known or (hashed, None, None, None, None, [])
                    n_keys, old = len(keys), (hour, kind, object_key)
                    for hour_now, kind_now, key_now, *at in sorted(versions, key=lambda v: v[3:]):
                        if key_now is not None and key_now not in keys:
                            keys.append(key_now)
                        if place is None or at >= place:
                            place, hour, kind, object_key = at, hour_now, kind_now, key_now
                    if known:
                        add(old[0], old[1], -1, -(old[1] == IMAGE and old[2] is not None), 0)
                    add(hour, kind, 1, int(kind == IMAGE and object_key is not None), len(keys) - n_keys)
                    held[id] = [hashed, place, hour, kind, object_key, keys]
                self._store(bundle, held)
                met[bundle] = len(held) - before
            n_ids += sum(met.values())
            n_bundles = self._split(n_ids, n_bundles, -(-n_ids // self.bundle_ids))
        self.size.update((n_ids, n_bundles))
        found = [(hour, kind, *n) for (hour, kind), n in totals.items() if any(n)]
        yield pd.DataFrame(found, columns=_COLUMNS)

    def _held(self, rows: Iterator[pd.DataFrame]) -> Iterator[dict[str, tuple[int, list]]]:
        """Hash and versions of each id, of about ``held_rows`` rows at a time."""
        changes: dict[str, tuple[int, list]] = {}
        n = 0
        for batch in rows:
            columns = ("id", "id_hash", "hour_micros", "event_type", "object_key", *_PLACE)
            for id, hashed, *version in zip(*(batch[c].tolist() for c in columns), strict=True):
                changes.setdefault(id, (hashed, []))[1].append(version)
            n += len(batch)
            if n >= self.held_rows:
                yield changes
                changes, n = {}, 0
        if changes:
            yield changes

    def _split(self, n_ids: int, n_bundles: int, wanted: int) -> int:
        """Makes it ``wanted`` bundles, if there are fewer; each new one takes its ids from one other."""
        if not n_ids:
            return max(n_bundles, wanted)
        while n_bundles < wanted:
            low, new = n_bundles - (1 << n_bundles.bit_length() - 1), n_bundles
            n_bundles += 1
            held = self._load(low)
            moved = {id: row for id, row in held.items() if bundle_of(row[0], n_bundles) == new}
            if moved:
                self._store(new, moved)
                self._store(low, {id: row for id, row in held.items() if id not in moved})
        return n_bundles

    def _load(self, bundle: int) -> dict[str, list]:
        """Hash, place, hour, type, object key and all object keys of each id."""
        found = self.bundles.getValue((bundle,))
        return {id: row for id, *row in json.loads(found[0])} if found else {}

    def _store(self, bundle: int, held: dict[str, list]) -> None:
        if held:
            self.bundles.updateValue((bundle,), (json.dumps([[id, *row] for id, row in held.items()]),))
        else:
            self.bundles.removeKey((bundle,))

    def close(self) -> None:
        pass


def bundle_of(hashed: int, n_bundles: int) -> int:
    """Where linear hashing puts a hash: by as many of its lowest bits as there is a bundle for."""
    span = 1 << (n_bundles - 1).bit_length()
    bundle = hashed % span
    return bundle if bundle < n_bundles else bundle - span // 2


def row_totals(changes: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Additions and retractions (hour, event_type, n_rows, n_image_rows, n_objects) of a stream of row changes.

    Needs the state store ``ROCKS_DB``. A change that comes twice, or after a later one of its id, adds nothing.
    """
    seconds, partition, offset = PLACE
    keyed = changes.select(
        F.pmod(F.xxhash64("id"), F.lit(slots)).cast("int").alias("slot"),
        "id",
        F.xxhash64(F.lit(1), "id").alias("id_hash"),
        F.unix_micros(F.date_trunc("hour", "event_time")).alias("hour_micros"),
        "event_type",
        F.col("image_object_key").alias("object_key"),
        F.coalesce(F.unix_micros(seconds), F.lit(0)).alias("src_micros"),
        F.col(partition).alias("src_partition"),
        F.col(offset).alias("src_offset"),
    )
    found = keyed.groupBy("slot").transformWithStateInPandas(RowTotals(), _RESULT, "Update", "None")
    return found.select(F.timestamp_micros("hour_micros").alias("hour"), *_COLUMNS[1:])


def summed_totals(parts: DataFrame) -> DataFrame:
    """One row per hour and type that still counts for something."""
    measures = ("n_rows", "n_image_rows", "n_objects")
    summed = parts.groupBy("hour", "event_type").agg(*[F.sum(m).alias(m) for m in measures])
    return summed.where(" OR ".join(f"{m} <> 0" for m in measures))

"""Tables kept as one folder per micro-batch.

Plain files have no MERGE. A batch overwrites its own folder, so that running
it again changes nothing, and readers take folders that are complete. Batch
numbers begin at 0 again with a new checkpoint, so folders are kept by run: by
the id of the streaming query, which lives in its checkpoint. What an
upsert means (the last row per key) is worked out when reading, and from time
to time written down as a snapshot by ``compact``. Tables without keys put many
small batches together in spans by ``fold``.

The newest batch of a run may be written again: its commit comes after its
folder. It is never part of a snapshot or span. ``expire`` removes what a
snapshot or span has replaced, after a time of grace for readers that began
before, so folders do not grow in number with the age of a stream.
"""

from __future__ import annotations

import hashlib
import re
import time
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, types as T

from eventpipe.operators.upsert import latest_per_key, merge_changes

_BATCH = re.compile(r"^batch_id=(\d+)$")
_RUN = re.compile(r"^run=(.+)$")
_SNAPSHOT = re.compile(r"^number=(\d+)-buckets=(\d+)-[0-9a-f]+$")
_SPAN = re.compile(r"^from=(\d+)$")
CUT_OFFS = T.StructType([T.StructField("run", T.StringType()), T.StructField("upto", T.LongType())])
DEFAULT_RUN = "batch"

# How long a reader may work with what it found when it began.
GRACE_SECONDS = 24 * 3600
# Folders whose files are smaller on average are put together, up to so many bytes.
SMALL_FILE, SPAN_BYTES = 32 << 20, 8 << 30
# Later changes up to so many bytes a bucket are hashed to meet a snapshot, so that it need not be sorted.
HASHED_BYTES = 64 << 20

Batch = tuple[str, int]
# First and last batch of a run that a folder holds together.
Span = tuple[str, int, int]


class BatchTable:
    """Rows of micro-batches, each batch in a folder of its own."""

    def __init__(
        self, spark: SparkSession, root: str, schema: T.StructType, partition_by: Sequence[str] = (),
        options: dict[str, str] | None = None, combine: Callable[[DataFrame], DataFrame] | None = None,
    ) -> None:
        """``combine``: what rows of several batches become when they are put together, for sums and the like."""
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.partition_by, self.options, self.combine = list(partition_by), options or {}, combine or (lambda rows: rows)

    def batch_path(self, batch: Batch) -> str:
        return f"{self.root}/log/run={batch[0]}/batch_id={batch[1]}"

    def span_path(self, span: Span) -> str:
        return f"{self.root}/spans/run={span[0]}/batch_id={span[2]}/from={span[1]}"

    def write(self, rows: DataFrame, batch_id: int, run: str = DEFAULT_RUN) -> None:
        self._write(rows.select(*self.schema.names), self.batch_path((run, batch_id)))

    def _write(self, rows: DataFrame, path: str) -> None:
        if self.partition_by:
            # Otherwise every task writes a file for each partition it has rows of. Large partitions are split by size.
            rows = rows.hint("rebalance", *self.partition_by)
        writer = rows.write.mode("overwrite").options(**self.options)
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(path)

    def batches(self, above: dict[str, int] | None = None) -> list[Batch]:
        """Batches that are complete, as (run, number); of a run in ``above`` only those with larger numbers."""
        above = above or {}
        runs = (m[1] for name in self._folders("log") if (m := _RUN.match(name)))
        return sorted((run, n) for run in runs for n in self._numbers(run, above.get(run, -1)))

    def _numbers(self, run: str, above: int) -> list[int]:
        folder = f"log/run={run}"
        names = {int(m[1]): name for name in self._folders(folder) if (m := _BATCH.match(name))}
        return [n for n, name in names.items() if n > above and self._finished(f"{folder}/{name}")]

    def spans(self) -> list[Span]:
        """Spans that are complete, none inside another."""
        found = self._all_spans()
        return [s for s in found if not any(o[0] == s[0] and o != s and o[1] <= s[1] and o[2] >= s[2] for o in found)]

    def _all_spans(self) -> list[Span]:
        found = []
        for run in (m[1] for name in self._folders("spans") if (m := _RUN.match(name))):
            for name in self._folders(f"spans/run={run}"):
                for inner in self._folders(f"spans/run={run}/{name}"):
                    if (b := _BATCH.match(name)) and (f := _SPAN.match(inner)) and self._finished(f"spans/run={run}/{name}/{inner}"):
                        found.append((run, int(f[1]), int(b[1])))
        return found

    def read(self, batches: Sequence[Batch] | None = None, with_batch: bool = False) -> DataFrame:
        """Rows of the given batches or of all; ``with_batch`` adds ``run`` and ``batch_id``, the last one of a span."""
        spans = self.spans() if batches is None else []
        wanted = batches if batches is not None else _outside(self.batches(), spans)
        columns = [*self.schema.names, *(["run", "batch_id"] if with_batch else [])]
        schema = T.StructType([*self.schema.fields, T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())])
        places = {"log": [self.batch_path(b) for b in wanted], "spans": [self.span_path(s) for s in spans]}
        frames = [
            # From the base path on, folders are partitions: run, batch and those inside it.
            self.spark.read.schema(schema).option("basePath", f"{self.root}/{base}").parquet(*paths).select(*columns)
            for base, paths in places.items()
            if paths
        ]
        if not frames:
            return self.spark.createDataFrame([], schema).select(*columns)
        return reduce(DataFrame.unionByName, frames)

    def stream(self) -> DataFrame:
        """The rows of batches as they come in, each batch that is written again anew.

        A reader must not fall behind by more than the time of grace of ``expire``.
        """
        schema = T.StructType([*self.schema.fields, T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())])
        self._fs().mkdirs(self._path(f"{self.root}/log"))
        reader = self.spark.readStream.schema(schema).option("ignoreMissingFiles", "true")
        return reader.parquet(f"{self.root}/log").select(*self.schema.names)

    def fold(self, small_file: int = SMALL_FILE, span_bytes: int = SPAN_BYTES) -> list[Span]:
        """Put neighbouring folders with small files together, and return the new spans.

        A folder of large files is left as it is, and so is the newest batch of a
        run. Rows stay what they are; where folders hold the same partition, its
        rows get common files.
        """
        spans, made = self.spans(), []
        pieces = [(run, n, n) for run, n in _outside(self._closed(self.batches()), spans)] + spans
        for run in sorted({p[0] for p in pieces}):
            group, held = [], 0
            for piece in [*sorted(p for p in pieces if p[0] == run), None]:
                size, files = self._weight(piece) if piece else (0, 0)
                small = piece is not None and size < small_file * files
                if group and (not small or held + size > span_bytes):
                    if len(group) > 1:
                        made.append(self._join(group))
                    group, held = [], 0
                if small:
                    group.append(piece)
                    held += size
        return made

    def _join(self, pieces: list[Span]) -> Span:
        span = (pieces[0][0], pieces[0][1], pieces[-1][2])
        logs = [self.batch_path((r, n)) for r, first, n in pieces if (r, first, n) not in self.spans()]
        older = [self.span_path(s) for s in pieces if s in self.spans()]
        frames = [
            self.spark.read.schema(self.schema).option("basePath", path).parquet(path).select(*self.schema.names)
            for path in logs + older
        ]
        self._write(self.combine(reduce(DataFrame.unionByName, frames)), self.span_path(span))
        return span

    def expire(self, grace_seconds: float = GRACE_SECONDS) -> None:
        """Remove folders whose rows a span has had for longer than the time of grace."""
        old = [s for s in self._all_spans() if self._age(self.span_path(s)) >= grace_seconds]
        for run, n in self.batches():
            if any(s[0] == run and s[1] <= n <= s[2] for s in old):
                self._delete(self.batch_path((run, n)))
        for s in self._all_spans():
            if any(o[0] == s[0] and o != s and o[1] <= s[1] and o[2] >= s[2] for o in old):
                self._delete(self.span_path(s))

    @staticmethod
    def _closed(batches: Sequence[Batch]) -> list[Batch]:
        """Batches that will not be written again: all but the newest of each streaming run."""
        newest = {run: max(n for r, n in batches if r == run) for run in {r for r, _ in batches}}
        return [(run, n) for run, n in batches if run == DEFAULT_RUN or n < newest[run]]

    def _weight(self, piece: Span) -> tuple[int, int]:
        """Bytes and files of a folder."""
        path = self.span_path(piece) if piece in self.spans() else self.batch_path((piece[0], piece[2]))
        summary = self._fs().getContentSummary(self._path(path))
        return summary.getLength(), max(summary.getFileCount() - 1, 1)

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._path(self.root).getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _folders(self, folder: str) -> list[str]:
        path, fs = self._path(f"{self.root}/{folder}"), self._fs()
        return [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()] if fs.exists(path) else []

    def _finished(self, folder: str) -> bool:
        return self._fs().exists(self._path(f"{self.root}/{folder}/_SUCCESS"))

    def _complete(self, folder: str) -> list[str]:
        return [name for name in self._folders(folder) if self._finished(f"{folder}/{name}")]

    def _age(self, path: str) -> float:
        """Seconds since a folder was completed."""
        return time.time() - self._fs().getFileStatus(self._path(f"{path}/_SUCCESS")).getModificationTime() / 1000

    def _delete(self, path: str) -> None:
        self._fs().delete(self._path(path), True)


def _outside(batches: Sequence[Batch], spans: Sequence[Span]) -> list[Batch]:
    return [(run, n) for run, n in batches if not any(s[0] == run and s[1] <= n <= s[2] for s in spans)]


class KeyedTable(BatchTable):
    """A batch table read as one row per key."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        keys: Sequence[str],
        order: Sequence[str],
        first: Sequence[str] = (),
        buckets: int | None = None,
    ) -> None:
        super().__init__(spark, root, schema)
        self.keys, self.order, self.first = list(keys), list(order), list(first)
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def current(self) -> DataFrame:
        """The snapshot with later batches upserted into it.

        The snapshot is bucketed by key. With no fewer buckets than shuffle
        partitions, the join shuffles the later batches only, however large the
        snapshot has become, and hashes them, so that the snapshot is read as it
        lies and never sorted.
        """
        return self._merged(*self._state())

    def _merged(self, snapshot: tuple[str, int, int] | None, later: Sequence[Batch]) -> DataFrame:
        if snapshot is None:
            return self._collapsed(later)
        base = self._snapshot_frame(*snapshot)
        if not later:
            return base
        delta = self._collapsed(later)
        if sum(self._weight((run, n, n))[0] for run, n in later) <= HASHED_BYTES * snapshot[2]:
            delta = delta.hint("shuffle_hash")
        return merge_changes(base, delta, self.keys, self.order, self.first)

    def compact(self) -> None:
        """Write a new snapshot of everything up to the last closed batch of every run.

        It goes to a new folder with the cut-off of each run beside it; readers
        switch to it once it is complete.
        """
        snapshot, later = self._state()
        later = self._closed(later)
        if not later:
            return
        buckets = snapshot[2] if snapshot else self.buckets
        number = snapshot[1] + 1 if snapshot else 0
        folder = f"number={number}-buckets={buckets}-{uuid.uuid4().hex}"
        path = f"{self.root}/snapshot/{folder}"
        rows = self._merged(snapshot, later)
        upto = {**self._cut_offs(snapshot), **{run: n for run, n in sorted(later)}}
        self.spark.createDataFrame(list(upto.items()), CUT_OFFS).coalesce(1).write.parquet(
            f"{self.root}/cut_offs/{folder}"
        )
        if snapshot is None or not self._joins_by_bucket(buckets):
            # Otherwise the join with the old snapshot has left rows in buckets already.
            rows = rows.repartition(buckets, *self.keys)
        (
            rows.write.format("parquet")
            .bucketBy(buckets, *self.keys)
            .option("path", path)
            .saveAsTable(self._table_name(path))
        )

    def expire(self, grace_seconds: float = GRACE_SECONDS) -> None:
        """Remove batches and snapshots that a snapshot has replaced for longer than the time of grace."""
        old = [s for s in self._snapshots() if self._age(f"{self.root}/snapshot/{s[0]}") >= grace_seconds]
        if not old:
            return
        *_, newest = old
        upto = self._cut_offs(newest)
        for run, n in self.batches():
            if n <= upto.get(run, -1):
                self._delete(self.batch_path((run, n)))
        for snapshot in self._snapshots():
            if snapshot[1] < newest[1]:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._table_name(f'{self.root}/snapshot/{snapshot[0]}')}")
                self._delete(f"{self.root}/snapshot/{snapshot[0]}")
                self._delete(f"{self.root}/cut_offs/{snapshot[0]}")

    def fold(self, *_) -> list[Span]:
        raise TypeError("a table with keys is compacted, not folded")

    def _joins_by_bucket(self, buckets: int) -> bool:
        """Spark keeps the buckets in a join if they are not fewer than its own partitions."""
        return buckets >= int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _collapsed(self, batches: Sequence[Batch]) -> DataFrame:
        return latest_per_key(self.read(batches), self.keys, self.order, self.first)

    def _cut_offs(self, snapshot: tuple[str, int, int] | None) -> dict[str, int]:
        """Last batch of each run that the snapshot holds: a row per run."""
        if snapshot is None:
            return {}
        rows = self.spark.read.schema(CUT_OFFS).parquet(f"{self.root}/cut_offs/{snapshot[0]}")
        return {r["run"]: r["upto"] for r in rows.collect()}

    def _state(self) -> tuple[tuple[str, int, int] | None, list[Batch]]:
        """Newest snapshot as (folder, number, buckets), and the batches it lacks."""
        snapshot = max(self._snapshots(), key=lambda s: (s[1], s[0]), default=None)
        return snapshot, self.batches(self._cut_offs(snapshot))

    def _snapshots(self) -> list[tuple[str, int, int]]:
        found = [(m[0], int(m[1]), int(m[2])) for n in self._complete("snapshot") if (m := _SNAPSHOT.match(n))]
        return sorted(found, key=lambda s: (s[1], s[0]))

    def _snapshot_frame(self, folder: str, _: int, buckets: int) -> DataFrame:
        path = f"{self.root}/snapshot/{folder}"
        name = self._table_name(path)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        keys = ", ".join(f"`{k}`" for k in self.keys)
        # Another session wrote the files, maybe; this one needs to know the buckets.
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
            f"CLUSTERED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        return self.spark.table(name)

    @staticmethod
    def _table_name(path: str) -> str:
        return f"snapshot_{hashlib.md5(path.encode()).hexdigest()}"

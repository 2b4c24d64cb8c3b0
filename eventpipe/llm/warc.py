"""Deterministic sharded WARC archives, and reading them back.

Records are range-sorted by page_id, then payload digest, then address. A shard
is what lies between two multiples of ``SHARD_BYTES`` of payload in that order, so
shards, files and their bytes depend on the records alone, not on the session,
the cluster or the order of the input. A shard begins a new file when the
compressed size reaches ``ROLL_BYTES``. A file is written under a temporary name
that holds the task attempt and then renamed to its final name; a task that runs
again, or twice at once, replaces a file by the same. The manifest of all files
is written by Spark to a temporary folder and renamed last: an archive without
manifest does not exist, and readers open only what the manifest lists.

Of records with equal payloads of at least ``MIN_REVISIT_BYTES`` the one with
the smallest page_id is the response; the others are revisits without payload.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from eventpipe.llm.common import Scratch, bound_batches, join_groups

MIN_REVISIT_BYTES = 100
ROLL_BYTES = 64 << 20
# Payload bytes from the first record of a shard to the first of the next. The first record's page_id, digest and
# address of each shard are what tasks need to know: some 100 bytes for each ``SHARD_BYTES``.
SHARD_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"
READ_BYTES = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "file string, first_page string, records bigint, bytes bigint, sha256 string"
RECORD = "page_id string, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to string"


def with_types(pages: DataFrame, scratch: Scratch, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(page_id, url, payload, digest, refers_to) of every page; ``refers_to`` is null for responses."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    # Counted from digests alone; a digest held once needs no join.
    first = (
        rows.where(F.octet_length("payload") >= min_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
        .where("copies > 1")
    )
    joined = join_groups(rows, scratch.settle(first, "copies"), ["digest"], "copies", ["page_id"], "left")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first")), F.col("first"))
    return joined.select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def shard_bounds(rows: DataFrame, scratch: Scratch, shard_bytes: int) -> list[tuple]:
    """Where shards begin, all but the first: (page_id, digest, url) of their first records, nulls first.

    Sizes are summed up in the order of the records: within a partition of the
    sorted table, on top of the partitions before it. Rows that are alike in all
    three are one entry, and stay in one shard.
    """
    sizes = rows.groupBy("page_id", "digest", "url").agg(F.sum(F.octet_length("payload")).cast("long").alias("bytes"))
    ordered = scratch.settle(
        sizes.orderBy("page_id", "digest", "url").select("*", F.monotonically_increasing_id().alias("pos")), "ordered"
    ).withColumn("part", F.shiftright("pos", 33))
    # A row for each partition of the sort.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ordered.groupBy("part").agg(F.sum("bytes").alias("held"))
    parts = parts.select("part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("offset"))
    own = Window.partitionBy("part").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum("bytes").over(own), F.lit(0)) + F.col("offset")
    shard = F.floor(begin / F.lit(shard_bytes))
    first = ordered.join(F.broadcast(parts), "part").withColumn("shard", shard).groupBy("shard").agg(F.min(F.struct("page_id", "digest", "url")).alias("first"))
    return [tuple(r["first"]) for r in first.where("shard > 0").orderBy("shard").collect()]


def _place(page_id, digest: str, url: str | None) -> tuple:
    """Sorts as Spark does, nulls first."""
    return page_id is not None, page_id, digest, url is not None, url


def _shard_of(bounds: list[tuple], spark: SparkSession):
    """The number of the shard of a record."""
    places = spark.sparkContext.broadcast([_place(*b) for b in bounds])

    @F.arrow_udf("int")
    def shard(page_id: pa.Array, digest: pa.Array, url: pa.Array) -> pa.Array:
        known = places.value
        rows = zip(*(column.to_pylist() for column in (page_id, digest, url)), strict=True)
        return pa.array([bisect_right(known, _place(*row)) for row in rows], pa.int32())

    return shard


def record_id(page_id: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One record: headers made anew from the page, then the HTTP block."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", DATE),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    if page_id is not None:
        fields.append(("X-Page-ID", quote(str(page_id), safe="")))
    if revisit:
        fields += [
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", record_id(refers_to, digest)),
            ("X-Refers-To-Page-ID", quote(str(refers_to), safe="")),
        ]
    fields.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def file_system(path: str):
    """The file system of a URI or local path, and the path within it."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else "file://" + path[len("file:"):])
    return fs.LocalFileSystem(), path


class Shard:
    """One archive file being written under a temporary name."""

    def __init__(self, folder: str, name: str, attempt: int):
        self.files, self.folder = file_system(folder)
        self.name, self.temporary = name, f"{self.folder}/.{name}.{attempt}.tmp"
        self.files.create_dir(self.folder, recursive=True)
        self.out = self.files.open_output_stream(self.temporary, compression=None)
        self.sha256, self.bytes, self.records, self.first = hashlib.sha256(), 0, 0, None

    def add(self, page_id, record: bytes) -> None:
        # Each record is a gzip member of its own, without time or name.
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        data = packer.compress(record) + packer.flush()
        self.out.write(data)
        self.sha256.update(data)
        self.bytes += len(data)
        self.first = page_id if self.records == 0 else self.first
        self.records += 1

    def commit(self) -> tuple:
        self.out.close()
        self.files.move(self.temporary, f"{self.folder}/{self.name}")
        return self.name, None if self.first is None else str(self.first), self.records, self.bytes, self.sha256.hexdigest()

    def abandon(self) -> None:
        self.out.close()
        self.files.delete_file(self.temporary)


def write_archive(
    pages: DataFrame, folder: str, scratch: Scratch, roll_bytes: int = ROLL_BYTES, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """Write ``pages`` (page_id, url, html, more) as WARC files below ``folder``; the committed manifest.

    A null html is an empty payload, a null url has no target, a page without
    id is written without one. Rows that repeat both id and payload are all
    responses if that id is the smallest. Other columns are ignored. An empty
    table makes an archive of no files.
    """
    spark = pages.sparkSession
    paths = spark._jvm.org.apache.hadoop.fs
    final = paths.Path(f"{folder}/manifest")
    files = final.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(final):
        raise OSError(f"there is an archive in {folder} already")
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt, files, shard, now, rolled = TaskContext.get().taskAttemptId(), [], None, None, 0
        try:
            for batch in batches:
                for i in range(batch.num_rows):
                    number, page_id, url, payload, digest, refers_to = (c[i].as_py() for c in batch.columns)
                    if number != now:
                        if shard is not None:
                            files.append(shard.commit())
                        shard, now, rolled = None, number, 0
                    if shard is None:
                        shard = Shard(folder, f"part-{number:06d}-{rolled:05d}.warc.gz", attempt)
                    shard.add(page_id, record_bytes(page_id, url, payload, digest, refers_to))
                    if shard.bytes >= roll_bytes:
                        files.append(shard.commit())
                        shard, rolled = None, rolled + 1
            if shard is not None:
                files.append(shard.commit())
                shard = None
        finally:
            if shard is not None:
                shard.abandon()
        columns = list(zip(*files)) or [()] * 5
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["file", "first_page", "records", "bytes", "sha256"]
        )

    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    bounds = shard_bounds(rows, scratch, shard_bytes)
    bound_batches(spark)
    typed = with_types(pages, scratch).withColumn("shard", _shard_of(bounds, spark)("page_id", "digest", "url"))
    # Where Spark draws its own bounds is open; shards stay whole, and files are named after them.
    ordered = typed.repartitionByRange(len(bounds) + 1, "shard").sortWithinPartitions("shard", "page_id", "digest", "url")
    ordered = ordered.select("shard", "page_id", "url", "payload", "digest", "refers_to")
    ordered.mapInArrow(write, MANIFEST).write.mode("overwrite").parquet(f"{folder}/manifest.tmp")
    if not files.rename(paths.Path(f"{folder}/manifest.tmp"), final):
        raise OSError(f"the manifest of {folder} was not committed")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


class Inflated:
    """The concatenated gzip members of a stream as one, read in pieces."""

    def __init__(self, stream):
        self.stream, self.ready, self.rest = stream, bytearray(), b""
        self.unpacker = zlib.decompressobj(31)

    def _fill(self, n: int) -> bool:
        """Have ``n`` bytes ready; false if the stream ends before."""
        while len(self.ready) < n:
            data = self.rest or self.stream.read(READ_BYTES)
            self.rest = b""
            if not data:
                return False
            self.ready += self.unpacker.decompress(data, READ_BYTES)
            self.rest = self.unpacker.unconsumed_tail
            if self.unpacker.eof:
                self.rest = self.unpacker.unused_data
                self.unpacker = zlib.decompressobj(31)
        return True

    def take(self, n: int) -> bytes:
        if not self._fill(n):
            raise EOFError("a record is cut off")
        data = bytes(self.ready[:n])
        del self.ready[:n]
        return data

    def head(self) -> bytes | None:
        """Up to and with the next empty line; null at the end."""
        seen = 0
        while (at := self.ready.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(self.ready)
            if not self._fill(seen + 1):
                if self.ready:
                    raise EOFError("a header is cut off")
                return None
        return self.take(at + 4)


def records_of(path: str) -> Iterator[tuple]:
    """Rows of RECORD in one file; the digest of every stored payload is taken anew and compared."""
    from urllib.parse import unquote

    files, inner = file_system(path)
    with files.open_input_stream(inner, compression=None) as stream:
        text = Inflated(stream)
        while (head := text.head()) is not None:
            lines = head.decode().split("\r\n")
            if lines[0] != "WARC/1.1":
                raise ValueError(f"no record where one is due in {path}")
            fields = dict(line.split(": ", 1) for line in lines[1:] if line)
            http = text.head()
            left = int(fields["Content-Length"]) - len(http)
            size, digest = int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha256:")
            if fields["WARC-Type"] == "response":
                taken = hashlib.sha256()
                size = left
                while left:
                    piece = text.take(min(left, READ_BYTES))
                    taken.update(piece)
                    left -= len(piece)
                if taken.hexdigest() != digest:
                    raise ValueError(f"a payload in {path} does not match its digest")
            text.take(4)
            page_id, refers_to = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
            yield (
                None if page_id is None else unquote(page_id), fields.get("WARC-Target-URI"), size, digest,
                fields["WARC-Type"], None if refers_to is None else unquote(refers_to),
            )


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """One row (RECORD) for each record of the files in the manifest."""
    kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string())
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                rows: list[tuple] = []
                for row in records_of(f"{folder}/{file}"):
                    rows.append(row)
                    if len(rows) == 1000:
                        yield _batch(rows, kinds, names)
                        rows = []
                if rows:
                    yield _batch(rows, kinds, names)

    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("file").repartition(parts, "file").mapInArrow(read, RECORD)


def _batch(rows: list[tuple], kinds, names) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``pages``, written to an archive in the shared folder and read back."""
    scratch = Scratch(spark, "warc")
    folder = f"{scratch.path}/archive"
    write_archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder, scratch)
    return read_archive(spark, folder).drop("url")


ORACLE = """
WITH pages_ AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages
),
firsts AS (SELECT digest, min(page_id) AS first FROM pages_ WHERE n >= 100 GROUP BY digest)
SELECT page_id::VARCHAR AS page_id, n::BIGINT AS payload_bytes, p.digest AS payload_digest,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first::VARCHAR END AS refers_to
FROM pages_ p LEFT JOIN firsts f ON p.digest = f.digest AND n >= 100
"""

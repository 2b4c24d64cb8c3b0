"""What several operators share: settled tables, filters before joins, salted joins, connected components."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventpipe.session import work_dir

# [\x20\x09-\x0D]: the white space that the contracts of these operators name.
BLANKS = " \t\n\x0b\x0c\r"
# A key is heavy if it holds over a thousandth of all rows: there are at most a thousand such keys.
HEAVY_KEYS = 1000
# ``maybe_among`` broadcasts at most so many rows of 64 bits each.
FILTER_WORDS = 1 << 18


# What an Arrow batch may hold, so that very long texts come a few at a time.
BATCH_BYTES = "8m"


def bound_batches(spark: SparkSession) -> None:
    """Sessions that run these operators hand texts to Python in batches of ``BATCH_BYTES``, or of one row."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def trim_memory() -> None:
    """Give memory that a Python worker no longer uses back to its machine; workers wait for tasks of later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


class Scratch:
    """A new folder below ``spark.checkpoint.dir`` for the tables one job settles.

    Frames returned to callers read it, so it is theirs to ``remove()``.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.path = work_dir(spark, purpose)

    def settle(self, frame: DataFrame, name: str) -> DataFrame:
        """Write ``frame`` as Parquet and read it back: computed once, lineage cut, size known."""
        target = f"{self.path}/{name}"
        frame.write.mode("overwrite").parquet(target)
        return self.spark.read.schema(frame.schema).parquet(target)

    def drop(self, *names: str) -> None:
        """Remove tables that nothing reads any more."""
        for name in names:
            self._delete(f"{self.path}/{name}")

    def keep(self, *names: str) -> None:
        """Remove all tables but these."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(path)
        self.drop(*[name for s in found if (name := s.getPath().getName()) not in names])

    def remove(self) -> None:
        self._delete(self.path)

    def _delete(self, path: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; every other letter stays."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha256_hex(text: Column) -> Column:
    """Lower-case hex SHA-256 of the text in UTF-8."""
    return F.sha2(text.cast("binary"), 256)


def maybe_among(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``rows`` but most of those whose ``key`` is not in ``wanted``, so that an exact join after it moves few others.

    Each wanted key sets a bit of a bitmap, which is broadcast in words; it has one size however many keys there
    are, and with more keys than bits it lets more of the other rows pass. ``wanted`` should be settled.
    """
    place = F.pmod(F.xxhash64(key), F.lit(64 * FILTER_WORDS))
    bit = F.expr("shiftleft(1L, cast(place % 64 AS int))")
    words = wanted.select(place.alias("place")).groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    met = (F.shiftright(place, 6) == F.col("filter.word")) & (F.getbit("filter.bits", place % 64) == 1)
    return rows.join(F.broadcast(words).alias("filter"), met, "left_semi")


def join_groups(
    rows: DataFrame,
    groups: DataFrame,
    keys: Sequence[str],
    weight: str,
    salt_by: Sequence[str],
    how: str = "inner",
) -> DataFrame:
    """Join ``rows`` to ``groups``, which holds few rows for a key, without a hot partition.

    ``weight`` in ``groups`` is the number of rows of a key, alike in all groups of it. A key with a share s
    of all weight is dealt over ceil(1000 s) salts, its group repeated as often,
    so that no partition gets over a thousandth of the rows for one key. Only
    keys with over a thousandth of the weight are broadcast: at most a thousand.
    ``groups`` should be settled, as it is read three times.
    """
    total = groups.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    copies = F.greatest(F.lit(1), F.ceil(F.col(weight) * HEAVY_KEYS / F.lit(max(total, 1)))).cast("int")
    heavy = groups.where(F.col(weight) * HEAVY_KEYS > total).select(*keys, copies.alias("_copies")).distinct()
    # A null key matches nothing, so its rows may go anywhere.
    no_key = F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))
    spread = F.when(no_key, HEAVY_KEYS).otherwise(F.coalesce("_copies", F.lit(1)))
    salted = rows.join(F.broadcast(heavy), list(keys), "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*salt_by), spread).cast("int")
    )
    repeated = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), copies - 1)))
    return salted.drop("_copies").join(repeated, [*keys, "_salt"], how).drop("_salt")


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); a component is its smallest node.

    Alternates two steps until nothing changes: every node links its larger
    neighbours, then its smaller ones, to the smallest of all. Each step is an
    aggregate and a salted join, so a node with very many edges is no hot spot.
    """
    now = scratch.settle(_ordered(edges), "edges-0")
    before, step = None, 0
    while (state := _fingerprint(now)) != before:
        before, step = state, step + 1
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _linked_to_least(both, scratch, f"large-{step}").where("v > u").select("v", "least")
        large = scratch.settle(_ordered(large.toDF("a", "b")), f"edges-{step}-large")
        down = large.select(F.col("b").alias("a"), F.col("a").alias("b"))
        small = _linked_to_least(down, scratch, f"small-{step}")
        up = small.select("v", "least").union(small.select("u", "least").distinct())
        now = scratch.settle(_ordered(up.toDF("a", "b")), f"edges-{step}")
        scratch.drop(f"edges-{step - 1}", f"edges-{step}-large", f"large-{step}", f"small-{step}")
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    )


def _ordered(edges: DataFrame) -> DataFrame:
    """Each edge once, the smaller node first; no loops."""
    return (
        edges.where(F.col("a") != F.col("b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def _linked_to_least(arcs: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Arcs (a, b) as (u, v, least): ``least`` is the smallest of u and all its v."""
    arcs = arcs.toDF("u", "v")
    least = arcs.groupBy("u").agg(
        F.least(F.min("v"), F.col("u")).alias("least"), F.count("*").alias("degree")
    )
    return join_groups(arcs, scratch.settle(least, name), ["u"], "degree", ["v"])


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

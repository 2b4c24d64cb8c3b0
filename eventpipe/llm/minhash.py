"""Near-duplicates by one-permutation MinHash.

Every text is a set of hashed word shingles. One pass makes a sketch of it: the
hash space is cut into ``BINS`` bins, each keeps its least hash, and an empty
bin takes the value of the first full bin in a fixed random order of its own
(optimal densification). ``BANDS`` bands of ``ROWS`` bins each give the
buckets; two sets of similarity 0.8 share no bucket with a chance of 5e-8.

Texts with equal sets are one class, of which only the smallest id goes on.
Within a bucket every class is paired with the smallest only, so there are at
most as many pairs as bucket entries. Pairs are confirmed on the full sets,
and links joined to components.

A star alone would miss links between two classes that are both unlike its
centre. Classes that share a bucket but no component, its centre left out, are
joined exactly after that, by prefixes: the shingles of each are put in the
order of how many of these classes have them, the rarest first, and of two sets
with a link at least one shingle among the first ``n - overlap + 1`` of both is
the same, ``overlap`` being what a link of two sets of their sizes needs. A
shingle that only one class has takes its place in that order and is not sent.
Copies just below the limit, each with words of its own, have prefixes of such
shingles and meet nobody.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventpipe.llm.byte_bpe import slices
from eventpipe.llm.common import Scratch, bound_batches, connected_components, join_groups, maybe_among, trim_memory

SIMILARITY_PERCENT = 80
SHINGLE_WORDS = 2
BANDS, ROWS = 32, 4
BINS = BANDS * ROWS
BIN_BITS = 7
SEED = 20_26
# Sizes of sets are dealt into classes, each a fiftieth larger than the one before: partners of one class need one prefix.
SIZE_STEP = 1.02
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Powers:
    """Powers of an odd number and of its inverse modulo 2^64, grown as needed."""

    def __init__(self, seed: int):
        self.base = int(mix(np.array([seed], np.uint64))[0]) | 1
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, self.base, np.uint64)])
                self.down = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, pow(self.base, -1, 1 << 64), np.uint64)])
        return self.up, self.down


_POWERS = Powers(SEED)


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of every word, A-Z lower-cased; words are cut at ``[\\x20\\x09-\\x0D]``.

    Differences of one running sum of byte times power: no loop over words.
    """
    data = _LOWER[np.frombuffer(text.encode("utf-8"), dtype=np.uint8)]
    inside = np.r_[False, ~_SPACE[data], False]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _POWERS.upto(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])]
        return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _BASE)


def shingle_set(text: str, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` words; of the whole sequence if it is shorter; none without words."""
    words = word_hashes(text)
    if not len(words):
        return words
    size = min(size, len(words))
    with np.errstate(over="ignore"):
        h = np.full(len(words) - size + 1, size, np.uint64)
        for i in range(size):
            h = mix(h * _BASE + words[i : len(words) - size + 1 + i])
    return np.unique(h)


def _orders() -> np.ndarray:
    """For each bin, all bins in a random order: where it looks for a value if it is empty."""
    random = np.random.default_rng(SEED)
    return np.array([random.permutation(BINS) for _ in range(BINS)])


_ORDERS = _orders()


def sketch(own: np.ndarray) -> np.ndarray:
    """The least hash of each bin of a set that is not empty, densified."""
    bins = (own >> np.uint64(64 - BIN_BITS)).astype(np.int64)
    full, first = np.unique(bins, return_index=True)
    values = np.zeros(BINS, np.uint64)
    values[full] = own[first]
    filled = np.zeros(BINS, bool)
    filled[full] = True
    empty = np.flatnonzero(~filled)
    if len(empty):
        donors = _ORDERS[empty]
        values[empty] = values[donors[np.arange(len(empty)), filled[donors].argmax(axis=1)]]
    return values


def buckets(own: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band."""
    rows = sketch(own).reshape(BANDS, ROWS)
    with np.errstate(over="ignore"):
        h = np.arange(1, BANDS + 1, dtype=np.uint64)
        for i in range(ROWS):
            h = mix(h * _BASE + rows[:, i])
    return h


def _set_key(own: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    with np.errstate(over="ignore"):
        a = mix(own + _BASE).sum(dtype=np.uint64) + np.uint64(len(own))
        b = np.bitwise_xor.reduce(mix(own * _BASE + np.uint64(1))) + mix(own ^ _BASE).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def with_sketches(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n_shingles, k1, k2, bands) of every row; no bands for a text without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in slices(batch.column(1)):
                sets = [shingle_set(t, size) for t in texts]
                keys = [_set_key(s) if len(s) else (None, None) for s in sets]
                bands = [buckets(s).view(np.int64) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, len(texts)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([k for k, _ in keys], pa.int64()),
                        pa.array([k for _, k in keys], pa.int64()),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", "k1", "k2", "bands"],
                )
        trim_memory()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_shingles bigint, k1 bigint, k2 bigint, bands array<bigint>"
    )


def with_sets(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, shingles) with the full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in slices(batch.column(1)):
                sets = pa.array([shingle_set(t, size).view(np.int64) for t in texts], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)), sets], names=["doc_id", "shingles"]
                )
        trim_memory()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, shingles array<bigint>")


def verified(pairs: DataFrame, sets: DataFrame, percent: int, scratch: Scratch, name: str) -> DataFrame:
    """``pairs`` (a, b) with ``shared`` and ``total`` shingles of the full sets.

    The side with hot ids, the centres, is joined salted; the sets of b move first.
    """
    centres = scratch.settle(pairs.groupBy("a").agg(F.count("*").alias("pairs")), f"{name}-centres")
    left = pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("of_b")), "b")
    right = centres.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("of_a")), "a")
    shared = F.size(F.array_intersect("of_a", "of_b"))
    joined = join_groups(left, scratch.settle(right, f"{name}-centre-sets"), ["a"], "pairs", ["b"])
    return joined.select("a", "b", shared.alias("shared"), (F.size("of_a") + F.size("of_b")).alias("sizes")).select(
        "a", "b", "shared", (F.col("sizes") - F.col("shared")).alias("total")
    )


def near_duplicates(
    docs: DataFrame, percent: int = SIMILARITY_PERCENT, size: int = SHINGLE_WORDS, scratch: Scratch | None = None
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text, more).

    Two rows are linked if their shingle sets have at least ``percent`` of
    their union in common. A null or empty text, or one of blanks only, has an
    empty set and no links. Rows that share a doc_id are one node. A row
    without doc_id takes no part: its component is null and it is kept.
    ``component_id`` is the smallest doc_id that can be reached. Other columns
    are ignored. An empty table gives an empty one. The frame reads tables of
    ``scratch``, a new one if none is given.
    """
    scratch = scratch or Scratch(docs.sparkSession, "near-duplicates")
    bound_batches(docs.sparkSession)
    rows = scratch.settle(with_sketches(docs, size), "sketches")
    classes = scratch.settle(
        rows.where("doc_id IS NOT NULL AND k1 IS NOT NULL")
        .groupBy("k1", "k2")
        .agg(
            F.min("doc_id").alias("rep"),
            F.count("*").alias("members"),
            F.first("n_shingles").alias("n"),
            F.first("bands").alias("bands"),
        ),
        "classes",
    )
    entries = classes.select("rep", "n", F.explode("bands").alias("bucket"))
    full = scratch.settle(
        entries.groupBy("bucket")
        .agg(F.min("rep").alias("centre"), F.count("*").alias("entries"))
        .where("entries > 1"),
        "buckets",
    )
    # Few buckets hold two classes: the entries of the others are left where they are.
    shared = maybe_among(entries, "bucket", full)
    members = scratch.settle(
        join_groups(shared, full, ["bucket"], "entries", ["rep"]).select("bucket", "rep", "n", "centre"), "members"
    )
    stars = members.where("rep <> centre").select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()
    stars = scratch.settle(stars, "stars")
    ends = scratch.settle(members.select(F.col("rep").alias("doc_id")).distinct(), "ends")
    # Sets are made again from the texts, of the classes that share a bucket only; other texts do not move.
    texts = maybe_among(docs.select("doc_id", "text"), "doc_id", ends)
    sets = scratch.settle(with_sets(texts.join(ends, "doc_id", "left_semi"), size), "sets")

    tried = scratch.settle(verified(stars, sets, percent, scratch, "stars"), "tried")
    linked = F.col("shared") * 100 >= F.col("total") * percent
    links = tried.where(linked).select("a", "b").distinct()
    parts = scratch.settle(connected_components(links, scratch), "parts")
    left = scratch.settle(unlinked_pairs(members, parts, sets, percent, scratch), "left")
    more = verified(left, sets, percent, scratch, "left").where(linked).select("a", "b").distinct()
    more = scratch.settle(more, "more")
    scratch.keep("sketches", "classes", "tried", "more")

    # Two rows of one doc_id may be of two classes; the id is one node all the same.
    nodes = rows.where("doc_id IS NOT NULL AND k1 IS NOT NULL").select("doc_id", "k1", "k2")
    labelled = join_groups(nodes, classes.select("k1", "k2", "rep", "members"), ["k1", "k2"], "members", ["doc_id"])
    shared_ids = (
        labelled.groupBy("doc_id")
        .agg(F.min("rep").alias("a"), F.max("rep").alias("b"))
        .where("a <> b")
        .select("a", "b")
    )
    whole = scratch.settle(connected_components(links.union(more).union(shared_ids), scratch), "components")
    labels = classes.join(whole.withColumnRenamed("node", "rep"), "rep", "left").select(
        "k1", "k2", "members", F.coalesce("component", "rep").alias("component_id")
    )
    labels = scratch.settle(labels, "labels")
    found = join_groups(rows.drop("bands"), labels, ["k1", "k2"], "members", ["doc_id"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def unlinked_pairs(
    members: DataFrame, parts: DataFrame, sets: DataFrame, percent: int, scratch: Scratch
) -> DataFrame:
    """Pairs (a, b) of two components, among members of common buckets, that a common prefix lets be linked."""
    own = members.where("rep <> centre").join(parts.withColumnRenamed("node", "rep"), "rep", "left")
    own = own.withColumn("component", F.coalesce("component", "rep"))
    # A bucket whose members are all linked, or that has one beside its centre, has no such pair.
    torn = own.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    own = own.join(torn.select("bucket"), "bucket", "left_semi").select("rep", "component").distinct()
    own = scratch.settle(own, "torn")
    # Under one id there may be several sets, each a node of its own here.
    placed = sets.join(own.withColumnRenamed("rep", "doc_id"), "doc_id").select(
        F.col("doc_id").alias("rep"), "component", F.xxhash64("shingles").alias("set"),
        F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"),
    )
    placed = scratch.settle(placed, "shingles")
    common = placed.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    known = join_groups(placed, scratch.settle(common, "common-shingles"), ["shingle"], "df", ["rep", "set"])
    ordered = known.groupBy("rep", "component", "set", "n").agg(F.array_sort(F.collect_list(F.struct("df", "shingle"))).alias("shared"))
    # The shingles of one class alone come first. No partner needs more than this prefix of the whole order.
    alone, longest = F.col("n") - F.size("shared"), F.floor(F.col("n") * (100 - percent) / 100) + 1
    ordered = ordered.withColumn("alone", alone).where(alone < longest)
    heads = ordered.select(
        "rep", "component", "n", "alone", F.posexplode(F.slice("shared", F.lit(1), (longest - F.col("alone")).cast("int"))).alias("at", "head")
    ).select("rep", "component", "n", (F.col("alone") + F.col("at")).alias("pos"), F.col("head.shingle").alias("shingle"), _size_class(F.col("n")).alias("class"))
    least, most = F.ceil(F.col("n") * percent / 100), F.floor(F.col("n") * 100 / percent)
    dealt = heads.withColumn("other", F.explode(F.sequence(_size_class(least), _size_class(most))))
    smallest = F.greatest(least, F.floor(F.pow(F.lit(SIZE_STEP), F.col("other"))) - 1)
    dealt = dealt.where(F.col("pos") <= F.col("n") - _overlap(F.col("n"), smallest, percent)).select(
        "shingle", F.least("class", "other").alias("low"), F.greatest("class", "other").alias("high"), "rep", "component", "n", "pos", "class"
    )
    dealt = scratch.settle(dealt, "prefixes")
    p, q = dealt.alias("p"), dealt.alias("q")
    needed = _overlap(F.col("p.n"), F.col("q.n"), percent)
    may = (
        (F.col("p.shingle") == F.col("q.shingle"))
        & (F.col("p.low") == F.col("q.low"))
        & (F.col("p.high") == F.col("q.high"))
        & (F.col("p.rep") < F.col("q.rep"))
        & (F.col("p.component") != F.col("q.component"))
        & ((F.col("p.low") == F.col("p.high")) | (F.col("p.class") != F.col("q.class")))
        & (F.least("p.n", "q.n") * 100 >= F.greatest("p.n", "q.n") * percent)
        # What stands from the common shingle on must be enough for the overlap.
        & (F.least(F.col("p.n") - F.col("p.pos"), F.col("q.n") - F.col("q.pos")) >= needed)
    )
    return p.join(q, may).select(F.col("p.rep").alias("a"), F.col("q.rep").alias("b")).distinct()


def _size_class(n: Column) -> Column:
    return F.floor(F.log(n.cast("double")) / math.log(SIZE_STEP) + 1e-9).cast("int")


def _overlap(n: Column, m: Column, percent: int) -> Column:
    """Shingles that two sets of these sizes have in common at least if they are linked."""
    return F.ceil((n + m) * percent / (100 + percent) - 1e-9)


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))

"""Line dedup over levelled sorted runs of line hashes.

The index is a set of runs. A run holds hashes of line keys, each once and
sorted within hash buckets, with the number of documents and the largest
doc_id that hold the line. A batch adds one run of level 0; as soon as a level
has ``FANOUT`` runs they are merged into one of the next level. All runs have
the same buckets, so merges and anti-joins of runs move no rows.

A batch leaves out what the runs already settle: a key that one run counts in
enough documents, with a doc_id at least as large, cannot change by more
sightings. Batches come in descending order of doc_id, so very frequent lines
stop entering the index once they are settled.

Only DataFrame functions are used.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventpipe.llm.common import BLANKS, Scratch, ascii_lower, join_groups, sha256_hex

MIN_CHARS = 40
MIN_DOCS = 5
BATCHES = 4
FANOUT = 3
KEY = ["h1", "h2"]
ADDED = ("n_lines", "n_dropped", "kept")


class LineRuns:
    """The levelled runs; ``remove()`` drops tables and files."""

    def __init__(self, spark: SparkSession, scratch: Scratch, min_docs: int = MIN_DOCS, fanout: int = FANOUT):
        self.spark, self.scratch, self.min_docs, self.fanout = spark, scratch, min_docs, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.prefix = f"line_runs_{uuid.uuid4().hex}"
        self.levels: list[list[str]] = [[]]
        self.made: list[str] = []

    def store(self, entries: DataFrame, *by: str) -> str:
        """Write entries bucketed and sorted by hash, in folders of ``by`` if given."""
        name = f"{self.prefix}_{len(self.made)}"
        self.made.append(name)
        writer = (
            entries.repartition(self.buckets, *KEY)
            .write.bucketBy(self.buckets, *KEY)
            .sortBy(*KEY)
            .option("path", f"{self.scratch.path}/{name}")
        )
        (writer.partitionBy(*by) if by else writer).saveAsTable(name)
        return name

    def add(self, entries: DataFrame) -> None:
        """Merge-anti-join a batch of (h1, h2, n_docs, last_doc) with every run and add the rest as a run."""
        for name in (n for level in self.levels for n in level):
            settled = self.spark.table(name).where(F.col("n_docs") >= self.min_docs)
            settled = settled.select(*KEY, F.col("last_doc").alias("settled_doc"))
            same = [entries[k] == settled[k] for k in KEY]
            known = entries["last_doc"].isNull() | (entries["last_doc"] <= settled["settled_doc"])
            entries = entries.join(settled, [*same, known], "left_anti")
        self._put(0, self.store(entries))

    def _put(self, level: int, name: str) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            merged = self.store(self._merged(self.levels[level]))
            self.levels[level] = []
            self._put(level + 1, merged)

    def _merged(self, names: list[str]) -> DataFrame:
        """Runs as one: sums and maxima per hash. Buckets of all runs match, so this is no shuffle."""
        whole = self.spark.table(names[0])
        for name in names[1:]:
            a, b = whole.alias("a"), self.spark.table(name).alias("b")
            whole = a.join(b, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in KEY], "full_outer").select(
                *[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in KEY],
                (F.coalesce("a.n_docs", F.lit(0)) + F.coalesce("b.n_docs", F.lit(0))).alias("n_docs"),
                F.greatest("a.last_doc", "b.last_doc").alias("last_doc"),
            )
        return whole

    def frequent(self) -> DataFrame:
        """Hashes in enough documents, with the last document that holds them."""
        names = [n for level in self.levels for n in level]
        return self._merged(names).where(F.col("n_docs") >= self.min_docs)

    def remove(self) -> None:
        for name in self.made:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_keys(text: Column) -> Column:
    """Keys of all lines: blanks stripped at both ends, A-Z lower-cased."""
    return F.transform(lines_of(ascii_lower(text)), lambda line: F.btrim(line, F.lit(BLANKS)))


def _hashes(key: Column) -> list[Column]:
    """128 bits from two independent seeds."""
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")]


def repeated_lines(docs: DataFrame, scratch: Scratch, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(h1, h2, n_docs, last_doc) of the line keys found in at least ``min_docs`` rows of ``docs``."""
    spark = docs.sparkSession
    bounds = docs.agg(
        F.percentile_approx("doc_id", [i / BATCHES for i in range(1, BATCHES)], 1000).alias("at")
    ).first()["at"]
    # Batch 0 has the largest ids; rows without id come last.
    batch = F.lit(BATCHES - 1)
    for i, bound in enumerate(bounds or []):
        batch = F.when(F.col("doc_id") > bound, BATCHES - 2 - i).otherwise(batch)
    keys = F.array_distinct(
        F.filter(line_keys(F.col("text")), lambda key: F.char_length(key) >= min_chars)
    )
    runs = LineRuns(spark, scratch, min_docs)
    incoming = runs.store(
        docs.select("doc_id", batch.alias("batch"), F.explode(keys).alias("key"))
        .select("doc_id", "batch", *_hashes(F.col("key")))
        .groupBy("batch", *KEY)
        .agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc")),
        "batch",
    )
    for i in range(BATCHES):
        runs.add(spark.table(incoming).where(F.col("batch") == i).select(*KEY, "n_docs", "last_doc"))
    found = scratch.settle(runs.frequent(), "repeated")
    runs.remove()
    return found


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` (doc_id, text, more) with the columns ``n_lines``, ``n_dropped`` and ``kept`` added.

    Texts are split at ``\\n``; a null or empty text is one empty line. A line
    with a key of at least ``min_chars`` code points that at least ``min_docs``
    rows hold goes, except in the row with the largest doc_id that holds it; a
    document keeps or loses all its lines of one key. Rows that share a doc_id
    count as so many documents and keep alike. A null doc_id counts as the
    smallest; a key held by such rows alone keeps its lines. Other columns are
    handed through, but those that have the name of an added one.
    """
    scratch = Scratch(docs.sparkSession, "line-dedup")
    repeated = repeated_lines(docs, scratch, min_chars, min_docs)
    places = docs.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        F.posexplode(line_keys(F.col("text"))).alias("pos", "key"),
    ).where(F.char_length("key") >= min_chars)
    places = places.select("doc_id", "text_hash", "pos", *_hashes(F.col("key")))
    lost = join_groups(places, repeated, KEY, "n_docs", ["doc_id", "pos"]).where(
        (F.col("doc_id") < F.col("last_doc")) | (F.col("doc_id").isNull() & F.col("last_doc").isNotNull())
    )
    lost = scratch.settle(
        lost.groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("lost")), "lost"
    )
    whole = docs.select(F.struct("*").alias("row"))
    same = F.col("row.doc_id").eqNullSafe(lost["doc_id"]) & (F.xxhash64("row.text") == lost["text_hash"])
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "lost")
    # Lines are cut after the join: rows that are dealt out by key hold the text once.
    met = whole.join(lost, same, "left").select("row", "lost", lines_of(F.col("row.text")).alias("lines"))
    done = met.select(
        "row",
        F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("lost").isNotNull(), F.size("lost")).otherwise(0).cast("long").alias("n_dropped"),
        F.when(F.col("lost").isNull(), F.coalesce("row.text", F.lit("")))
        .otherwise(F.array_join(F.transform(kept, lambda i: F.element_at("lines", i + 1)), "\n"))
        .alias("kept"),
    )
    rest = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in ADDED]
    return done.select(*rest, *ADDED)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digest columns for all of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", sha256_hex(F.col("kept")).alias("kept_sha256"))


ORACLE = r"""
WITH lines AS (
  SELECT d.rowid_ AS r, doc_id, i AS pos, part[i] AS line,
    lower_ AS key, length(lower_) AS n
  FROM (SELECT row_number() OVER () AS rowid_, doc_id, string_split(coalesce(text, ''), chr(10)) AS part FROM documents) d,
    LATERAL (SELECT unnest(range(1, len(part) + 1)) AS i),
    LATERAL (SELECT translate(trim(part[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_)
),
often AS (
  SELECT key, max(doc_id) AS last_doc FROM lines WHERE n >= 40
  GROUP BY key HAVING count(DISTINCT r) >= 5
),
marked AS (
  SELECT lines.*, often.key IS NOT NULL AND (doc_id < last_doc OR doc_id IS NULL AND last_doc IS NOT NULL) AS lost
  FROM lines LEFT JOIN often ON lines.key = often.key
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM marked GROUP BY r
"""

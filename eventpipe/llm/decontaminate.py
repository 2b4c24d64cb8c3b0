"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are sets of word shingles, partitioned by size. An item's signature
are the shingles that are least under the hash functions of its size class:
``8 + log2(size)`` of them. A document that holds a share t of an item's
shingles misses all K signature shingles with probability (1 - t)^K, 3e-6 at
most for t = 0.8; an item with at most K shingles is found for certain.
Documents are long, so they have no signatures of their own: each looks its
shingles up in the items' signatures, and its size rules out items too large
for it. Candidates are verified by exact containment.

An item of fewer than five words is one shingle of its own width, and texts are
cut into shingles of the widths that such items have as well.

One pass over the texts keeps only shingles that may be an item's: a table of
the hash slots the items use is broadcast. There are eight slots for each
shingle of the items, ``MOST_SLOTS`` at most whatever their number. Only
DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventpipe.llm.common import Scratch, join_groups

SHINGLE_WORDS = 5
CONTAINMENT_PERCENT = 80
LEAST_SLOTS, MOST_SLOTS = 1 << 20, 1 << 22
LEAST_HASHES = 8


def words_of(text: Column) -> Column:
    """Runs of letters and digits, lower-cased: marks and blanks between words do not matter."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def with_shingles(frame: DataFrame, *keep: Column, widths: Sequence[int] = ()) -> DataFrame:
    """``keep`` and ``shingles``: distinct hashes of all runs of five words, and of as many as ``widths`` say.

    With fewer words it is the whole sequence, without words none. The words
    go through a one-row generator, as they would be cut anew for every shingle.
    """
    words = F.col("words")
    nothing = F.array().cast("array<bigint>")

    def runs(width: int) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(words) - width + 1), lambda i: F.xxhash64(F.slice(words, i, F.lit(width)))
        )

    shingles = (
        F.when(F.size(words) >= SHINGLE_WORDS, F.array_distinct(runs(SHINGLE_WORDS)))
        .when(F.size(words) > 0, F.array(F.xxhash64(words)))
        .otherwise(nothing)
    )
    for width in widths:
        shingles = F.array_union(shingles, F.when(F.size(words) >= width, runs(width)).otherwise(nothing))
    cut = frame.select(*keep, F.explode(F.array(words_of(F.col("text")))).alias("words"))
    return cut.select(*[c for c in cut.columns if c != "words"], F.explode(F.array(shingles)).alias("shingles"))


def item_classes(items: DataFrame) -> DataFrame:
    """(item, item_id, n_items, size, shingles, signature): items with equal sets as one, under the smallest id.

    ``item`` is a hash of the set and never null, ``class`` the size class;
    items without words are left out.
    """
    sets = with_shingles(items, F.col("item_id")).where(F.size("shingles") > 0)
    sets = sets.groupBy(F.array_sort("shingles").alias("shingles")).agg(
        F.min("item_id").alias("item_id"), F.count("*").alias("n_items")
    )
    sized = sets.withColumn("item", F.xxhash64("shingles")).withColumn("size", F.size("shingles")).withColumn("class", F.floor(F.log2("size")).cast("int"))
    least = F.transform(
        F.sequence(F.lit(1), F.col("class") + LEAST_HASHES),
        lambda k: F.array_min(
            F.transform("shingles", lambda h: F.struct(F.xxhash64(k, h).alias("order"), h.alias("h")))
        )["h"],
    )
    whole = F.col("size") <= F.col("class") + LEAST_HASHES
    return sized.withColumn("signature", F.when(whole, F.col("shingles")).otherwise(F.array_distinct(least)))


def slot(h: Column, slots: int) -> Column:
    return F.pmod(h, F.lit(slots)).cast("int")


def short_widths(items: DataFrame) -> list[int]:
    """The numbers of words, below five, that items have: four at most."""
    sizes = items.select(F.size(words_of(F.col("text"))).alias("n")).where(f"n > 0 AND n < {SHINGLE_WORDS}").distinct()
    return sorted(r["n"] for r in sizes.collect())


def contaminated(docs: DataFrame, items: DataFrame, percent: int = CONTAINMENT_PERCENT) -> DataFrame:
    """(doc_id, item_id, n_items, n_item_shingles, n_shared, containment): every leak once.

    ``docs`` has (doc_id, text, more), ``items`` (item_id, text, more). A leak
    is a document that holds at least ``percent`` of an item's distinct
    shingles of five words. Items with equal shingle sets are one, under their
    smallest id, ``n_items`` of them. An item of fewer words leaks into a
    document that holds them in a row. Null and empty texts have no words and
    never leak. Rows that share a doc_id are looked at each, and a leak of
    several counts once, by the largest share; a null doc_id is reported as
    null, and so is an item without id. Either table may be empty: then nothing leaks. Other columns are
    ignored.
    """
    leaks = leaking_rows(docs, items, percent)
    return (
        leaks.groupBy("doc_id", "item_id", "n_items", "n_item_shingles")
        .agg(F.max("n_shared").alias("n_shared"))
        .withColumn("containment", F.col("n_shared") / F.col("n_item_shingles"))
    )


def leaking_rows(
    docs: DataFrame, items: DataFrame, percent: int = CONTAINMENT_PERCENT, scratch: Scratch | None = None
) -> DataFrame:
    """(doc_id, text_hash, item_id, n_items, n_item_shingles, n_shared): the leaks of each text of a doc_id.

    ``text_hash`` is ``xxhash64`` of the text; it tells rows apart that share a
    doc_id, or have none.
    """
    scratch = scratch or Scratch(docs.sparkSession, "decontaminate")
    classes = scratch.settle(item_classes(items), "items")
    held = classes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    n_slots = min(MOST_SLOTS, max(LEAST_SLOTS, 1 << (8 * held).bit_length()))
    slots = classes.select(F.explode("shingles").alias("h")).select(slot(F.col("h"), n_slots).alias("slot")).distinct()
    seen = with_shingles(docs, F.col("doc_id"), F.xxhash64("text").alias("text_hash"), widths=short_widths(items))
    seen = seen.select("doc_id", "text_hash", F.size("shingles").alias("n"), F.explode("shingles").alias("h"))
    # At most MOST_SLOTS rows of one int.
    hits = scratch.settle(
        seen.join(F.broadcast(slots), slot(F.col("h"), n_slots) == F.col("slot"), "left_semi"), "hits"
    )
    signatures = classes.select("item", "size", F.explode("signature").alias("h"))
    holders = hits.groupBy("h").agg(F.count("*").alias("holders"))
    signed = scratch.settle(signatures.join(holders, "h"), "signatures")
    fits = F.col("n") * 100 >= F.col("size") * percent
    candidates = scratch.settle(
        join_groups(hits, signed, ["h"], "holders", ["doc_id", "text_hash"])
        .where(fits)
        .select("doc_id", "text_hash", "n", "item")
        .distinct(),
        "candidates",
    )
    # A document's hits meet in one row: it is at most as long as the document.
    held = hits.groupBy("doc_id", "text_hash", "n").agg(F.collect_set("h").alias("held"))
    same = candidates["doc_id"].eqNullSafe(held["doc_id"]) & (candidates["text_hash"] == held["text_hash"])
    paired = candidates.select("doc_id", "text_hash", "item").join(held.drop("n"), same).select(
        candidates["doc_id"], candidates["text_hash"], "item", "held"
    )
    asked = candidates.groupBy("item").agg(F.count("*").alias("asked"))
    asked = scratch.settle(asked.join(classes.select("item", "item_id", "n_items", "size", "shingles"), "item"), "asked")
    shared = F.size(F.array_intersect("shingles", "held"))
    counted = join_groups(paired, asked, ["item"], "asked", ["doc_id", "text_hash"]).select(
        "doc_id", "text_hash", "item_id", "n_items", F.col("size").alias("n_item_shingles"), shared.alias("n_shared")
    )
    return counted.where(F.col("n_shared") * 100 >= F.col("n_item_shingles") * percent)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` against all of ``benchmark``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE = r"""
WITH texts AS (
  SELECT false AS is_item, row_number() OVER () AS r, doc_id AS id, text FROM documents
  UNION ALL SELECT true, row_number() OVER (), item_id, text FROM benchmark
),
words AS (
  SELECT is_item, r, id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w
  FROM texts
),
widths AS (SELECT DISTINCT len(w) AS k FROM words WHERE is_item AND len(w) BETWEEN 1 AND 4 UNION SELECT 5),
shingles AS (
  SELECT DISTINCT is_item, r, id, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) AS s
  FROM words, widths WHERE len(w) >= k AND (NOT is_item OR k = least(len(w), 5))
),
sets AS (SELECT r, any_value(id) AS id, list(s ORDER BY s) AS own FROM shingles WHERE is_item GROUP BY r),
items AS (SELECT min(id) AS item_id, count(*) AS n_items, own FROM sets GROUP BY own),
wanted AS (SELECT item_id, n_items, len(own) AS size, unnest(own) AS s FROM items),
shared AS (
  SELECT d.r, d.id AS doc_id, item_id, n_items, size, count(*) AS n_shared
  FROM shingles d JOIN wanted USING (s) WHERE NOT d.is_item GROUP BY ALL
)
SELECT doc_id, item_id, n_items, size::INT AS n_item_shingles, max(n_shared)::INT AS n_shared,
  max(n_shared)::DOUBLE / size AS containment
FROM shared WHERE n_shared * 100 >= size * 80
GROUP BY doc_id, item_id, n_items, size
"""

"""Phrase collocations by partitioning after Savasere, Omiecinski and Navathe (SON).

Texts are cut at punctuation and line ends into pieces, pieces at blanks into
words. A phrase is two or more words that follow each other in a piece; it is a
candidate if its language holds it often enough.

**Mining.** The input is cut into ``shards``, each the work of many tasks. A
phrase that is rarer than ``support / shards`` in each shard is rarer than
``support`` altogether, so only phrases that reach this lowered support in some
shard can be candidates, and of these only such whose most possible total does:
a shard that does not report a phrase holds it ``local - 1`` times at most.
Shards are mined completely, level by level: first words, then pairs of words
that may be frequent, then longer phrases whose two shorter ones may be. Mining
goes by 64-bit keys; two phrases that share one make a candidate too many, never
one too few.

**Counting.** Candidates are counted anew over all texts, word by word as they
stand, and the support is applied to these counts.

What a level has found is known to the next pass as a bitmap of fixed size. The
more candidates there are, the more places of it are set and the less it spares;
results rest on the counts alone. Tasks sum what they hold before they send it,
so a phrase that fills the corpus sends one row for each task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from eventpipe.llm.common import Scratch, join_groups

SUPPORT, LONGEST, LEADING = 10, 3, 2000
# The more shards, the lower the local support and the less it spares: with as many shards as support it would be one.
SHARDS = 2
# A longer candidate with so many hundredths of a phrase's places takes its place.
SWALLOWED = 50
NO_LANGUAGE = "und"
# Bits of the bitmap's size: 8 MB, whatever the input.
FILTER_BITS = 26
# Bytes of text a task works on at once, bytes it holds back for all languages, keys it sums before it sends them.
SLICE_BYTES = 4 << 20
HELD_BYTES = 16 << 20
HELD_KEYS = 1_000_000

WORD, BLANK, BREAK = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = BLANK
_KIND[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = BREAK
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

Words = tuple[np.ndarray, pa.Array, np.ndarray]


def words_of(text: bytes) -> Words:
    """(code of each word, words by code, piece of each word) of a text in UTF-8."""
    raw = np.frombuffer(text, np.uint8)
    kind = _KIND[raw]
    inside = kind == WORD
    edges = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    letters = _LOWER[raw[inside]]
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    coded = words.dictionary_encode()
    pieces = np.cumsum(kind == BREAK, dtype=np.int32)[starts] if len(starts) else np.zeros(0, np.int32)
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary, pieces


def _mix(keys: np.ndarray) -> np.ndarray:
    keys = (keys ^ (keys >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return keys ^ (keys >> np.uint64(29))


def phrase_keys(found: Words, lang: str, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word's place, 64-bit key) of every phrase of ``size`` words."""
    codes, words, pieces = found
    seed = pd.util.hash_array(np.array([lang], dtype=object), categorize=False)[0]
    hashes = pd.util.hash_array(np.array(words.to_pylist(), dtype=object), categorize=False) if len(words) else np.zeros(0, np.uint64)
    places = np.flatnonzero(pieces[: len(codes) - size + 1] == pieces[size - 1 :]) if len(codes) >= size else np.zeros(0, np.int64)
    keys = np.full(len(places), seed, np.uint64)
    for k in range(size):
        keys = _mix(keys + hashes[codes[places + k]])
    return places, keys


def _marked(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slots = keys >> np.uint64(64 - 6 - (len(bitmap) - 1).bit_length())
    return (bitmap[slots >> np.uint64(6)] >> (slots & np.uint64(63))) & np.uint64(1) == 1


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """(language, texts) of about ``SLICE_BYTES``. A long text is cut, too, but only between two pieces."""
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}

    def let_go(lang: str) -> tuple[str, bytes]:
        sizes.pop(lang)
        return lang, b"\n".join(held.pop(lang))

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = text.as_py().encode()
            while text:
                end = len(text)
                if end > SLICE_BYTES:
                    ends = [at for c in _BREAKS if (at := text.find(bytes([c]), SLICE_BYTES)) >= 0]
                    end = min(ends, default=end - 1) + 1
                part, text = text[:end], text[end:]
                held.setdefault(lang, []).append(part)
                sizes[lang] = sizes.get(lang, 0) + len(part)
                if sizes[lang] >= SLICE_BYTES:
                    yield let_go(lang)
                elif sum(sizes.values()) >= HELD_BYTES:
                    yield let_go(max(sizes, key=sizes.get))
    for lang in list(held):
        yield let_go(lang)


def _sum(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def _miner(size: int, shards: int, below) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts of keys in the shard of a task; ``below``: bitmap of what is one word shorter, or None."""

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() % shards
        shorter = None if below is None else np.frombuffer(below.value, np.uint64)
        kept: list[tuple[np.ndarray, np.ndarray]] = []

        def send() -> Iterator[pa.RecordBatch]:
            keys, counts = _sum(*map(np.concatenate, zip(*kept, strict=True)))
            kept[:] = [(keys, counts)]
            if len(keys) >= HELD_KEYS:
                yield from out()

        def out() -> Iterator[pa.RecordBatch]:
            keys, counts = kept.pop()
            for i in range(0, len(keys), 1 << 16):
                part = slice(i, i + (1 << 16))
                columns = [pa.array(keys[part].view(np.int64)), pa.array(np.full(len(keys[part]), shard, np.int32)), pa.array(counts[part])]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "shard", "n"])

        for lang, text in _slices(batches):
            found = words_of(text)
            places, keys = phrase_keys(found, lang, size)
            if shorter is not None:
                starts, parts = phrase_keys(found, lang, size - 1)
                fits = np.zeros(len(found[0]) + 1, bool)
                fits[starts] = _marked(shorter, parts)
                keys = keys[fits[places] & fits[places + 1]]
            kept.append(_sum(keys, np.ones(len(keys), np.int64)))
            yield from send()
        if kept:
            yield from out()

    return mine


def _counter(longest: int, bitmaps: dict) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(lang, words, phrase, n) of the phrases whose keys are marked; with no words, the number of all words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = {size: np.frombuffer(shared.value, np.uint64) for size, shared in bitmaps.items()}
        for lang, text in _slices(batches):
            codes, words, _ = found = words_of(text)
            for size in range(longest + 1):
                if size == 0:
                    phrases, counts = pa.array([b""]), np.array([len(codes)])
                else:
                    places, keys = phrase_keys(found, lang, size)
                    places = places[_marked(marks[size], keys)]
                    numbers = codes[places]
                    for k in range(1, size):  # the words' codes, packed without loss as numbers of what is there
                        numbers = np.unique(numbers, return_inverse=True)[1] * len(words) + codes[places + k]
                    _, first, counts = np.unique(numbers, return_index=True, return_counts=True)
                    at = places[first]
                    phrases = pc.binary_join_element_wise(*[words.take(pa.array(codes[at + k])) for k in range(size)], b" ") if len(at) else words.slice(0, 0)
                for i in range(0, len(phrases), 1 << 16):
                    part = phrases.slice(i, 1 << 16).cast(pa.string())
                    n = len(part)
                    columns = [pa.array([lang] * n, pa.string()), pa.array(np.full(n, size, np.int32)), part, pa.array(counts[i : i + n].astype(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "words", "phrase", "n"])

    return count


def _bitmap(spark: SparkSession, keys: DataFrame):
    """Broadcast bitmap of the leading ``FILTER_BITS`` bits of the keys: 8 MB at most on its way, whatever their number."""
    slot = F.shiftrightunsigned("key", 64 - FILTER_BITS)
    words = keys.groupBy(F.shiftright(slot, 6).alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key, {64 - FILTER_BITS}) & 63 as int))")).alias("bits"))
    bitmap = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    got = words.toArrow()
    bitmap[got.column("at").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(bitmap.tobytes())


def mined_keys(texts: DataFrame, size: int, support: int, shards: int, below) -> DataFrame:
    """``key`` of every phrase of ``size`` words that its counts in the shards let be frequent."""
    local = -(-support // shards)
    found = texts.mapInArrow(_miner(size, shards, below), "key long, shard int, n long")
    # One shuffle: what is dealt by key is dealt well for (key, shard), too.
    by_shard = found.repartition("key").groupBy("key", "shard").agg(F.sum("n").alias("n"))
    most = F.sum(F.when(F.col("n") >= local, F.col("n") - (local - 1)).otherwise(0)) + (local - 1) * shards
    locally = F.max("n") >= local
    return by_shard.groupBy("key").agg(most.alias("most"), locally.alias("locally")).where((F.col("most") >= support) & F.col("locally")).select("key")


def phrase_counts(docs: DataFrame, scratch: Scratch, support: int = SUPPORT, longest: int = LONGEST, shards: int = SHARDS) -> DataFrame:
    """(lang, words, phrase, f) of every phrase of 1 to ``longest`` words that occurs ``support`` times.

    A row of no words for each language says how many words it has.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    bitmaps: dict[int, object] = {}
    for size in range(1, longest + 1):
        keys = mined_keys(texts, size, support, shards, bitmaps.get(size - 1))
        bitmaps[size] = _bitmap(spark, keys)
    counted = texts.mapInArrow(_counter(longest, bitmaps), "lang string, words int, phrase string, n long")
    exact = counted.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("f"))
    return scratch.settle(exact.where((F.col("words") == 0) | (F.col("f") >= support)), "counts")


def collocations(
    docs: DataFrame, scratch: Scratch, support: int = SUPPORT, longest: int = LONGEST, leading: int = LEADING, shards: int = SHARDS
) -> DataFrame:
    """Each language's ``leading`` phrases of ``docs`` (text, lang, more): lang, rank, phrase, a, l, r, n, score.

    ``a`` is how often the phrase occurs, ``l`` and ``r`` how often the two parts
    do into which its lowest-scoring cut parts it, ``n`` the number of words of
    the language. The score is a * a / (l * r) in millionths, rounded down. A
    phrase inside a longer candidate that has half of its places is dropped.
    Ties go to the commoner phrase, then to the lesser one by bytes.

    A null text is empty, a null language ``und``. Repeated rows count as often
    as they are there. Doc ids are not used; other columns are ignored. A text
    may have any length: it is cut between pieces while it is read. An empty
    table, or one without frequent phrases, gives an empty table.
    """
    counts = phrase_counts(docs, scratch, support, longest, shards)
    totals = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    frequent = counts.where("words > 0")
    candidates = frequent.where("words > 1").select("lang", "words", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("each"))
    text_of = lambda begin, length: F.array_join(F.slice("each", begin, length), " ")
    cuts = candidates.select("lang", "phrase", "a", "each", "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut")).select(
        "lang", "phrase", "a", "cut",
        text_of(F.lit(1), F.col("cut")).alias("head"),
        text_of(F.col("cut") + 1, F.col("words") - F.col("cut")).alias("tail"),
    )
    # A common word begins many phrases: such words are dealt over several tasks by their own number of places.
    for name, part in (("l", "head"), ("r", "tail")):
        sizes = frequent.select("lang", F.col("phrase").alias(part), F.col("f").alias(name))
        cuts = join_groups(cuts, sizes, ["lang", part], name, ["phrase"])
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    squared = F.lit(1_000_000).cast("decimal(7,0)") * wide("a") * wide("a")
    scored = cuts.withColumn("above", squared).withColumn("under", wide("l") * wide("r")).withColumn("score", F.expr("above div under"))
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("low"))
    inner = F.explode(
        F.flatten(
            F.transform(
                F.sequence(F.lit(2), F.col("words") - 1),
                lambda size: F.transform(F.sequence(F.lit(1), F.col("words") - size + 1), lambda at: F.array_join(F.slice("each", at, size), " ")),
            )
        )
    )
    longer = candidates.where("words > 2").select("lang", inner.alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = lowest.join(longer, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < SWALLOWED * F.col("a"), F.lit(True)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = left.select("lang", "phrase", "a", "low.l", "low.r", "low.score").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= leading)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leading phrases of each language of ``documents``."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "collocations"))


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
cut AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces),
f AS (
  SELECT lang, size, phrase, count(*) AS f FROM (
    SELECT lang, size, unnest(list_transform(range(1, len(words) + 2 - size), lambda i: array_to_string(words[i : i + size - 1], ' '))) AS phrase
    FROM cut, (VALUES (1), (2), (3)) sizes(size) WHERE len(words) >= size
  ) GROUP BY ALL
),
candidates AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS words FROM f WHERE size > 1 AND f >= 10),
cuts AS (
  SELECT c.lang, c.phrase, c.size, c.a, k, l.f AS l, r.f AS r, ((1000000::HUGEINT * c.a * c.a) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM candidates c, (VALUES (1), (2)) ks(k)
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.words[1:k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.words[k + 1 : c.size], ' ')
  WHERE k < c.size
),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (
  SELECT * FROM lowest s WHERE NOT EXISTS (
    SELECT 1 FROM candidates t WHERE t.lang = s.lang AND t.size = 3 AND s.size = 2 AND 100 * t.a >= 50 * s.a
      AND (array_to_string(t.words[1:2], ' ') = s.phrase OR array_to_string(t.words[2:3], ' ') = s.phrase)
  )
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, (SELECT sum(f)::BIGINT FROM f WHERE f.lang = ranked.lang AND size = 1) AS n, score
FROM ranked WHERE rank <= 2000
"""

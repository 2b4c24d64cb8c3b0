"""Token counts by a two-tier lookup on the map side.

Tier one is a compact hash table of the most frequent pre-tokens and their
lengths in tokens, broadcast to all tasks. It comes from a sample of about
``SAMPLE_DOCS`` documents by hash of their ids: each task counts within bounded
memory and hands on its most frequent pre-tokens, ``SAMPLE_WORDS`` over all
tasks. Tier two is a cache in each Python worker; what it
misses is encoded by the tokenizer's own library. Pre-tokens themselves are
never shuffled, and the table decides only the speed, never a count.

Counts are those of the library: added special tokens inside a text count as
one token each, as is its default, and a text with a character that the
library's splitter classes otherwise than this module's is encoded as a whole.
A tokenizer of another kind (SentencePiece, or any other pre-tokenizer) is
called on whole texts.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from eventpipe.llm.byte_bpe import slices, space_chunks
from eventpipe.llm.common import bound_batches, trim_memory

LIMIT = 1024
TABLE_WORDS = 32_768
SAMPLE_DOCS = 4_000
# Words that all tasks of the sample hand on together; each may hand on ``LEAST_TASK_WORDS`` at least.
SAMPLE_WORDS, LEAST_TASK_WORDS = 262_144, 16
COUNTED_WORDS = 262_144
CACHE_WORDS = 400_000
CACHE_CHARS = 32_000_000
# Longer words stay out of tier one.
KEPT_CHARS = 64


def count_words(batches: Iterator[pa.RecordBatch], most: int = SAMPLE_WORDS) -> Iterator[pa.RecordBatch]:
    """The most frequent words after a space of one partition; lossy counting within ``COUNTED_WORDS``."""
    counts: Counter = Counter()
    for batch in batches:
        for _, texts in slices(batch.column(0)):
            for text in texts:
                counts.update(space_chunks(text)[1:])
            if len(counts) > COUNTED_WORDS:
                counts = Counter(dict(counts.most_common(COUNTED_WORDS // 2)))
    top = [(w, n) for w, n in counts.most_common(most) if len(w) <= KEPT_CHARS]
    yield pa.RecordBatch.from_arrays(
        [pa.array([w for w, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["word", "n"]
    )


def frequent_words(docs: DataFrame, words: int = TABLE_WORDS) -> list[str]:
    """At most ``words`` words that follow a space most often in a sample; ties to the smaller. Nothing is shuffled."""
    share = min(1.0, SAMPLE_DOCS / max(docs.count(), 1))
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000).select("text")
    most = max(LEAST_TASK_WORDS, SAMPLE_WORDS // max(sample.rdd.getNumPartitions(), 1))
    counted = sample.mapInArrow(lambda batches: count_words(batches, most), "word string, n bigint").toArrow()
    total: Counter = Counter()
    for word, n in zip(counted.column("word").to_pylist(), counted.column("n").to_pylist()):
        total[word] += n
    return [word for word, _ in sorted(total.items(), key=lambda item: (-item[1], item[0]))[:words]]


class LengthTable:
    """Tier one as it is broadcast: packed strings and one length each; tasks make a hash table of it."""

    def __init__(self, words: list[str], lengths: list[int]):
        self.words = pa.array(words, pa.string())
        self.lengths = pa.array(lengths, pa.uint16())

    def lookup(self) -> dict[str, int]:
        return dict(zip(self.words.to_pylist(), self.lengths.to_pylist()))


class ByteLevel:
    """Lengths by the tokenizers library, pre-token by pre-token."""

    def __init__(self, path: str):
        import regex

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path) as file:
            spec = json.load(file)
        self.special = [t["content"] for t in spec["added_tokens"]]
        kind = spec["pre_tokenizer"] or {}
        plain = not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"])
        self.splits = (
            kind.get("type") == "ByteLevel" and kind["use_regex"] and not kind["add_prefix_space"]
            and spec["normalizer"] is None and plain
        )
        self.find = regex.compile(public_tokenizers.PATTERN).findall
        self.cut = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.differing: dict[str, bool] = {}
        self.tier_one: dict[str, int] = {}
        self.chunks: dict[str, int] = {}  # word after a space -> tokens: tier one and cache
        self.words: dict[str, int] = {}  # pre-token -> tokens
        self.chars = self.word_chars = 0  # of all that either cache has taken in

    def pin(self, table: dict[str, int]) -> None:
        self.tier_one = table
        self.chunks = dict(table)

    def whole(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def odd(self, text: str) -> bool:
        """Whether a character of the text is classed in two ways."""
        return any(map(self._differs, set(re.findall("[^\x00-ӿ]", text))))

    def _differs(self, char: str) -> bool:
        if char not in self.differing:
            split = self.tokenizer.pre_tokenizer.pre_tokenize_str
            self.differing[char] = any(len(split(c + char)) != len(self.find(c + char)) for c in "a1.")
        return self.differing[char]

    def counts(self, texts: list[str]) -> list[int]:
        if not self.splits:
            return self.whole(texts)
        out = [0] * len(texts)
        whole = [i for i, text in enumerate(texts) if not text.isascii() and self.odd(text)]
        for i, n in zip(whole, self.whole([texts[i] for i in whole])):
            out[i] = n
        skip = set(whole)
        parts: list[tuple[int, list[str]]] = []
        for i, text in enumerate(texts):
            if i not in skip:
                pieces = self.cut.split(text) if self.cut else [text]
                out[i] += len(pieces) - 1
                parts.extend((i, space_chunks(piece)) for piece in pieces)
        self._learn([chunks for _, chunks in parts])
        of, words = self.chunks.__getitem__, self.words
        for i, chunks in parts:
            out[i] += sum([words[w] for w in self.find(chunks[0])]) + sum(map(of, chunks[1:]))
        return out

    def _learn(self, parts: list[list[str]]) -> None:
        if len(self.chunks) > CACHE_WORDS or self.chars > CACHE_CHARS:
            self.chunks, self.chars = dict(self.tier_one), 0
        if len(self.words) > CACHE_WORDS or self.word_chars > CACHE_CHARS:
            self.words, self.word_chars = {}, 0
        new = set().union(*(c[1:] for c in parts)).difference(self.chunks)
        found = {c: self.find(" " + c) for c in new}
        missing = list(set().union(*found.values(), *(self.find(c[0]) for c in parts)).difference(self.words))
        self.words.update(zip(missing, self.whole(missing)))
        words = self.words
        self.word_chars += sum(map(len, missing))
        self.chars += sum(map(len, found))
        for chunk, own in found.items():
            self.chunks[chunk] = sum([words[w] for w in own])


class Pieces:
    """Lengths by the sentencepiece library, text by text."""

    splits = False

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def counts(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.model.encode(texts, num_threads=1)]


_counters: dict[str, ByteLevel | Pieces] = {}


def counter(path: str) -> ByteLevel | Pieces:
    """The worker's counter; it outlives a partition."""
    if path not in _counters:
        _counters[path] = Pieces(path) if path.endswith(".model") else ByteLevel(path)
    return _counters[path]


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs`` (doc_id, text, more).

    A null or empty text has no bytes and no tokens. Repeated rows are counted
    each, a null doc_id stays null, other columns are ignored; an empty table
    gives an empty one. A text may have any length; texts come to a worker a few
    megabytes at a time, or one by one.
    """
    import public_tokenizers

    path = path or public_tokenizers.path("byte_bpe_50k.json")
    bound_batches(docs.sparkSession)
    table = None
    if not path.endswith(".model") and (own := ByteLevel(path)).splits:
        words = frequent_words(docs)
        own._learn([["", *words]])
        table = docs.sparkSession.sparkContext.broadcast(LengthTable(words, [own.chunks[w] for w in words]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        if table is not None and len(own.tier_one) != len(table.value.words):
            own.pin(table.value.lookup())
        for batch in batches:
            for start, texts in slices(batch.column(1)):
                n = pa.array(own.counts(texts), pa.int64())
                size = pc.fill_null(pc.binary_length(batch.column(1).slice(start, len(texts))), 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)), pc.cast(size, pa.int64()), n],
                    names=["doc_id", "n_bytes", "n_tokens"],
                )
        trim_memory()

    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``."""
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))

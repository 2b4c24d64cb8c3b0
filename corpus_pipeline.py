"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and
returns a frame; ``run`` writes it as Parquet in the shared folder and hands it
to the next one. All stages but the last return the columns of documents.
Whatever a stage decides is settled in a narrow table first; texts move at most
once per stage, to meet the decisions about them.

Doc ids may be null or repeat. A stage decides about a row by its id and content
together, so other rows of that id, or without one, are not touched by it. More
columns than those of documents are handed through, whatever their names. Null
and empty texts have no letters and go in the first stage. A text may have any
length. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventpipe.llm.byte_bpe import encode_decode
from eventpipe.llm.common import Scratch
from eventpipe.llm.decontaminate import leaking_rows
from eventpipe.llm.language_id import document_evidence, identify
from eventpipe.llm.line_dedup import dedup_lines
from eventpipe.llm.minhash import near_duplicates

# Near duplicates are told by shingles of five words here.
SHINGLE_WORDS = 5


def _row_key() -> Column:
    """Tells rows apart that share a doc_id but not the content."""
    return F.struct("doc_id", F.xxhash64("text", "lang", "source").alias("content"))


def _without(docs: DataFrame, rejected: DataFrame, on: Column, scratch: Scratch) -> DataFrame:
    """``docs`` but those that match ``rejected``; it is settled, so Spark knows its size and may broadcast it.

    What led to it is removed.
    """
    rejected = scratch.settle(rejected, "rejected")
    scratch.keep("rejected")
    return docs.join(rejected.alias("rejected"), on, "left_anti")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without letters and those of no language with a probability of a half."""
    scratch = Scratch(spark, "pipeline-language")
    found = identify(document_evidence(docs, _row_key()), scratch)
    rejected = found.where(~F.col("kept")).select("key.doc_id", "key.content").distinct()
    on = docs["doc_id"].eqNullSafe(F.col("rejected.doc_id")) & (
        F.xxhash64(docs["text"], docs["lang"], docs["source"]) == F.col("rejected.content")
    )
    return _without(docs, rejected, on, scratch)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated lines out of the texts; ``n_chars`` follows. A document that loses all its lines goes."""
    # Under names that the operator does not give.
    others = {c: f"given_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    cleaned = dedup_lines(docs.select("doc_id", "text", *[F.col(c).alias(name) for c, name in others.items()]))
    emptied = (F.col("n_dropped") > 0) & (F.trim("kept") == "")

    def column(c: str) -> Column:
        if c == "n_chars":
            return F.char_length("kept").cast(docs.schema[c].dataType)
        return F.col("kept") if c == "text" else F.col(others.get(c, c))

    return cleaned.where(~emptied).select(*[column(c).alias(c) for c in docs.columns])


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates: the one with the smallest doc_id, then content; null ids come last."""
    scratch = Scratch(spark, "pipeline-near")
    content = F.xxhash64("text", "lang", "source")
    node = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", content.alias("content"))
    nodes = scratch.settle(near_duplicates(docs.select(node.alias("doc_id"), "text"), size=SHINGLE_WORDS, scratch=scratch), "nodes")
    gone = nodes.where(~F.col("kept")).select("doc_id.doc_id", "doc_id.content").distinct()
    # Rows that are the same in id and content are one node: of these one stays.
    same = nodes.where("kept").groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id.doc_id", "doc_id.content")
    gone, same = scratch.settle(gone, "gone"), scratch.settle(same, "same")
    scratch.keep("gone", "same")

    def met(name: str) -> Column:
        return docs["doc_id"].eqNullSafe(F.col(f"{name}.doc_id")) & (content == F.col(f"{name}.content"))

    alone = docs.join(gone.union(same).alias("other"), met("other"), "left_anti")
    if same.isEmpty():
        return alone
    repeated = docs.join(same.alias("same"), met("same"), "left_semi")
    first = F.first(F.struct(*docs.columns)).alias("row")
    return alone.unionByName(repeated.groupBy("doc_id", content).agg(first).select("row.*"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the rows whose text holds a benchmark item; others of the same doc_id, or without one too, stay."""
    scratch = Scratch(spark, "pipeline-leaks")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaked = leaking_rows(docs, items, scratch=scratch).select("doc_id", "text_hash").distinct()
    on = docs["doc_id"].eqNullSafe(F.col("rejected.doc_id")) & (F.xxhash64(docs["text"]) == F.col("rejected.text_hash"))
    return _without(docs, leaked, on, scratch)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every kept text, as little-endian 32-bit integers, with digests of them and of the decoded bytes."""
    coded = encode_decode(docs)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "ids",
    )


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("minhash_dedup", minhash_dedup),
    ("decontaminate", decontaminate),
    ("byte_bpe", byte_bpe),
]
# SQL can express neither the trained language model nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.settle(stage(spark, docs, sf_dir), name)
    return docs

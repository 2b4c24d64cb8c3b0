"""The pipeline on a small corpus with a known outcome."""

import random

import pytest

import corpus_pipeline
from eventpipe.llm.byte_bpe import coder, pack

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

KIND = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LICENCE = "This line of licence text stands in very many documents"


def text(r, n=60):
    return " ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = random.Random(8)
    top = str(tmp_path_factory.mktemp("corpus"))
    bodies = [text(r) for _ in range(12)]
    item = text(r, 30)
    docs = [(i, f"{body}\n{LICENCE}") for i, body in enumerate(bodies)]
    docs += [(20, bodies[3] + " more"), (21, bodies[3]), (22, f"{text(r, 200)} {item} {text(r, 200)}")]
    docs += [(23, "12 $$$ 34"), (24, None), (25, LICENCE), (None, text(r))]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in docs]
    spark.createDataFrame(rows, KIND).write.parquet(f"{top}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{top}/benchmark.parquet")
    return top, dict(docs), bodies


def test_rows_of_a_run(spark, folder):
    top, docs, bodies = folder
    expected = {i: body for i, body in enumerate(bodies)} | {25: LICENCE, None: docs[None]}
    library = tiktoken.Encoding(
        "own", pat_str=P.PATTERN, mergeable_ranks=coder(P.path("byte_bpe_50k.tiktoken"), P.PATTERN).ranks, special_tokens={}
    )
    got = {r.doc_id: bytes(r.ids) for r in corpus_pipeline.run(spark, top).collect()}
    assert got == {i: pack(library.encode_ordinary(t)) for i, t in expected.items()}


def test_every_stage_keeps_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder[0]).schema == docs.schema, name


def test_an_empty_corpus(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder[0]).count() == 0, name


def test_a_leak_takes_no_clean_row_of_its_id_along(spark, folder, tmp_path):
    r = random.Random(10)
    item, clean = text(r, 30), [text(r) for _ in range(3)]
    held = f"{text(r)} {item}"
    docs = [(None, clean[0]), (None, held), (7, clean[1]), (7, held), (7, held), (8, clean[2]), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs], KIND)
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.decontaminate(spark, docs, str(tmp_path)).collect()
    assert {(row.doc_id, row.text) for row in got} == {(None, clean[0]), (7, clean[1]), (8, clean[2]), (None, None)}


def test_near_copies_are_told_by_row(spark, folder):
    r = random.Random(11)
    one, two, three = (text(r) for _ in range(3))
    docs = [(None, one), (5, one + " x"), (5, two), (5, two), (6, two), (6, three), (None, three), (None, three), (None, None), (9, None), (9, "")]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs], KIND)
    got = sorted(((row.doc_id, row.text) for row in corpus_pipeline.minhash_dedup(spark, frame, folder[0]).collect()), key=str)
    # Texts without words are near nothing; those equal in id and content are one row.
    assert got == sorted([(5, one + " x"), (5, two), (6, three), (None, None), (9, None), (9, "")], key=str)


def test_clashing_columns_are_handed_through(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet")
    names = ("kept", "n_lines", "n_dropped", "key", "content", "rows", "row", "component_id", "language")
    from pyspark.sql import functions as F

    more = docs.select("*", *[F.concat(F.lit(n), F.lit("-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(n) for n in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, more, folder[0])
        assert out.columns == more.columns, name
        for row in out.collect():
            assert all(row[n] == f"{n}-{'none' if row.doc_id is None else row.doc_id}" for n in names), name


def test_a_very_long_text_passes(spark, folder):
    r = random.Random(12)
    long = "\n".join(text(r, 40) for _ in range(3000))
    docs = spark.createDataFrame([(1, long, "en", "s", len(long)), (2, text(r), "en", "s", 0)], KIND)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder[0])
    rows = {row.doc_id: row.n_tokens for row in docs.collect()}
    assert rows.keys() == {1, 2} and rows[1] > 100_000

import random

import pytest

tiktoken = pytest.importorskip("tiktoken")
P = pytest.importorskip("public_tokenizers")

from tokenizers import Tokenizer  # noqa: E402

from eventpipe.llm import byte_bpe, token_counts  # noqa: E402
from eventpipe.llm.byte_bpe import Coder, encode_decode, pack  # noqa: E402
from eventpipe.llm.token_counts import ByteLevel, count_tokens, count_words  # noqa: E402

KIND = "doc_id bigint, text string"


def texts(n):
    letters = list(" \n\t\x0b\x1c\x85    aB1é.'s漢字𝔘😀࢏՘") + ["<|endoftext|>", "'ll", "  ", " the"]
    r = random.Random(3)
    fixed = ["", " ", "  ", "   a", "a   ", "it's  we're", "a" * 3000, "ab" * 500, "漢字" * 300, "!" * 500, "<|endoftext|>"]
    return fixed + ["".join(r.choice(letters) for _ in range(r.randint(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def own():
    return Coder(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


@pytest.fixture(scope="module")
def library(own):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=own.ranks, special_tokens={})


def test_ids_are_those_of_the_library_and_decode_to_the_text(own, library):
    given = texts(4000)
    ids = own.encode(given)
    assert ids == [pack(library.encode_ordinary(t)) for t in given]
    assert own.decode(ids) == [t.encode() for t in given]


def test_long_words_go_through_the_query(own, library, monkeypatch):
    r = random.Random(9)
    words = ["abababab" * 9, "a" * 1001, "xyz" * 700, "é漢" * 400, "".join(r.choices("漢字日本語文中国人", k=900)), "".join(r.choices("abcdefgh", k=5000))]
    expected = [pack(library._encode_single_piece(w)) for w in (w.encode() for w in words)]
    for held in (byte_bpe.HELD_ROWS, 20_000, 1):
        monkeypatch.setattr(byte_bpe, "HELD_ROWS", held)
        for size in (100_000, 3_000):
            monkeypatch.setattr(byte_bpe, "QUERY_BYTES", size)
            some = words if held > 1 else words[:2]
            own.words.clear()
            own._learn(set(some))
            assert [own.words[w] for w in some] == expected[: len(some)]


def test_rows_out_of_order_are_noticed(own, library):
    words = [w.encode() for w in ("outoforder", "xyzzyplugh", "漢字", "internationalisation")]
    table = own._positions(words)
    mixed = table.take(list(random.Random(2).sample(range(table.num_rows), table.num_rows)))
    with pytest.raises(Exception, match="rows out of order"):
        own._query(byte_bpe.MERGE, mixed)
    assert own._merged(mixed, len(words)) == [pack(library._encode_single_piece(w)) for w in words]


def test_texts_without_spaces_are_those_of_the_library(own, library):
    r = random.Random(4)
    texts = ["，".join("".join(r.choices("的一是不了人我在有他这为之大来以个中上们", k=r.randint(1, 80))) for _ in range(60)) for _ in range(20)]
    assert own.encode(texts) == [pack(library.encode_ordinary(t)) for t in texts]


def test_a_very_long_text_and_a_very_long_word(own, library):
    for text in ("word and 字 " * 60_000, "".join(random.Random(1).choices("etaoinshrdlu", k=60_000))):
        [ids] = own.encode([text])
        assert ids == pack(library.encode_ordinary(text)) and own.decode([ids]) == [text.encode()]


def test_forgetting_words_changes_nothing(own, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_WORDS", 10)
    monkeypatch.setattr(byte_bpe, "CACHE_CHUNKS", 10)
    for part in (texts(200), texts(300)):
        assert own.encode(part) == [pack(library.encode_ordinary(t)) for t in part]


def test_any_ids_decode(own):
    r = random.Random(5)
    ids = [[r.randrange(50256) for _ in range(r.randint(0, 500))] for _ in range(50)]
    pieces = {rank: token for token, rank in own.ranks.items()}
    assert own.decode([pack(i) for i in ids]) == [b"".join(pieces[x] for x in i) for i in ids]


def test_rows_with_nulls_and_repeats_keep_their_number(spark, library):
    rows = [(1, "a b"), (1, "a b"), (None, "x"), (2, None), (3, "")]
    got = encode_decode(spark.createDataFrame(rows, KIND)).collect()
    expected = [(i, pack(library.encode_ordinary(t or "")), (t or "").encode()) for i, t in rows]
    assert sorted(map(str, [(r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in got])) == sorted(map(str, expected))
    assert encode_decode(spark.createDataFrame([], KIND)).collect() == []
    clash = encode_decode(spark.createDataFrame([(1, "a", "i")], KIND + ", ids string"))
    assert clash.columns == ["doc_id", "ids", "decoded"] and clash.count() == 1


def test_counts_are_those_of_the_library():
    given = texts(4000)
    counter = ByteLevel(P.path("byte_bpe_50k.json"))
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    assert counter.splits
    assert counter.counts(given) == [len(e.ids) for e in library.encode_batch(given, add_special_tokens=False)]


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_count_rows_for_every_kind_of_file(spark, file):
    rows = [(1, "it's the\n end <|endoftext|>"), (1, "it's the\n end <|endoftext|>"), (None, "x"), (2, None), (3, ""), (4, "word " * 2000)]
    got = count_tokens(spark.createDataFrame(rows, KIND), P.path(file)).collect()
    if file.endswith(".model"):
        import sentencepiece

        count = lambda t: len(sentencepiece.SentencePieceProcessor(model_file=P.path(file)).encode(t))
    else:
        count = lambda t: len(Tokenizer.from_file(P.path(file)).encode(t, add_special_tokens=False).ids)
    expected = [(i, len((t or "").encode()), count(t or ""), count(t or "") > 1024) for i, t in rows]
    assert sorted(map(str, [tuple(r) for r in got])) == sorted(map(str, expected))


def test_counting_an_empty_table(spark):
    assert count_tokens(spark.createDataFrame([], KIND)).collect() == []


def test_words_are_counted_within_bounds():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["a b b c", None, "x b"])], names=["text"])
    out = next(count_words(iter([batch]))).to_pydict()
    assert dict(zip(out["word"], out["n"])) == {"b": 3, "c": 1}


def test_the_table_comes_from_a_sample_without_a_shuffle(spark, monkeypatch):
    docs = spark.range(500).selectExpr("id AS doc_id", "concat('a common word and ', id) AS text").repartition(7)
    words = token_counts.frequent_words(docs, 4)
    assert sorted(words) == ["and", "common", "word"] + [w for w in words if w.isdigit()]
    monkeypatch.setattr(token_counts, "SAMPLE_DOCS", 100)
    assert set(token_counts.frequent_words(docs, 3)) == {"and", "common", "word"}
    assert token_counts.frequent_words(docs.limit(0)) == []
    plan = count_tokens(docs, P.path("byte_bpe_50k.json"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1  # that of this test's repartition


def test_counts_of_a_very_long_text(spark):
    text = "it is a long text, 漢字 and all; " * 30_000
    [row] = count_tokens(spark.createDataFrame([(1, text)], KIND)).collect()
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    assert (row.n_bytes, row.n_tokens) == (len(text.encode()), len(library.encode(text, add_special_tokens=False).ids))


def test_a_worker_keeps_the_words_of_a_large_vocabulary(monkeypatch):
    own, learned = Coder(P.path("byte_bpe_50k.tiktoken"), P.PATTERN), []
    monkeypatch.setattr(own, "_merged", lambda words, count: learned.append(count) or [b"\0\0\0\0"] * count)
    texts = [" ".join("x" + "".join(chr(97 + n // 26**k % 26) for k in range(4)) + "qz" for n in range(start, start + 40_000)) for start in range(0, 280_000, 40_000)]
    for text in texts:
        own.encode([text])
    before = sum(learned)
    assert before > 200_000
    for text in texts:
        own.encode([text])
    assert sum(learned) == before


def test_words_met_again_outlive_a_full_cache(monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_WORDS", 100)
    own, learned = Coder(P.path("byte_bpe_50k.tiktoken"), P.PATTERN), []
    merged = own._merged
    monkeypatch.setattr(own, "_merged", lambda words, count: learned.append(count) or merged(words, count))
    word = lambda n: "xq" + "".join(chr(97 + n // 26**k % 26) for k in range(3)) + "zj"
    common = " ".join(word(n) for n in range(20))
    first = own.encode([common])
    for start in range(100, 1000, 90):
        own.chunks.clear()
        own.encode([common + " " + " ".join(word(n) for n in range(start, start + 90))])
    before = sum(learned)
    own.chunks.clear()
    assert own.encode([common]) == first
    assert sum(learned) == before and len(own.words) <= 100 + 20 + 90


def test_a_worker_holds_a_slice_and_no_database_between_partitions(spark, monkeypatch):
    import pyarrow as pa

    own = Coder(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    sizes, blocks = [], []
    encode, decoded = own.encode, own._decoded
    monkeypatch.setattr(own, "encode", lambda texts: sizes.append(sum(map(len, texts))) or encode(texts))
    monkeypatch.setattr(own, "_decoded", lambda packed: blocks.append(sum(map(len, packed)) // 4) or decoded(packed))
    monkeypatch.setattr(byte_bpe, "coder", lambda *given: own)
    monkeypatch.setattr(byte_bpe, "DECODE_IDS", 2000)
    texts = ["some words of a text " * 200] * 1000
    batch = pa.RecordBatch.from_arrays([pa.array(range(1000), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    out = [b.to_pydict() for b in byte_bpe.encoded(iter([batch]), "", "")]
    assert [t for b in out for t in b["decoded"]] == [t.encode() for t in texts]
    assert [i for b in out for i in b["doc_id"]] == list(range(1000))
    assert max(sizes) <= 1_000_000 and max(blocks) <= 2000
    assert own._db is None
    assert own.decode(own.encode(texts[:1])) == [texts[0].encode()]

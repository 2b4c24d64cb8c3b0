import random
import re
from collections import Counter

import pytest

from eventpipe.llm import collocations as col
from eventpipe.llm.common import Scratch

KIND = "doc_id bigint, text string, lang string"


def brute(rows, support, longest, leading):
    counts, totals = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i : i + size])] += 1
    found = {(lang, p): a for (lang, p), a in counts.items() if len(p) > 1 and a >= support}
    out = {}
    for (lang, p), a in found.items():
        inside = any(
            lang == other and len(q) > len(p) and 100 * b >= 50 * a and any(q[i : i + len(p)] == p for i in range(len(q)))
            for (other, q), b in found.items()
        )
        if not inside:
            cuts = [(1_000_000 * a * a // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
    return {
        (lang, i + 1, phrase.decode(), -a, l, r, totals[lang], -score)
        for lang, all in out.items()
        for i, (score, a, phrase, l, r) in enumerate(sorted(all)[:leading])
    }


def texts(rng, n):
    words = ["a", "b", "Ab", "é", "É", "ß", "ab", " ", "x-y", "日本", "'", "a\x00"]
    ends = [" ", " ", "  ", "\t", ". ", ",", "\n", "\r", "\x0b", "!?", ":"]
    return [(rng.choice([1, 2, None]), "".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randint(0, 60))), rng.choice(["en", "en", "de", None, "und"])) for _ in range(n)]


@pytest.mark.parametrize("support, longest, shards, parts", [(10, 3, 4, 9), (7, 4, 3, 2), (4, 2, 1, 3), (3, 3, 3, 40)])
def test_against_brute_force(spark, support, longest, shards, parts):
    rows = texts(random.Random(support), 60) + [(5, None, "en"), (6, "", None)] + [(7, "One long sentence; one long SENTENCE", "fr")] * 30
    frame = spark.createDataFrame(rows, KIND).repartition(parts)
    got = col.collocations(frame, Scratch(spark, "t"), support, longest, 25, shards)
    assert {tuple(r) for r in got.collect()} == brute(rows, support, longest, 25)


def test_phrases_rare_in_every_shard_are_mined(spark):
    """Ten places over ten partitions: a shard of two or three holds two or three of them."""
    rows = [(i, f"rare pair w{i} x{i}", "en") for i in range(10)] + [(i, f"lone y{i}", "en") for i in range(9)]
    frame = spark.createDataFrame(rows, KIND).repartitionByRange(10, "doc_id")
    got = col.collocations(frame, Scratch(spark, "t"))
    assert [(r.phrase, r.a, r.score) for r in got.collect()] == [("rare pair", 10, 1_000_000)]


def test_a_full_bitmap_changes_nothing(spark, monkeypatch):
    rows = texts(random.Random(1), 50)
    monkeypatch.setattr(col, "FILTER_BITS", 6)
    got = col.collocations(spark.createDataFrame(rows, KIND), Scratch(spark, "t"), 5, 3, 30)
    assert {tuple(r) for r in got.collect()} == brute(rows, 5, 3, 30)


def test_long_texts_are_cut_between_pieces(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(col, "SLICE_BYTES", 64)
    monkeypatch.setattr(col, "HELD_BYTES", 100)
    rows = texts(random.Random(2), 20) + [(1, "no break in this one " * 40, "en")]
    batch = pa.RecordBatch.from_arrays([pa.array([r[2] or "und" for r in rows]), pa.array([r[1] for r in rows])], names=["lang", "text"])
    pieces = lambda text: Counter(p for p in re.split(rb"[.,;:!?\n\x0b\x0c\r]", text) if p.strip(b" \t"))
    cut, whole = {}, {}
    for lang, text in col._slices(iter([batch])):
        cut.setdefault(lang, Counter()).update(pieces(text))
    for _, text, lang in rows:
        whole.setdefault(lang or "und", Counter()).update(pieces(text.encode()))
    assert {k: v for k, v in cut.items() if v} == {k: v for k, v in whole.items() if v}


def test_products_over_64_bits(spark):
    a, l, r = 3 * 10**9, 4 * 10**9 + 7, 5 * 10**9 + 9
    got = spark.sql(
        f"SELECT (CAST(1000000 AS DECIMAL(7,0)) * CAST({a} AS DECIMAL(19,0)) * CAST({a} AS DECIMAL(19,0))) div "
        f"(CAST({l} AS DECIMAL(19,0)) * CAST({r} AS DECIMAL(19,0))) AS s"
    ).first().s
    assert got == 1_000_000 * a * a // (l * r)


def test_empty_table_nothing_frequent_and_clashing_names(spark):
    assert col.collocations(spark.createDataFrame([], KIND), Scratch(spark, "t")).collect() == []
    assert col.collocations(spark.createDataFrame([(1, "a b", "en"), (2, None, None)], KIND), Scratch(spark, "t")).collect() == []
    rows = [(1, "to be", "en", 1, "x", 2.0)] * 10
    frame = spark.createDataFrame(rows, KIND + ", n int, phrase string, score double")
    assert [tuple(r) for r in col.collocations(frame, Scratch(spark, "t")).collect()] == [("en", 1, "to be", 10, 10, 10, 20, 1_000_000)]

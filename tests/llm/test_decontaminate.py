import re

from eventpipe.llm.decontaminate import contaminated

DOCS, ITEMS = "doc_id bigint, text string", "item_id bigint, text string"
PASSAGE = "the quick brown fox jumps over the lazy dog while seven wizards mix a strange potion at noon today"


def sets_of(text):
    """Of an item: runs of five words, or all of fewer."""
    words = re.findall(r"[^\W_]+", (text or "").lower())
    width = min(len(words), 5)
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()


def runs_of(text):
    """Of a document: runs of one to five words."""
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(words[i : i + width]) for width in range(1, 6) for i in range(len(words) - width + 1)}


def brute_force(docs, items):
    classes = {}
    for i, t in items:
        if s := frozenset(sets_of(t)):
            classes.setdefault(s, []).append(i)
    best = {}
    for s, ids in classes.items():
        item = min((i for i in ids if i is not None), default=None)
        for d, t in docs:
            n = len(s & runs_of(t))
            if n * 100 >= len(s) * 80:
                key = (d, item, len(ids), len(s))
                best[key] = max(n, best.get(key, 0))
    return sorted([(*k, n) for k, n in best.items()], key=str)


def run(spark, docs, items):
    got = contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).drop("containment")
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_leaks_near_the_threshold_in_long_documents(spark):
    filler = " ".join(f"word{i}" for i in range(5000))
    words = PASSAGE.split()
    docs = [(n, f"{filler} {' '.join(words[: len(words) - n])} {filler}") for n in range(8)]
    docs += [(20, PASSAGE.upper().replace(" ", " *** ")), (21, filler), (None, PASSAGE), (20, "other"), (20, PASSAGE)]
    items = [(1, PASSAGE), (2, PASSAGE + "."), (3, " ".join(f"q{i}" for i in range(300))), (4, "word1 word2 word3 word4 word5 word6")]
    assert run(spark, docs, items) == brute_force(docs, items)


def test_nulls_short_items_and_empty_tables(spark):
    docs = [(1, None), (2, ""), (3, "two words"), (4, "two words more"), (5, PASSAGE), (5, PASSAGE)]
    items = [(1, None), (2, ""), (3, "Two, words"), (None, PASSAGE), (9, "***")]
    assert run(spark, docs, items) == brute_force(docs, items)
    assert run(spark, [], items) == [] and run(spark, docs, []) == []


def test_a_passage_in_most_documents(spark):
    docs = [(i, f"d{i} {PASSAGE} e{i}") for i in range(400)] + [(1000 + i, f"n{i} " * 50) for i in range(50)]
    items = [(i, f"{PASSAGE} i{i} j{i} k{i}") for i in range(20)] + [(100, PASSAGE)]
    assert run(spark, docs, items) == brute_force(docs, items)


def test_clashing_extra_columns(spark):
    docs = spark.createDataFrame([(1, PASSAGE, 3, "x")], DOCS + ", item_id int, h string")
    items = spark.createDataFrame([(7, PASSAGE, 1)], ITEMS + ", size int")
    assert [(r.doc_id, r.item_id) for r in contaminated(docs, items).collect()] == [(1, 7)]


def test_short_items_in_long_documents(spark):
    filler = " ".join(f"word{i}" for i in range(3000))
    items = [(1, "forty two"), (2, "Answer!"), (3, "one two three four"), (4, "a b c"), (5, PASSAGE), (6, "forty-two"), (7, "absent words")]
    docs = [(10, f"{filler} forty two {filler}"), (11, f"{filler} the ANSWER"), (12, "one two three four five"), (13, "b c a b"), (14, "a b c"),
            (15, f"two forty {filler}"), (16, f"{PASSAGE} answer"), (17, "answer"), (18, ""), (19, None), (20, "forty"), (None, "forty two")]
    assert run(spark, docs, items) == brute_force(docs, items)
    assert len(run(spark, docs, items)) == 8

import random
import re

import numpy as np
import pytest

from eventpipe.llm import common, minhash
from eventpipe.llm.common import Scratch, connected_components
from eventpipe.llm.minhash import buckets, near_duplicates, shingle_set, word_hashes

KIND = "doc_id bigint, text string"


def sets_of(text, size):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w]
    if not words:
        return frozenset()
    size = min(size, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute_force(rows, size=2, percent=80):
    sets = [(i, sets_of(t, size)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (a, s) in enumerate(sets):
        for b, t in sets[:n]:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else find(i), i is None or find(i) == i) for i, s in sets), key=str)


def run(spark, rows, **more):
    frame = near_duplicates(spark.createDataFrame(rows, KIND), **more)
    return sorted((tuple(r) for r in frame.collect()), key=str)


def variants(seed=1):
    """Groups of edited copies around the threshold, in chains and in stars."""
    r = random.Random(seed)
    rows = []
    for group in range(12):
        words = [f"w{group}x{r.randrange(10_000)}" for _ in range(r.choice([3, 10, 40, 200]))]
        for _ in range(r.choice([2, 6, 15])):
            own = list(words)
            for _ in range(r.randint(0, max(1, len(own) // 12))):
                own[r.randrange(len(own))] = f"e{r.randrange(10**6)}"
            rows.append((len(rows), "  ".join(own)))
            if r.random() < 0.5:
                words = own
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_are_those_of_brute_force(spark, seed):
    rows = variants(seed)
    assert run(spark, rows) == brute_force(rows)


def test_nulls_empty_short_and_repeated(spark):
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "oNE "), (6, "one two"), (7, "One\x0bTwo"), (None, "one two"),
            (9, long), (8, long + " more"), (10, "É é"), (11, "é é"), (6, "one two")]
    assert run(spark, rows) == brute_force(rows)


def test_one_large_group_and_five_word_shingles(spark):
    base = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(base + [f"end{i}"])) for i in range(300)] + [(1000, "a b c"), (1001, "a b c")]
    assert run(spark, rows, size=5) == brute_force(rows, 5)


@pytest.mark.parametrize("edits", [5, 7])
def test_a_thousand_near_copies_about_the_limit(spark, edits, tmp_path):
    """Five edits of a hundred words leave 0.83 of the shingles of two copies in common at least, seven about 0.76."""
    r = random.Random(edits)
    rows = []
    for i in range(1000):
        own = [f"w{k}" for k in range(100)]
        for k in r.sample(range(1, 99), edits):
            own[k] = f"e{r.randrange(10**9)}"
        rows.append((i, " ".join(own)))
    got = run(spark, rows)
    sets = [sets_of(t, 2) for _, t in rows]
    # Brute force, in blocks: which copies have a link at all, and one component for all linked ones.
    parent = list(range(1000))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a in range(1000):
        for b in range(a):
            if 9 * len(sets[a] & sets[b]) >= 4 * (len(sets[a]) + len(sets[b])):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    assert {i: c for i, _, c, _ in got} == {i: find(i) for i in range(1000)}


def test_leftover_pairs_are_few(spark):
    """Copies just below the limit, with words of their own, meet nobody."""
    from eventpipe.llm.minhash import unlinked_pairs

    r = random.Random(1)
    rows = []
    for i in range(400):
        own = [f"w{k}" for k in range(100)]
        for k in r.sample(range(1, 99), 8):
            own[k] = f"e{r.randrange(10**9)}"
        rows.append((i, [hash(x) % 2**62 for x in sets_of(" ".join(own), 2)]))
    sets = spark.createDataFrame(rows, "doc_id bigint, shingles array<bigint>")
    members = spark.createDataFrame([(1, i, len(s), -1) for i, s in rows], "bucket bigint, rep bigint, n bigint, centre bigint")
    parts = spark.createDataFrame([], "node bigint, component bigint")
    assert unlinked_pairs(members, parts, sets, 80, Scratch(spark, "t")).count() < 400


def test_several_texts_under_one_id(spark):
    base = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(base)), (2, " ".join(f"v{i}" for i in range(50))), (2, " ".join(base[:-3] + ["x", "y"])), (3, " ".join(f"v{i}" for i in range(52)))]
    assert run(spark, rows) == brute_force(rows)


def test_empty_table_and_extra_columns(spark):
    assert run(spark, []) == []
    frame = near_duplicates(spark.createDataFrame([(1, "a b", 5, 6)], KIND + ", rep int, component_id int"))
    assert frame.columns == ["doc_id", "n_shingles", "component_id", "kept"] and frame.count() == 1


def test_hashes_follow_the_words():
    a, b = word_hashes("ab  cd\nab"), word_hashes("\tAB cd ab ")
    assert (a == b).all() and a[0] == a[2] and a[0] != a[1] and len(a) == 3
    assert not len(shingle_set(" \n"))


def test_similar_sets_share_a_bucket():
    r = np.random.default_rng(4)
    for n in (10, 50, 500):
        for _ in range(100):
            common = r.integers(0, 2**63, n, dtype=np.uint64)
            x = np.unique(np.r_[common, r.integers(0, 2**63, n // 10, dtype=np.uint64)] * np.uint64(2))
            y = np.unique(np.r_[common, r.integers(0, 2**63, n // 10, dtype=np.uint64)] * np.uint64(2))
            assert (buckets(x) == buckets(y)).any()


def test_components_of_chains_rings_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 40)]
    ring = [(100 + i, 100 + (i + 1) % 15) for i in range(15)]
    star = [(300, 200 + i) for i in range(30)]
    edges = spark.createDataFrame(chain + ring + star + star + [(7, 7)], "a bigint, b bigint")
    found = {r.node: r.component for r in connected_components(edges, Scratch(spark, "test-components")).collect()}
    expected = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(15)} | {200 + i: 200 for i in range(30)} | {300: 200}
    assert found == expected


def test_a_filter_keeps_all_wanted_rows_and_few_others(spark):
    wanted = spark.range(0, 30_000, 10).selectExpr("id AS key").union(spark.createDataFrame([(None,)], "key bigint"))
    rows = spark.range(30_000).selectExpr("id AS key", "id AS word", "-id AS place")
    got = common.maybe_among(rows, "key", wanted)
    assert got.columns == ["key", "word", "place"]
    keys = {r.key for r in got.collect()}
    assert keys.issuperset(range(0, 30_000, 10)) and len(keys) < 3_100
    assert common.maybe_among(rows, "key", wanted.limit(0)).isEmpty()


def test_few_texts_and_entries_are_dealt_out(spark, monkeypatch):
    """Joins of whole tables are met by the rows that the filters let pass."""
    moved = {}

    def heard(name, function):
        def call(frame, *rest):
            if name not in moved:
                moved[name] = frame.count(), frame._jdf.queryExecution().executedPlan().toString()
            return function(frame, *rest)

        return call

    monkeypatch.setattr(minhash, "with_sets", heard("texts", minhash.with_sets))
    monkeypatch.setattr(minhash, "join_groups", heard("entries", minhash.join_groups))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows = [(i, " ".join(f"w{i}x{j}" for j in range(30))) for i in range(100)]
        rows += [(100 + i, rows[i][1] + " more") for i in range(4)]
        near_duplicates(spark.createDataFrame(rows, KIND))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert moved["texts"][0] == 8 and moved["entries"][0] < 4 * minhash.BANDS * 2 + 100
    assert "BroadcastHashJoin" in moved["texts"][1].partition("SortMergeJoin")[2]


def test_more_keys_than_the_filter_has_bits(spark, monkeypatch):
    monkeypatch.setattr(common, "FILTER_WORDS", 1)
    rows = variants(3)
    assert run(spark, rows) == brute_force(rows)

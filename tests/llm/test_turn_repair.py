import hashlib
import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from eventpipe.llm import turn_repair
from eventpipe.llm.common import Scratch
from eventpipe.llm.turn_repair import Folded, damage, repair, repaired_digests, transitions

KIND = "conv_id bigint, turn bigint, role string, text string"


def all_edits(kinds, marks):
    """(cost, audit) of every way to a legal conversation, with up to three turns put in at any place."""

    def with_inserts(i, state, left):
        if i == len(kinds) and state in (None, "a"):
            yield 0, ""
        if left:
            turn = "a" if state == "u" else "u"
            for cost, rest in with_inserts(i, turn, left - 1):
                yield cost + 2, "I" + rest
        if i == len(kinds):
            return
        for cost, rest in with_inserts(i + 1, state, 3):
            yield cost + 3, "D" + rest
        if marks[i] in "bd":
            return
        late = marks[i] == "t"
        nexts = {None: "su", "s": "u", "u": "a", "a": "u"}[state]
        for turn in nexts:
            if kinds[i] == turn:
                for cost, rest in with_inserts(i + 1, turn, 3):
                    yield cost + late, "K" + rest
            elif turn != "s":
                for cost, rest in with_inserts(i + 1, turn, 3):
                    yield cost + 2 + late, "R" + rest

    return with_inserts(0, None, 3)


def folded(kinds, marks, block):
    state = Folded()
    for i in range(0, len(kinds), block):
        part = kinds[i : i + block], marks[i : i + block]
        state.add(i, *part, transitions(*part))
    cost, blocks = state.finish()
    return cost, "".join(audit for _, audit in blocks)


def test_short_conversations_against_all_edits():
    for n in (1, 2, 3):
        for kinds in itertools.product("sua?", repeat=n):
            for marks in itertools.product(".bt", repeat=n):
                expected = min(all_edits(kinds, marks))
                for block in (1, 2, 64):
                    assert folded("".join(kinds), "".join(marks), block) == expected
    rng = random.Random(5)
    for _ in range(60):
        kinds, marks = "".join(rng.choices("sua?", k=4)), "".join(rng.choices("..bdt", k=4))
        assert folded(kinds, marks, 3) == min(all_edits(kinds, marks)), (kinds, marks)


def test_blocks_of_any_size_give_the_same_audit():
    rng = random.Random(7)
    for _ in range(40):
        n = rng.randint(5, 40)
        kinds = "".join(rng.choice("ua" if rng.random() < 0.8 else "sua?") for _ in range(n))
        marks = "".join(rng.choices("......bdt", k=n))
        whole = folded(kinds, marks, n)
        assert all(folded(kinds, marks, b) == whole for b in (1, 3, 7, 16))


def test_a_long_legal_block_costs_nothing():
    best = {(before, after): cost for before, after, cost, _ in transitions("ua" * 32, "." * 64)}
    assert best["n", "a"] == best["s", "a"] == best["a", "a"] == 0


def connected(rows):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    return con


def made_up(rng, conv, n):
    out = []
    for turn in range(n):
        role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", None])
        text = rng.choice(["Yes.", "No!", "perhaps", " \t\n", "", None, f"text {turn}.", f"über {turn}", "a. b"])
        out.append((conv, rng.choice([turn, turn, turn, turn + 5, None]), role, text))
    return out


def test_against_sql_with_ties_nulls_and_long_conversations(spark):
    rng = random.Random(3)
    rows = [r for conv, n in enumerate([1, 2, 3, 5, 8, 8, 13, 40, 330]) for r in made_up(rng, conv, n)]
    rows += made_up(rng, None, 9) + [(99, 1, "user", "Hi.")] * 3 + [(98, None, None, None)] * 2
    frame = spark.createDataFrame(rows, KIND).repartition(3)
    got = repaired_digests(frame, Scratch(spark, "t"))
    names = got.columns
    theirs = connected(rows).sql(f"SELECT {', '.join(names)} FROM ({turn_repair.ORACLE})").fetchall()
    key = lambda r: (r[0] is None, r[0] or 0)
    for ours, other in zip(sorted(map(tuple, got.collect()), key=key), sorted(theirs, key=key), strict=True):
        assert ours == other


def test_repaired_turns_are_legal_and_whole(spark):
    long = "word " * 100_000 + "."
    rows = [(1, 1, "assistant", long), (1, 2, "assistant", "Two."), (2, 1, "user", " \n"), (3, 1, "system", "Be brief.")]
    audits, turns = repair(spark.createDataFrame(rows, KIND), Scratch(spark, "t"))
    got = {r.conv_id: (r.cost, r.audit) for r in audits.collect()}
    assert got == {1: (2, "RK"), 2: (3, "D"), 3: (3, "D")}
    texts = [(r.role, r.text) for r in turns.orderBy("conv_id", "place").collect()]
    assert texts == [("user", long), ("assistant", "Two.")]


def test_damage_by_place(spark):
    rows = [(c, t, "assistant", "A. b? c!") for c in range(30) for t in range(20)]
    got = damage(spark.createDataFrame(rows, KIND)).groupBy("conv_id", "turn").agg(F.collect_list(F.struct("role", "text")).alias("all"))
    got = {(r.conv_id, r.turn): [tuple(x) for x in r["all"]] for r in got.collect()}
    forms = {0: [], 1: [("assistant", "")], 2: [("assistant", "A b c")], 3: [("assistant", "A. b? c!")] * 2, 4: [("user", "A. b? c!")]}
    for c, t, role, text in rows:
        fate = zlib.crc32(f"{c}:{t}".encode()) % 20
        assert got.get((c, t), []) == forms.get(fate, [(role, text)])


def test_empty_tables_and_clashing_names(spark):
    got = repaired_digests(spark.createDataFrame([], KIND), Scratch(spark, "t"))
    assert got.collect() == []
    # All rows dropped: zeros, no audit, the digest of nothing.
    gone = next((c, t) for c in range(99) for t in range(9) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    frame = spark.createDataFrame([(*gone, "user", "x", 1, "y", 2)], KIND + ", pos int, audit string, mark int")
    assert tuple(repaired_digests(frame, Scratch(spark, "t")).first()) == (gone[0], 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())

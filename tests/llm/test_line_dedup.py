import hashlib

from eventpipe.llm.common import Scratch
from eventpipe.llm.line_dedup import LineRuns, dedup_lines

DOCS = "doc_id bigint, text string"
LONG = "A line that has well over forty characters in it"


def brute_force(rows, min_chars=40, min_docs=5):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip("\t\n\x0b\x0c\r "))

    cut = [(i, (text or "").split("\n")) for i, text in rows]
    holders = {}
    for i, lines in cut:
        for k in {key(x) for x in lines if len(key(x)) >= min_chars}:
            holders.setdefault(k, []).append(i)
    out = []
    for i, lines in cut:
        kept = []
        for line in lines:
            ids = holders.get(key(line), [])
            known = [x for x in ids if x is not None]
            gone = len(ids) >= min_docs and known and (i is None or i < max(known))
            if not gone:
                kept.append(line)
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def run(spark, rows):
    frame = dedup_lines(spark.createDataFrame(rows, DOCS))
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in frame.collect()), key=str)


def test_nulls_ties_repeats_and_long_texts(spark):
    rows = [(i, f"{LONG}\nonly {i}\n  {LONG.upper()}\t") for i in range(6)]
    rows += [(None, LONG), (7, None), (8, ""), (9, "\n\n"), (5, rows[5][1]), (10, "x" * 40 + "\n" + "é" * 39)]
    rows += [(20 + i, "x" * 40 + "\n" + "\n".join(f"line {j}" for j in range(3000))) for i in range(4)]
    assert run(spark, rows) == brute_force(rows)


def test_a_key_of_rows_without_id_keeps_its_lines(spark):
    rows = [(None, LONG)] * 6
    assert run(spark, rows) == brute_force(rows)


def test_short_lines_and_rare_lines_stay(spark):
    rows = [(i, "short\n" + LONG) for i in range(4)] + [(9, "short")] * 3
    assert run(spark, rows) == brute_force(rows)


def test_empty_table_and_clashing_names(spark):
    assert run(spark, []) == []
    kind = "doc_id bigint, text string, kept int, key string, pos int, lost string, lines int, row int"
    frame = dedup_lines(spark.createDataFrame([(1, LONG, 1, "k", 2, "l", 3, 4)], kind))
    assert frame.columns == ["doc_id", "text", "key", "pos", "lost", "lines", "row", "n_lines", "n_dropped", "kept"]
    assert frame.first()["kept"] == LONG


def test_settled_keys_stay_out_of_new_runs_and_levels_merge(spark):
    runs = LineRuns(spark, Scratch(spark, "test-runs"), min_docs=3, fanout=2)
    kind = "h1 bigint, h2 bigint, n_docs bigint, last_doc bigint"
    runs.add(spark.createDataFrame([(1, 1, 4, 90), (2, 2, 2, 95)], kind))
    runs.add(spark.createDataFrame([(1, 1, 2, 50), (2, 2, 1, 60), (3, 3, 1, 55)], kind))
    assert [len(level) for level in runs.levels] == [0, 1]
    merged = {(r.h1, r.n_docs, r.last_doc) for r in spark.table(runs.levels[1][0]).collect()}
    assert merged == {(1, 4, 90), (2, 3, 95), (3, 1, 55)}
    runs.add(spark.createDataFrame([(2, 2, 1, 99)], kind))
    assert {(r.h1, r.last_doc) for r in runs.frequent().collect()} == {(1, 90), (2, 99)}
    runs.remove()


def test_texts_are_cut_into_lines_above_the_join_that_moves_them(spark):
    frame = dedup_lines(spark.createDataFrame([(i, f"{LONG}\nonly {i}") for i in range(6)], DOCS))
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    above, join, below = plan.partition("Join LeftOuter")
    assert join and "split(" in above and "split(" not in below

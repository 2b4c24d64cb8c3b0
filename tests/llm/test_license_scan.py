import random
import re

import pytest

from eventpipe.llm.common import Scratch
from eventpipe.llm.license_rules import rules
from eventpipe.llm.license_scan import LEFT, RIGHT, licenses, scan

KIND = "doc_id bigint, text string"


def words_in(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower) if w]


def brute(text):
    """All rules at every keyword, then all pairs of detections."""
    words, found = words_in(text), []
    for i, word in enumerate(words):
        before = " " + "".join(w + " " for w in words[max(i - LEFT, 0) : i])
        after = "".join(w + " " for w in words[i : i + RIGHT])
        for r in rules():
            if word in r.keywords:
                m, n = re.search(f" {r.left}$", before), re.match(f"{r.right} ", after)
                if m and n:
                    found.append((i - m[0].count(" ") + 1, i + n[0].count(" ") - 1, r))
    rank = lambda d: (d[2].priority, d[0] - d[1], d[2].number)
    kept = [a for a in found if a[2].base or not any(b[0] <= a[0] and b[1] >= a[1] and rank(b) < rank(a) for b in found)]
    base = [d for d in kept if d[2].base]
    starts = [d[0] for d in base]
    labels = lambda ds: ",".join(sorted({d[2].label for d in ds}))
    return (
        len(words), len(base), min(starts, default=None), max(starts, default=None),
        labels(base), labels(kept), max((d[2].strength for d in kept), default=0.0),
    )


def got_rows(frame, spark):
    return {r.doc_id: tuple(r)[1:] for r in licenses(frame, Scratch(spark, "t")).collect()}


def test_rules_are_many_and_fit_the_words_around_a_keyword():
    listed = rules()
    assert len(listed) > 300 and [r.number for r in listed] == list(range(len(listed)))
    for r in listed:
        assert re.compile(r.left) and re.compile(r.right) and 0 < r.strength <= 1
        assert r.left == "" or r.left.endswith((" ", ")", "?", "}")), r
        assert r.left.count(" ") <= LEFT and r.right.count(" ") + 1 <= RIGHT, r
        assert all(re.match(r.right.split(" ")[0].split("(")[0] + "$", k) for k in r.keywords), r


@pytest.mark.parametrize(
    "text, labels, score",
    [
        ("Licensed under the Apache License, Version 2.0.", "apache-2.0", 0.95),
        ("SPDX-License-Identifier: MIT", "mit", 1.0),
        ("Released under the MIT License.", "mit", 0.95),
        ("released under the mit licence", "mit", 0.95),
        ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc-4.0", 0.95),
        ("This work is licensed under the GNU General Public License, version 3.", "gpl,gpl-3.0", 0.95),
        ("https://www.gnu.org/licenses/old-licenses/gpl-2.0.html", "gpl-2.0", 0.9),
        ("Copyright (c) 1999 Someone. All rights reserved.", "copyright,reserved", 0.5),
        ("GPLv3 or the GPL", "gpl,gpl-3.0", 0.7),
        ("neither the name of the Some Long Name nor the names of its contributors may be used to endorse", "bsd-3-clause", 0.95),
        ("mit freundlichen Grüßen, by the way: use it", "", 0.0),
        ("cc, by", "cc-by", 0.5),
        ("general public licence", "", 0.0),
    ],
)
def test_known_notices(spark, text, labels, score):
    [row] = got_rows(spark.createDataFrame([(1, text)], KIND), spark).values()
    assert row[5:] == (labels, score) and row == brute(text)


def test_against_brute_force(spark):
    rng = random.Random(11)
    listed = rules()
    bits = ["cc by", "CC-BY", "general public license", "GNU", "All rights reserved", "über", "É1", "the", "license", "version 2.0", "or later", "mit"]

    def example(r):
        text = re.sub(r"\\S\+", "some", re.sub(r"\\d", "1", r.left + r.right))
        while "(" in text:
            text = re.sub(r"\(\?:([^()|]*)(?:\|[^()]*)*\)(?:\?|\*|\+|\{\d,\d\})?", lambda m: m[1] if rng.random() < 0.8 else "", text)
        return text.replace("[cs]", "c").replace(" ?", "")

    texts = []
    for i in range(120):
        parts = [rng.choice(bits) if rng.random() < 0.6 else example(rng.choice(listed)) for _ in range(rng.randint(0, 25))]
        texts.append(rng.choice([" ", ", ", "\n- ", "\x00"]).join(parts))
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000, None), (1001, ""), (1002, "...")]
    got = got_rows(spark.createDataFrame(rows, KIND).repartition(5), spark)
    assert sum(row[6] > 0.6 for row in got.values()) > 60
    for i, text in rows:
        assert got[i] == brute(text), text


def test_a_very_long_text_with_very_many_detections(spark):
    text = "CC BY-SA 4.0 by GNU General Public License; all rights reserved " * 20_000
    [row] = got_rows(spark.createDataFrame([(1, text)], KIND), spark).values()
    assert row == (260_000, 60_000, 0, 259_997, "cc-by,gpl,reserved", "cc-by,cc-by-sa-4.0,gpl,reserved", 0.7)


def test_repeated_rows_null_ids_empty_table_and_clashing_names(spark):
    rows = [(1, "cc by"), (1, "cc by"), (1, "plain"), (None, "all rights reserved"), (None, "x")]
    got = licenses(spark.createDataFrame(rows, KIND), Scratch(spark, "t"))
    assert sorted((str(r.doc_id), r.n_base, r.labels) for r in got.collect()) == [
        ("1", 0, ""), ("1", 1, "cc-by"), ("1", 1, "cc-by"), ("None", 0, ""), ("None", 1, "reserved")
    ]
    assert licenses(spark.createDataFrame([], KIND), Scratch(spark, "t")).collect() == []
    frame = spark.createDataFrame([(1, "GPL", 7, "x", 1, "y")], KIND + ", row int, words string, label int, hits string")
    texts, detections = scan(frame, Scratch(spark, "t"))
    assert [(r.doc_id, r.n_words) for r in texts.collect()] == [(1, 1)]
    assert [(r.start, r.end, r.label) for r in detections.collect()] == [(0, 0, "gpl")]


def test_no_python_in_the_plan(spark):
    frame = licenses(spark.createDataFrame([(1, "GPL")], KIND), Scratch(spark, "t"))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|ExistingRDD", plan)

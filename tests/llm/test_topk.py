import math
import random

from pyspark.sql import functions as F

from eventpipe.llm import topk
from eventpipe.llm.topk import top_k

KIND = "vec_id bigint, embedding array<float>"


def brute_force(rows, every, k=5):
    import numpy as np

    usable = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable.append((i, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for q, v in {(i, tuple(v)) for i, v in usable if i % every == 0}:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, every=7, k=5):
    frame = top_k(spark.createDataFrame(rows, KIND), F.col("vec_id") % every == 0, k)
    return sorted(tuple(r) for r in frame.collect())


def vectors(n, width, seed=1):
    r = random.Random(seed)
    return [(i, [r.gauss(0, 1) for _ in range(width)]) for i in range(n)]


def test_as_brute_force_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 50)
    monkeypatch.setattr(topk, "QUERY_ROWS", 20)
    rows = vectors(600, 16)
    assert run(spark, rows) == brute_force(rows, 7)


def test_ties_copies_nulls_and_odd_vectors(spark):
    rows = vectors(100, 4) + [(200 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(150)] + [(210, [1.0, 2.0, 3.0, 4.0])]
    rows += [(700, None), (707, [1.0, None]), (714, [float("nan")]), (721, [float("inf"), 1.0]), (None, [1.0]), (728, [5.0]), (735, []), (736, [0.0] * 4)]
    assert run(spark, rows) == brute_force(rows, 7)


def test_fewer_rows_than_k_and_empty_tables(spark):
    assert run(spark, []) == [] and run(spark, [(7, None)]) == [] and run(spark, [(7, [1.0])]) == []
    rows = [(7, [1.0]), (1, [2.0]), (2, [-1.0])]
    assert run(spark, rows) == brute_force(rows, 7)


def test_clusters_let_cells_be_left_out(spark):
    r = random.Random(2)
    centres = [[r.gauss(0, 10) for _ in range(8)] for _ in range(10)]
    rows = [(i, [c + r.gauss(0, 0.1) for c in centres[i % 10]]) for i in range(500)]
    assert run(spark, rows) == brute_force(rows, 7)


def test_clashing_extra_columns(spark):
    frame = spark.createDataFrame([(7, [1.0], 1, 2), (1, [2.0], 1, 2)], KIND + ", score int, cell int")
    assert [tuple(r) for r in top_k(frame, F.col("vec_id") == 7).collect()] == [(7, 1, 1, 256 * 512)]

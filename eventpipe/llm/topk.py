"""Exact top-k by inner product over a pivot-distance index.

Inner products become distances by one more coordinate: with M the largest
norm, x' = (x, sqrt(M^2 - |x|^2)) and q' = (q, 0) give
|q' - x'|^2 = |q|^2 + M^2 - 2 q.x, so the largest product is the nearest
neighbour and the triangle inequality holds.

Every vector is keyed by its nearest pivot and by its distance from it, cut
into annuli. From a query's distance D to a pivot, no vector of an annulus
[r0, r1] is nearer than max(0, D - r1, r0 - D). A first pass scans each query's
most promising cells for a threshold, a second those cells whose bound still
reaches it, best first, and stops at the first that does not reach the k-th
best score. Scores are integers and exact; bounds have a margin for rounding.

Pivots are the vectors least by hash, ``PIVOTS`` of them; there are at most
``PIVOTS * RINGS`` cells, so their summary is small however large the table.
Neighbouring cells share a block; a block of many vectors is dealt over salts,
and queries come in chunks.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from eventpipe.llm.common import Scratch

SCALE = 256
K = 5
PIVOTS = 32
RINGS = 64
BLOCK_ROWS = 2048
QUERY_ROWS = 1024
QUERY_EVERY = 50
MARGIN = 1e-6

PAIRS = "query bigint, query_id bigint, vec_id bigint, score bigint"


def scaled(embedding: Column) -> Column:
    """floor(256 x) of every component, as longs; null for a vector that takes no part."""
    parts = F.transform(embedding, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    usable = F.forall(
        embedding,
        lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")),
    )
    return F.when(embedding.isNotNull() & usable, parts)


def matrix(vectors, width: int) -> np.ndarray:
    """Rows of float64; shorter vectors are filled with zeros."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


class Geometry:
    """Pivots and norms that the index is made of, small enough to go to every task."""

    def __init__(self, pivots: np.ndarray, square: float):
        self.square = square
        self.pivots = self.lifted(pivots)
        self.width = max(math.sqrt(square), 1.0) * 2 / RINGS

    def lifted(self, x: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.square - np.einsum("ij,ij->i", x, x), 0)
        return np.hstack([x, np.sqrt(rest)[:, None]])

    def distances(self, lifted: np.ndarray) -> np.ndarray:
        squares = np.einsum("ij,ij->i", lifted, lifted)[:, None] + np.einsum("ij,ij->i", self.pivots, self.pivots)
        return np.sqrt(np.maximum(squares - 2 * lifted @ self.pivots.T, 0))

    def of_data(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest pivot of each row, and the distance to it."""
        d = self.distances(self.lifted(x))
        nearest = d.argmin(axis=1)
        return nearest, d[np.arange(len(x)), nearest]

    def bounds(self, q: np.ndarray, cells: pd.DataFrame) -> np.ndarray:
        """An upper bound of the score of each query with any vector of each cell."""
        d = self.distances(np.hstack([q, np.zeros((len(q), 1))]))[:, cells["pivot"].to_numpy()]
        least = np.maximum(0, np.maximum(d - cells["r1"].to_numpy(), cells["r0"].to_numpy() - d))
        total = np.einsum("ij,ij->i", q, q)[:, None] + self.square
        # Distances are roots of differences of large numbers: the margin covers their rounding.
        slack = MARGIN * (total + 2 * np.abs(d) * math.sqrt(self.square)) + 1
        return (total - np.maximum(least, 0) ** 2) / 2 + slack


def best_rows(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: by score, ties to the smaller id."""
    if len(scores) > 4 * k:
        floor = np.partition(scores, -k)[-k]
        places = np.flatnonzero(scores >= floor)
        return places[np.lexsort((ids[places], -scores[places]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def scan(data: pd.DataFrame, queries: pd.DataFrame, cells: pd.DataFrame, geometry: Geometry, width: int, k: int):
    """The k best of one block for each of its queries, over its cells in falling order of their bound."""
    if not len(data) or not len(queries):
        return pd.DataFrame(columns=["query", "query_id", "vec_id", "score"])
    q = matrix(queries["v"].to_numpy(), width)
    own, least = queries["query_id"].to_numpy(np.int64), queries["least"].to_numpy(float)
    here = cells[cells["cell"].isin(data["cell"].unique())].reset_index(drop=True)
    bounds = geometry.bounds(q, here)
    x, ids = matrix(data["v"].to_numpy(), width), data["vec_id"].to_numpy(np.int64)
    exact = (np.abs(x).max(initial=0) * np.abs(q).max(initial=0) * max(width, 1)) < 2**53
    x, whole_q = (x, q) if exact else (x.astype(np.int64), q.astype(np.int64))
    places = {c: np.flatnonzero(data["cell"].to_numpy() == c) for c in here["cell"]}
    kept_scores = [np.empty(0, np.int64) for _ in own]
    kept_ids = [np.empty(0, np.int64) for _ in own]
    kth = least.copy()
    for cell in np.argsort(-bounds.max(axis=0)):
        asking = np.flatnonzero(bounds[:, cell] >= kth)
        if not len(asking):
            if bounds[:, cell].max() < kth.min():
                break
            continue
        rows = places[here["cell"][cell]]
        scores = (whole_q[asking] @ x[rows].T).astype(np.int64)
        for i, row in zip(asking, scores):
            others = ids[rows] != own[i]
            s = np.concatenate([kept_scores[i], row[others]])
            n = np.concatenate([kept_ids[i], ids[rows][others]])
            top = best_rows(s, n, k)
            kept_scores[i], kept_ids[i] = s[top], n[top]
            if len(top) == k:
                kth[i] = max(kth[i], float(s[top[-1]]))
    counts = [len(s) for s in kept_scores]
    return pd.DataFrame({
        "query": np.repeat(queries["query"].to_numpy(np.int64), counts),
        "query_id": np.repeat(own, counts),
        "vec_id": np.concatenate(kept_ids),
        "score": np.concatenate(kept_scores),
    })


def top_k(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of ``vectors`` (vec_id, embedding, more) with ``is_query``.

    Candidates of a query are all rows with another vec_id. Vectors that are
    null or hold a null or non-finite component take no part, nor do rows
    without vec_id. Shorter vectors count as filled with zeros; scaled
    components are taken to be below 2^31. A candidate row that repeats counts
    as often as it stands there, a query row that repeats is one query. Other
    columns are ignored. An empty table, or one row, gives an empty result.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "top-k")
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), scaled(F.col("embedding")).alias("v"), is_query.alias("asks")
    ).where("v IS NOT NULL AND vec_id IS NOT NULL")
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    largest = rows.agg(F.max(square), F.max(F.size("v"))).first()
    if largest[0] is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    width = max(largest[1], 1)
    chosen = rows.select("v").orderBy(F.xxhash64("vec_id", "v")).limit(PIVOTS).distinct().collect()
    geometry = spark.sparkContext.broadcast(Geometry(matrix([r["v"] for r in chosen], width), float(largest[0])))

    def place(batches):
        for batch in batches:
            pivot, distance = geometry.value.of_data(matrix(batch["v"].to_numpy(), width))
            ring = (distance // geometry.value.width).astype(int)
            yield batch.assign(cell=pivot * 4 * RINGS + ring, pivot=pivot, r=distance)

    indexed = scratch.settle(
        rows.mapInPandas(place, "vec_id bigint, v array<bigint>, asks boolean, cell int, pivot int, r double"), "indexed"
    )
    cells = indexed.groupBy("cell", "pivot").agg(F.min("r").alias("r0"), F.max("r").alias("r1"), F.count("*").alias("n"))
    # One row per cell: at most PIVOTS * 4 * RINGS, by construction.
    cells = cells.toPandas().sort_values("cell", ignore_index=True)
    cells["block"] = (cells["n"].cumsum() - 1) // BLOCK_ROWS
    salts = (-(-cells.groupby("block")["n"].sum() // BLOCK_ROWS)).to_dict()
    summary = spark.sparkContext.broadcast(cells)
    dealt = spark.createDataFrame(
        [(int(c), int(b), int(salts[b])) for c, b in zip(cells["cell"], cells["block"])], "cell int, block int, salts int"
    )
    asked = indexed.where("asks").select("vec_id", "v").distinct()
    asked = asked.select(F.xxhash64("vec_id", "v").alias("query"), F.col("vec_id").alias("query_id"), "v")

    def visits(batches, only_best: bool):
        table = summary.value
        starts = np.flatnonzero(np.r_[True, np.diff(table["block"]) > 0])
        names = table["block"].to_numpy()[starts]
        for batch in batches:
            bounds = geometry.value.bounds(matrix(batch["v"].to_numpy(), width), table)
            by_block = np.maximum.reduceat(bounds, starts, axis=1)
            wanted = by_block >= batch["least"].to_numpy(float)[:, None]
            if only_best:
                wanted &= by_block == by_block.max(axis=1, keepdims=True)
            i, block = np.nonzero(wanted)
            out = batch.iloc[i].assign(block=names[block].astype(np.int32))
            yield out[["query", "query_id", "v", "least", "block"]]

    def searched(queries: DataFrame, only_best: bool, name: str) -> DataFrame:
        fields = "query bigint, query_id bigint, v array<bigint>, least double, block int"
        visiting = queries.mapInPandas(lambda b: visits(b, only_best), fields)
        visiting = scratch.settle(visiting, f"{name}-visits")
        chunks = visiting.groupBy("block").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("chunks"))
        plan = scratch.settle(dealt.select("block", "salts").distinct().join(chunks, "block"), f"{name}-plan")
        # A row per block, at most as many as cells.
        plan = F.broadcast(plan)
        left = indexed.join(F.broadcast(dealt.select("cell", "block")), "cell").join(plan, "block").select(
            "block",
            F.pmod(F.xxhash64("vec_id", "v", "r"), "salts").cast("int").alias("salt"),
            F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
            "vec_id", "v", "cell",
        )
        right = visiting.join(plan, "block").select(
            "block",
            F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
            F.pmod("query", "chunks").cast("int").alias("chunk"),
            "query", "query_id", "v", "least",
        )
        by = ["block", "salt", "chunk"]
        scanned = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(
            lambda data, queries: scan(data, queries, summary.value, geometry.value, width, k), PAIRS
        )
        order = Window.partitionBy("query", "query_id").orderBy(F.desc("score"), "vec_id")
        # A rank filter: Spark keeps k rows per query and partition before the shuffle.
        ranked = scanned.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        return scratch.settle(ranked, name)

    nothing = F.lit(float("-inf"))
    first = searched(asked.withColumn("least", nothing), True, "first")
    kth = first.where(F.col("rank") == k).select("query", "query_id", F.col("score").cast("double").alias("least"))
    second = searched(
        asked.join(kth, ["query", "query_id"], "left").withColumn("least", F.coalesce("least", nothing)), False, "second"
    )
    return second.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of ``embeddings`` with a vec_id divisible by 50 against all others."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, F.col("vec_id") % QUERY_EVERY == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""

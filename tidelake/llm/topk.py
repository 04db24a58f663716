"""Exact top-k search by multi-resolution segment statistics.

A vector is cut into segments; of each its mean and its deviation are kept.  For segments of w
components two vectors' inner product is the sum of w times the product of the means and of what
is left beside them, and that is at most w times the product of the deviations: so the statistics
bound the inner product from above (and the distance from below, which is the lengths less twice
the inner product).  Few long segments give a coarse bound, more and shorter ones a finer one.

What is cut into segments is a vector's difference from the centre of its block, whose inner
product with the query is added exactly; so vectors that lie close together have small bounds.
Whole leaves are passed over by the lowest and highest statistics of their vectors.  In a block
the bounds go from coarse to fine, each only over the pairs the one before has left; exact scores
are computed for what survives.  Bounds are widened by a relative ``SLACK`` against rounding.

Each query starts from the score of its own block's last answer, which the final one reaches.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.llm.leaves import Leaves, best, products, vectors
from tidelake.llm.shared import written

TOP, SCALE = 20, 64
#: Segments of each resolution, coarse to fine (a vector is filled up with zeros to a multiple).
LEVELS = (4, 16, 32)
#: Segments whose statistics cut the tree and bound the leaves.
LEAF_LEVEL = 16
#: Share of a block's pairs above which the next step is computed for all of them at once.
DENSE = 0.2
#: How far bounds are widened against rounding, relative to the lengths.
SLACK = 1e-9


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and then deviations of each row's segments, times the root of their width, so that
    products of them add up to inner products."""
    wide = -(-x.shape[1] // segments) * segments
    parts = np.pad(x, ((0, 0), (0, wide - x.shape[1]))).reshape(len(x), segments, -1)
    root = np.sqrt(parts.shape[2])
    return np.hstack([parts.mean(axis=2) * root, parts.std(axis=2) * root])


def highest(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Most that each query (row) can score in each leaf (column), from the lowest and highest statistics there."""
    q = statistics(queries, LEAF_LEVEL)
    means = q[:, :LEAF_LEVEL]
    up = np.maximum(means, 0) @ high[:, :LEAF_LEVEL].T + np.minimum(means, 0) @ low[:, :LEAF_LEVEL].T + q[:, LEAF_LEVEL:] @ high[:, LEAF_LEVEL:].T
    size = np.linalg.norm(queries, axis=1)[:, None] * np.sqrt((np.maximum(np.abs(low), np.abs(high)) ** 2).sum(axis=1))
    return up + SLACK * size + SLACK


def survivors(queries: np.ndarray, floor: np.ndarray, vectors: np.ndarray, centre: np.ndarray, levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(query, vector) pairs that no resolution's bound keeps below the query's ``floor``; levels:
    the statistics of the vectors' differences from the centre."""
    base = (queries @ centre)[:, None] + SLACK * (1 + np.linalg.norm(queries, axis=1)[:, None] * (np.linalg.norm(vectors, axis=1) + 2 * np.linalg.norm(centre)))
    row = col = None
    for segments, own in zip(LEVELS, levels):
        asked = statistics(queries, segments)
        if row is None or len(row) > DENSE * base.size:
            hit = base + asked @ own.T >= floor[:, None]
            if row is not None:
                kept = np.zeros_like(hit)
                kept[row, col] = True
                hit &= kept
            row, col = np.nonzero(hit)
        else:
            keep = base[row, col] + np.einsum("ij,ij->i", asked[row], own[col]) >= floor[row]
            row, col = row[keep], col[keep]
    return row, col


def _block(ids: np.ndarray, kinds: np.ndarray, x: np.ndarray, top: int):
    """Answers of one block: each query's best ``top``."""
    centre = x.mean(axis=0)
    levels = [statistics(x - centre, s) for s in LEVELS]

    def answer(q_ids: np.ndarray, q_kinds: np.ndarray, queries: np.ndarray, told: np.ndarray):
        row, col = survivors(queries, told[:, 0], x, centre, levels)
        if len(row) > DENSE * len(queries) * len(x):
            scores = products(queries, x)[row, col]
        elif len(row) and x.shape[1] * np.abs(queries).max() * np.abs(x).max() < 2.0**53:
            scores = np.einsum("ij,ij->i", queries[row], x[col])
        else:
            scores = products(queries, x)[row, col] if len(row) else np.zeros(0)
        order = np.lexsort((ids[col], -scores, row))
        row, col, scores = row[order], col[order], scores[order]
        keep = (np.arange(len(row)) - np.searchsorted(row, row) < top) & (scores >= told[row, 0])
        return q_ids[row[keep]], ids[col[keep]], scores[keep].astype(np.int64)

    return answer


def search(rows: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", top: int = TOP, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``top`` highest inner products of floor(scale * x).

    Queries are the ids for which ``is_query`` (over the column id) holds; candidates all rows but
    the query's own.  Equal scores rank by the smaller id; fewer candidates: all of them.  Null
    vectors, those with a null or non-finite component and rows without an id take no part; of
    rows that repeat an id the one with the smallest vector does.  Zero and empty vectors score
    zero; what a shorter vector lacks counts as zero.  A score that no long holds raises.
    """
    spark = rows.sparkSession
    schema = "query long, id long, score long"
    index = Leaves(vectors(rows, id_col, vector_col), scale, lambda x: statistics(x, LEAF_LEVEL), top + 1, is_query)
    if not index.n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    more = top + 1  # a query may be among its own vector's ids
    handle = lambda *block: _block(*block, more)
    own = written(index.queries().withColumn("told", F.array(F.lit(float("-inf")))))
    first = index.visit(own, handle, schema).groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low"))
    asked = own.join(first, F.col("id") == F.col("query"), "left")
    floor = F.when(F.col("n") >= more, F.col("low").cast("double")).otherwise(F.lit(float("-inf")))
    asked = index.reached(asked.withColumn("floor", floor), highest, F.col("floor")).withColumn("told", F.array("floor"))
    found = best(index.visit(written(asked.select("id", "kind", "vec", "blocks", "told")), handle, schema), ["query"], more)
    found = found.withColumnRenamed("id", "rep").join(index.groups, "rep").select("query", "id", "score")
    # of equal vectors only the smallest ids can count
    listed = best(found, ["query"], more).drop("rank").withColumnRenamed("query", "rep")
    out = index.asking.withColumnRenamed("id", "query_id").join(listed, "rep").where("id <> query_id")
    return best(out, ["query_id"], top).select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")

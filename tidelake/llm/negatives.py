"""Hard negatives by threshold joins over an inverted index with norm bounds.

An anchor's positives are its nearest rows of its own label; its negatives are the nearest rows of
other labels whose score lies in a window below a positive's.  Both are threshold joins: all rows
that score at least t with the anchor.

In a block the components stand in the order of their weight and are posted by ranges of them: a
vector is posted for a range only as long as the norm of what it has from there on could still
carry a score to the lowest threshold asked; its remaining components are left out of the index.
Scores are accumulated range by range.  A pair goes as soon as its partial score and the product
of both norms of what remains fall short of t; pairs that are left are scored exactly.  The
threshold starts high and is lowered for those anchors whose windows are not full yet, down to
what the window itself allows or what the anchor has found in its own block.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.llm.leaves import Leaves, best, products, vectors
from tidelake.llm.shared import written

SCALE, POSITIVES, NEGATIVES = 256, 5, 3
#: A negative's score, in hundredths of the positive's (fixed values).
LEAST, MOST = 50, 95
#: Ranges of components in the index.
RANGES = 4
#: How far down the threshold goes in each step, as a share of the way from its start left above the floor.
STEPS = (0.5, 0.25, 0.0)
#: Share of pairs above which a range is accumulated for all of them at once.
DENSE = 0.2
#: How far bounds are widened against rounding, relative to the lengths.
SLACK = 1e-9


def outline(x: np.ndarray) -> np.ndarray:
    """What leaves are cut and bounded by: the components and the norm."""
    return np.hstack([x, np.linalg.norm(x, axis=1)[:, None]])


def highest(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Most that each query can score in each leaf: by the largest products of components, and by the norms."""
    by_weight = np.maximum(queries, 0) @ high[:, :-1].T + np.minimum(queries, 0) @ low[:, :-1].T
    by_norm = np.linalg.norm(queries, axis=1)[:, None] * high[:, -1]
    return np.minimum(by_weight, by_norm) + SLACK * by_norm + SLACK


class Postings:
    """The inverted index of one block of vectors."""

    def __init__(self, x: np.ndarray):
        self.order = np.argsort(-(x**2).sum(axis=0), kind="stable")
        self.x = np.ascontiguousarray(x[:, self.order])
        self.cuts = np.linspace(0, x.shape[1], min(RANGES, x.shape[1]) + 1).astype(int)
        self.rest = self.remaining(self.x)

    def remaining(self, x: np.ndarray) -> np.ndarray:
        """Norm of what each row has from the start of each range on; zero behind the last."""
        squares = np.cumsum((x**2)[:, ::-1], axis=1)[:, ::-1]
        return np.sqrt(np.hstack([squares, np.zeros((len(x), 1))])[:, self.cuts])

    def joined(self, queries: np.ndarray, floor: np.ndarray, fits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, vector, score) of all pairs that fit and score at least the query's ``floor``."""
        q = queries[:, self.order]
        ask = self.remaining(q)
        least = floor - SLACK * (1 + ask[:, 0] * self.rest[:, 0].max())
        # how many ranges each vector is posted for: what it has beyond them carries no score to any threshold
        posted = (self.rest[:, :-1] * ask[:, :-1].max(axis=0) >= least.min()).cumprod(axis=1).sum(axis=1)
        row, col = np.nonzero(fits & (posted > 0))
        done = np.zeros(len(row))
        for i, (s, e) in enumerate(zip(self.cuts, self.cuts[1:])):
            at = np.flatnonzero(posted[col] > i)
            if len(at) > DENSE * len(q) * len(self.x):
                done[at] += (q[:, s:e] @ self.x[:, s:e].T)[row[at], col[at]]
            else:
                done[at] += np.einsum("ij,ij->i", q[row[at], s:e], self.x[col[at], s:e])
            end = np.minimum(posted[col], i + 1)
            bound = done + ask[row, end] * self.rest[col, end]
            keep = bound >= least[row]
            row, col, done = row[keep], col[keep], done[keep]
        if len(row) > DENSE * len(q) * len(self.x) or len(row) and q.shape[1] * np.abs(q).max() * np.abs(self.x).max() >= 2.0**53:
            scores = products(q, self.x)[row, col]
        else:
            scores = np.einsum("ij,ij->i", q[row], self.x[col])
        keep = scores >= floor[row]
        return row[keep], col[keep], scores[keep]


def _block(ids: np.ndarray, kinds: np.ndarray, x: np.ndarray, same: bool, want: int):
    """Answers of one block: the first ``want`` of each query's windows; told: the windows' floors, then their ends."""
    index = Postings(x)

    def answer(q_ids: np.ndarray, q_kinds: np.ndarray, queries: np.ndarray, told: np.ndarray):
        low, high = np.hsplit(told, 2)
        reach = np.linalg.norm(queries, axis=1) * index.rest[:, 0].max() + 1
        floor = np.maximum(low.min(axis=1), -reach)
        start = np.maximum(np.where(high >= low, np.minimum(high, reach[:, None]), -np.inf).max(axis=1), floor)
        fits = (kinds == q_kinds[:, None]) == same
        out, open_ = [], np.flatnonzero(np.isfinite(floor))
        for share in STEPS:
            if not len(open_):
                break
            t = floor[open_] + share * (start[open_] - floor[open_])
            row, col, score = index.joined(queries[open_], t, fits[open_])
            full = np.ones(len(open_), dtype=bool)
            for w in range(low.shape[1]):
                inside = (score >= low[open_, w][row]) & (score <= high[open_, w][row])
                r, c, s = row[inside], col[inside], score[inside]
                o = np.lexsort((ids[c], -s, r))
                r, c, s = r[o], c[o], s[o]
                first = np.arange(len(r)) - np.searchsorted(r, r) < want
                r, c, s = r[first], c[first], s[first]
                enough = (np.bincount(r, minlength=len(open_)) >= want) | (low[open_, w] > high[open_, w])
                full &= enough | (share == 0)
                out.append((open_[r], np.full(len(r), w, dtype=np.int32), c, s))
            # what an anchor that goes on has found so far is found again
            out[-low.shape[1] :] = [tuple(v[full[np.searchsorted(open_, o[0])]] for v in o) for o in out[-low.shape[1] :]]
            open_ = open_[~full]
        row, w, col, score = (np.concatenate(v) for v in zip(*out)) if out else (np.zeros(0, dtype=int),) * 4
        return q_ids[row], w.astype(np.int32), ids[col], score.astype(np.int64)

    return answer


def mine(
    rows: DataFrame, is_anchor: Column, label: Column, id_col: str = "vec_id", vector_col: str = "embedding",
    positives: int = POSITIVES, negatives: int = NEGATIVES, scale: int = SCALE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor``: over the column id; ``label``: over the columns of ``rows``.  Scores are inner
    products of floor(scale * x), higher first, ties by the smaller id.  For each anchor and each
    of its first positives the first rows of another label with LEAST to MOST hundredths of the
    positive's score; none for a negative positive score.  Rows without id, label or vector and
    vectors with a null or non-finite component take no part; of rows that repeat an id the one
    with the smallest vector does.  Zero and empty vectors score zero; what a shorter vector lacks
    counts as zero.  A score that no long holds raises.
    """
    spark = rows.sparkSession
    index = Leaves(vectors(rows, id_col, vector_col, label).where("kind is not null"), scale, outline, positives + 1, is_anchor)
    if not index.n:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    schema, more = "query long, w int, id long, score long", positives + 1  # an anchor may be among its own vector's ids
    everything, nothing = F.lit(float("-inf")), F.lit(float("inf"))
    alike = lambda *block: _block(*block, True, more)
    other = lambda *block: _block(*block, False, negatives)

    # positives: the home block's last one is a threshold that the final ones reach
    own = written(index.queries().withColumn("told", F.array(F.lit(-1e300), nothing)))
    first = index.visit(own, alike, schema).groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low"))
    floor = F.when(F.col("n") >= more, F.col("low").cast("double")).otherwise(F.lit(-1e300))
    asked = index.reached(own.join(first, F.col("id") == F.col("query"), "left").withColumn("floor", floor), highest, F.col("floor"))
    asked = written(asked.withColumn("told", F.array("floor", nothing)).select("id", "kind", "vec", "blocks", "told"))
    near = best(index.visit(asked, alike, schema), ["query"], more).withColumnRenamed("id", "rep").join(index.groups, "rep")
    near = written(best(near.select("query", "id", "score"), ["query"], more).drop("rank"))

    # windows: one for each score that a positive of the anchors' vector has
    windows = near.where("score >= 0").groupBy("query").agg(F.sort_array(F.collect_set("score"), asc=False).alias("of"))
    low = F.transform("of", lambda s: F.ceil(s * F.lit(LEAST) / 100).cast("double"))
    high = F.transform("of", lambda s: F.floor(s * F.lit(MOST) / 100).cast("double"))
    fill = lambda a, v: F.slice(F.concat(a, F.array_repeat(v, more)), 1, more)
    asked = own.join(windows, F.col("id") == F.col("query")).select("id", "kind", "vec", "blocks", "of", low.alias("low"), high.alias("high"))
    asked = written(asked.withColumn("told", F.concat(fill(F.col("low"), nothing), fill(F.col("high"), everything))))
    have = index.visit(asked, other, schema).groupBy("query", "w").agg(F.count(F.lit(1)).alias("n"), F.min("score").cast("double").alias("score"))
    have = have.where(F.col("n") >= negatives).groupBy("query").agg(F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("have"))
    reached = F.transform("low", lambda v, i: F.greatest(v, F.try_element_at("have", i)))
    asked = asked.join(have, F.col("id") == F.col("query"), "left").withColumn("low", reached).withColumn("told", F.concat(fill(F.col("low"), nothing), fill(F.col("high"), everything)))
    asked = written(index.reached(asked, highest, F.array_min("low")).select("id", "kind", "vec", "blocks", "told", "of"))
    found = best(index.visit(asked, other, schema), ["query", "w"], negatives).drop("rank").withColumnRenamed("id", "rep").join(index.groups, "rep")
    found = best(found.select("query", "w", "id", "score"), ["query", "w"], negatives)
    scores = asked.select(F.col("id").alias("query"), F.posexplode("of").alias("w", "positive_score"))
    found = found.join(scores, ["query", "w"]).select(F.col("query").alias("rep"), "positive_score", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))

    anchors = index.asking.withColumnRenamed("id", "anchor_id").join(near.withColumnRenamed("query", "rep"), "rep").where("id <> anchor_id")
    pairs = best(anchors, ["anchor_id"], positives).select("rep", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return pairs.join(found, ["rep", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

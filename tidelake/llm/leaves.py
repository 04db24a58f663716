"""Vectors dealt into leaves of bounded size, and queries that go only to leaves they may need.

Vectors become whole numbers (``floor(scale * x)``), so scores are exact.  Equal vectors are one
row with their smallest ids, as no query can need more of them.  A small tree of cuts, fitted on
a bounded sample of what an operator derives from a vector, deals the rest to leaves; a leaf of
many vectors has several parts.  The operator says how high a query can score in a leaf, from the
lowest and highest values there, and what it does with a block of a leaf and the queries that come
to it.  Blocks stay where they are dealt and queries travel; only a leaf with more than
``QUERY_ROWS`` queries is copied, so that each copy has a bounded share of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.llm.shared import written

#: Vectors the tree is fitted on, on average (by the hash of their ids; all, if fewer).
FIT_ROWS = 20_000
#: Vectors of a block, and leaves at least and at most; the lowest and highest values of the leaves are broadcast.
BLOCK_ROWS, LEAST_LEAVES, MOST_LEAVES = 4_096, 16, 1_024
#: Queries of a block that one task takes.
QUERY_ROWS = 65_536
#: Whole numbers that a double holds exactly.
EXACT = 2.0**53


def vectors(rows: DataFrame, id_col: str, vector_col: str, kind: Column | None = None) -> DataFrame:
    """(id long, vec array<double>, kind int) of the rows that take part: with an id, the vector
    neither null nor with a null or non-finite component.  Of rows that repeat an id the one with
    the smallest vector takes part.  kind: null where ``kind`` is not given."""
    v = F.col("vec")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kind = F.lit(None) if kind is None else kind
    rows = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vec"), kind.cast("int").alias("kind"))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull() & ~bad)
    return rows.groupBy("id").agg(F.min(F.struct("vec", "kind")).alias("r")).select("id", "r.vec", "r.kind")


def matrix(vectors: pa.Array, d: int) -> np.ndarray:
    """Rows of a list column as a matrix of d columns; what a row lacks is zero."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat, size = vectors.flatten().to_numpy(zero_copy_only=False), vectors.value_lengths().to_numpy(zero_copy_only=False)
    if (size == d).all():
        return flat.reshape(len(size), d)
    out = np.zeros((len(size), d))
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def lists(x: np.ndarray) -> pa.Array:
    """A matrix as a list column."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(np.ascontiguousarray(x).ravel()))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of a with all of b, exact: in doubles where they hold them, else in whole numbers of any size."""
    if a.size and b.size and a.shape[1] * np.abs(a).max() * np.abs(b).max() >= EXACT:
        whole = lambda x: np.array([[int(v) for v in r] for r in x], dtype=object)
        return (whole(a) @ whole(b).T).astype(np.int64)  # what doesn't fit a long raises
    return a @ b.T


class Tree:
    """Cuts of single values; every row ends in one leaf."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.feature, self.cut, self.below, self.leaves = [], [], [], 0
        self._split(sample, np.arange(len(sample)), max(1, -(-len(sample) // leaves)))

    def _split(self, x: np.ndarray, rows: np.ndarray, most: int) -> int:
        at = len(self.feature)
        self.feature.append(-1), self.cut.append(0.0), self.below.append((0, 0))
        spread = x[rows].var(axis=0) if len(rows) > most and x.shape[1] else np.zeros(1)
        if not spread.max() > 0:
            self.below[at] = (self.leaves, self.leaves)
            self.leaves += 1
            return at
        f = int(spread.argmax())
        values = x[rows, f]
        cut = float(np.median(values))
        cut = cut if (values > cut).any() else float(values[values < cut].max())
        self.feature[at], self.cut[at] = f, cut
        low = self._split(x, rows[values <= cut], most)
        self.below[at] = (low, self._split(x, rows[values > cut], most))
        return at

    def leaf(self, x: np.ndarray) -> np.ndarray:
        feature, cut, below = np.array(self.feature), np.array(self.cut), np.array(self.below)
        node, rows = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
        while True:
            going = feature[node] >= 0
            if not going.any():
                return below[node, 0].astype(np.int32)
            n = node[going]
            node[going] = below[n, (x[rows[going], feature[n]] > cut[n]).astype(int)]


class Leaves:
    """Different vectors of ``rows`` (id, vec, kind) in leaves.

    scale: what components are multiplied by.  kind: rows of another kind are never
    equal (a label; null: -1).  copies: how many of the smallest ids of equal rows to keep.  is_query: over id.
    derive: matrix -> matrix of what the tree cuts and leaves are bounded by.

    ``groups``: (rep, id) with the smallest ids of equal rows, rep the smallest.
    ``asking``: (rep, id) of the rows that are queries.
    """

    def __init__(self, rows: DataFrame, scale: int, derive: Callable[[np.ndarray], np.ndarray], copies: int, is_query: Column):
        self.spark = rows.sparkSession
        vec = F.transform("vec", lambda x: F.floor(x * F.lit(float(scale))).cast("double"))
        rows = rows.withColumn("vec", vec).withColumn("kind", F.coalesce("kind", F.lit(-1))).withColumn("h", F.xxhash64("vec", "kind"))
        rows = written(rows.select("h", "id", "kind", "vec"))
        first = Window.partitionBy("h", "vec", "kind").orderBy("id")
        # of equal rows the smallest ids; ranks are cut off before the shuffle
        kept = rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= copies)
        kept = written(kept.withColumn("rep", F.first("id").over(first)).select("rep", "id", "n", "h", "kind", "vec"))
        self.groups = kept.select("rep", "id")
        of_rep = kept.where("n = 1").select("h", "vec", "kind", "rep")
        self.asking = written(rows.where(is_query).join(of_rep, ["h", "vec", "kind"]).select("rep", "id"))
        reps = kept.where("n = 1").select(F.col("rep").alias("id"), "kind", "vec")
        self.n, self.d = reps.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vec")), F.lit(0))).first()
        self.d = max(1, self.d)
        if not self.n:
            return
        share = min(1.0, FIT_ROWS / self.n)
        sampled = reps.where(F.pmod(F.xxhash64(F.lit("fit"), "id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
        sample = matrix(sampled.select("vec").toArrow().column("vec"), self.d)
        self.derive = derive
        tree = Tree(derive(sample), min(MOST_LEAVES, max(LEAST_LEAVES, self.n // BLOCK_ROWS)))
        d, shared = self.d, self.spark.sparkContext.broadcast(tree)

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = matrix(b.column("vec"), d)
                yield pa.RecordBatch.from_arrays([pa.array(shared.value.leaf(derive(x))), b.column("id"), b.column("kind"), lists(x)], names=["leaf", "id", "kind", "vec"])

        placed = written(reps.mapInArrow(place, "leaf int, id long, kind int, vec array<double>"))
        counts = {r["leaf"]: r["count"] for r in placed.groupBy("leaf").count().collect()}  # a row for each leaf
        self.parts = np.array([max(1, -(-counts.get(i, 0) // BLOCK_ROWS)) for i in range(tree.leaves)])
        of_leaf = self.spark.createDataFrame([(i, int(p)) for i, p in enumerate(self.parts)], "leaf int, parts int")
        self.placed = placed.join(F.broadcast(of_leaf), "leaf").select("leaf", F.pmod(F.xxhash64("id"), "parts").cast("int").alias("part"), "id", "kind", "vec")
        self._bound(tree.leaves)

    def _bound(self, leaves: int) -> None:
        """Lowest and highest values of each leaf, over all its vectors."""
        d, derive = self.d, self.derive

        def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, tuple] = {}
            for b in batches:
                leaf, x = b.column("leaf").to_numpy(), derive(matrix(b.column("vec"), d))
                for i in np.unique(leaf).tolist():
                    own = x[leaf == i]
                    low, high = held.get(i, (own[0], own[0]))
                    held[i] = np.minimum(low, own.min(axis=0)), np.maximum(high, own.max(axis=0))
            if held:
                low, high = (np.stack(x) for x in zip(*held.values()))
                yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), lists(low), lists(high)], names=["leaf", "low", "high"])

        def both(pdf):
            import pandas as pd

            low, high = np.stack(pdf["low"].to_numpy()).min(axis=0), np.stack(pdf["high"].to_numpy()).max(axis=0)
            return pd.DataFrame({"leaf": pdf["leaf"][:1], "low": [low], "high": [high]})

        schema = "leaf int, low array<double>, high array<double>"
        found = self.placed.select("leaf", "vec").mapInArrow(ends, schema).groupBy("leaf").applyInPandas(both, schema).collect()  # a row for each leaf
        width = len(found[0]["low"])
        self.low, self.high = np.zeros((leaves, width)), np.zeros((leaves, width))
        self.filled = np.zeros(leaves, dtype=bool)
        for r in found:
            self.low[r["leaf"]], self.high[r["leaf"]], self.filled[r["leaf"]] = r["low"], r["high"], True

    def queries(self) -> DataFrame:
        """(id, kind, vec, home) of each different vector that asks; home: the block it is in itself."""
        own = self.asking.select(F.col("rep").alias("id")).distinct()
        return self.placed.join(own, "id").select("id", "kind", "vec", F.array(F.struct("leaf", "part")).alias("blocks"))

    def reached(self, queries: DataFrame, most: Callable, floor: Column) -> DataFrame:
        """``queries`` with the blocks where they may score ``floor`` or more, by ``most(queries, low, high)``."""
        parts, low, high, filled, d = self.parts, self.low, self.high, self.filled, self.d
        box = self.spark.sparkContext.broadcast((low, high))

        @F.arrow_udf("array<struct<leaf:int,part:int>>")
        def blocks(vec: pa.Array, floor: pa.Array) -> pa.Array:
            x, least, out = matrix(vec, d), floor.to_numpy(zero_copy_only=False), []
            for at in range(0, len(x), 1_024):
                hit = (most(x[at : at + 1_024], *box.value) >= least[at : at + 1_024, None]) & filled
                for row in hit:
                    out.append([{"leaf": int(i), "part": p} for i in np.flatnonzero(row) for p in range(parts[i])])
            return pa.array(out, pa.list_(pa.struct([("leaf", pa.int32()), ("part", pa.int32())])))

        return queries.withColumn("blocks", blocks("vec", floor.cast("double")))

    def visit(self, queries: DataFrame, handle: Callable, schema: str) -> DataFrame:
        """What ``handle`` finds for the queries (id, kind, vec, blocks, told array<double>) in their blocks.

        handle(ids, kinds, vectors) -> answer(ids, kinds, vectors, told) -> columns of ``schema``.
        """
        asked = queries.select("id", "kind", "vec", "told", F.explode("blocks").alias("b")).select(F.col("b.leaf").alias("leaf"), F.col("b.part").alias("part"), "id", "kind", "vec", "told")
        n = {r["leaf"]: r["n"] for r in queries.select(F.explode("blocks.leaf").alias("leaf")).groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each leaf
        copies = self.spark.createDataFrame([(i, max(1, -(-n.get(i, 0) // (int(p) * QUERY_ROWS)))) for i, p in enumerate(self.parts) if i in n] or [(-1, 1)], "leaf int, copies int")
        held = self.placed.join(F.broadcast(copies), "leaf").select("leaf", "part", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), F.lit(0).alias("asks"), "id", "kind", "vec", F.lit(None).cast("array<double>").alias("told"))
        asked = asked.join(F.broadcast(copies), "leaf").select("leaf", "part", F.pmod(F.xxhash64("id"), "copies").cast("int").alias("copy"), F.lit(1).alias("asks"), "id", "kind", "vec", "told")
        dealt = held.unionByName(asked).repartition("leaf", "part", "copy").sortWithinPartitions("leaf", "part", "copy", "asks")
        d, names = self.d, [x.split()[0] for x in schema.split(", ")]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, rows, answer = None, [], None
            for b in batches:
                at = [b.column(c).to_numpy() for c in ("leaf", "part", "copy", "asks")]
                edges = np.flatnonzero(np.any([x[1:] != x[:-1] for x in at], axis=0)) + 1
                for s, e in zip([0, *edges.tolist()], [*edges.tolist(), len(b)]):
                    own, piece = tuple(int(x[s]) for x in at[:3]), b.slice(s, e - s)
                    what = piece.column("id").to_numpy(), piece.column("kind").to_numpy(), matrix(piece.column("vec"), d)
                    if own != key:
                        key, rows, answer = own, [], None
                    if at[3][s] == 0:
                        rows.append(what)
                        continue
                    answer = answer or handle(*(np.concatenate(x) for x in zip(*rows)))
                    told = piece.column("told")
                    for i in range(0, e - s, 256):
                        part = told.slice(i, 256)
                        found = answer(*(x[i : i + 256] for x in what), part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1))
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=names)

        return dealt.mapInArrow(run, schema)


def best(rows: DataFrame, keys: list[str], top: int, name: str = "rank") -> DataFrame:
    """The ``top`` rows of each key by score, then id, numbered from 1."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return rows.withColumn(name, F.row_number().over(order)).where(F.col(name) <= top)

"""Approximate nearest neighbours by randomly rotated one-bit codes.

Vectors are taken relative to the centre of their cell, normalised, mapped by a random
orthogonal matrix into ``CODE_BITS`` dimensions to each of theirs, and stored as the signs of
the coordinates there, packed to bytes, with two scalars: the length before normalising and
the inner product of the unit vector with its own sign vector.  From these the inner product
with a query is estimated without bias, with an error bound that holds with high probability.
Codes are made once, with the index; a block is scanned by its codes, and only vectors whose
upper bound reaches what the query has already are looked up and scored in double precision.

Cells are those of a coarse k-means fitted on a bounded sample; every vector is in one.  A query
first opens its best cells, as many as it takes for more than enough vectors: codes choose what is
scored exactly there, and the last of its best scores is its bar, which no answer is below.  With
the bar it visits the other cells whose vectors may reach it: those where the inner product with
the centre, and ``REACH`` standard deviations of the cell's spread in the query's direction, come
to that score.  In a block where many upper bounds reach the bar, those with the best estimates are
scored first and raise it.
Blocks are of bounded size: small cells that lie side by side share one, a cell with many
vectors has several.  Queries travel to the blocks; a block is copied only for each further
``QUERY_ROWS`` queries that ask for it, so copies are at most a twelfth of the queries' rows.  Each
query gets its best few of each block it visits, so what leaves the blocks is queries times blocks,
not pairs.
"""

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.llm.shared import written

TOP = 20
#: Vectors the cells are fitted on at most (those first in the order of their ids' hashes).
FIT_ROWS = 20_000
#: Vectors to a cell on average, and cells at most; what is broadcast is a row for each cell.
CELL_ROWS = 500
MOST_CELLS = 4_096
#: Standard deviations of a cell's spread within which its vectors are expected.
REACH = 3.5
#: Bits of a code for each dimension.
CODE_BITS = 2
#: Queries of a block that one task takes; they pass through it in batches.
QUERY_ROWS = 200_000
#: Vectors that a query opens before it has a bar, at least (all, if fewer).
OPEN_ROWS = 2_048
#: Where many vectors may reach a bar, so many times the wanted number are scored first.
FIRST = 8
#: Vectors of a block.
BLOCK_ROWS = 16_384
#: Standard deviations of the estimate's error within which it is trusted.
SIGMAS = 3.0
SEED = 7


def clean(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vec) of the vectors that take part: not null, not empty, no null or non-finite
    component, not all zero, with an id, and of the dimension that most of those have."""
    v = F.col("vec")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vec"))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0)).where(~bad & F.exists(v, lambda x: x != 0))
    widest = rows.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1)
    return rows.join(F.broadcast(widest.select("d")), F.size("vec") == F.col("d")).select("id", "vec")


def rotation(d: int, bits: int = CODE_BITS, seed: int = SEED) -> np.ndarray:
    """d columns of a random orthogonal matrix of ``bits`` times d rows: it keeps inner products."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits * d, bits * d)))
    return np.ascontiguousarray((q * np.sign(np.diag(r)))[:, :d])


def fit_cells(sample: np.ndarray, cells: int, rounds: int = 12, seed: int = SEED) -> np.ndarray:
    """Centres of k-means over a sample."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), cells, replace=False)]
    for _ in range(rounds):
        near = nearest_cell(sample, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        count = np.bincount(near, minlength=cells)
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    return centres


def nearest_cell(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), dtype=np.int64)
    for at in range(0, len(x), 4_096):
        part = x[at : at + 4_096]
        out[at : at + 4_096] = np.argmax(part @ centres.T - 0.5 * (centres**2).sum(axis=1), axis=1)
    return out


def encode(x: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sign bits (packed to bytes), length and correction scalar of each vector around ``centre``."""
    rest = x - centre
    length = np.linalg.norm(rest, axis=1)
    unit = np.divide(rest, length[:, None], out=np.zeros_like(rest), where=length[:, None] > 0) @ turn.T
    own = np.abs(unit).sum(axis=1) / math.sqrt(len(turn))
    return np.packbits(unit >= 0, axis=1), length, own


def estimate(query: np.ndarray, code: tuple, centre: np.ndarray, turn: np.ndarray, sigmas: float = SIGMAS) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner product of queries (rows) with the coded vectors of a cell (columns), and its error bound.

    With o the unit vector, s its sign vector over sqrt(D) and q the rotated query,
    <o, q> is about <s, q> / <o, s>, off by at most sigmas * |q| * sqrt((1 - <o,s>^2) / <o,s>^2 / (D - 1)).
    """
    bits, length, own = code
    wide = len(turn)
    own = np.maximum(own, 1e-9)
    spread = (sigmas * np.sqrt(np.maximum(1 - own**2, 0) / own**2 / max(wide - 1, 1)) * length).astype(np.float32)
    signs = np.unpackbits(bits, axis=1, count=wide).astype(np.float32) * 2 - 1
    guess = (query @ turn.T).astype(np.float32) @ signs.T
    guess *= (length / own / math.sqrt(wide)).astype(np.float32)
    guess += (query @ centre).astype(np.float32)[:, None]
    return guess, np.linalg.norm(query, axis=1).astype(np.float32)[:, None] * spread + np.float32(1e-5)


class Index:
    """What all tasks know: rotation, and each cell's centre, size, spread and blocks."""

    def __init__(self, centres: np.ndarray, turn: np.ndarray, sample: np.ndarray, top: int, reach: float = REACH):
        self.centres, self.turn, self.top, self.reach = centres, turn, top, reach
        rest = sample - centres[nearest_cell(sample, centres)]
        self.spread = rest.T @ rest / max(len(rest), 1)  # of all cells together
        if not np.trace(self.spread) > 0:
            self.spread = np.eye(len(self.spread)) / len(self.spread)
        self.counts = self.scale = self.first = self.parts = None

    def sized(self, counts: np.ndarray, radius: np.ndarray, block_rows: int):
        """With the number of vectors and the root mean square radius of each cell, and its blocks."""
        self.counts, self.scale = counts, radius / math.sqrt(float(np.trace(self.spread)))
        self.first, self.parts = pack_cells(counts, self.centres, block_rows)
        return self

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """What vectors of each cell (columns) are expected to score at most with each query (rows)."""
        spread = np.sqrt(np.maximum(np.einsum("ij,jk,ik->i", queries, self.spread, queries), 0))
        return queries @ self.centres.T + self.reach * spread[:, None] * self.scale

    def opened(self, queries: np.ndarray, lots: np.ndarray) -> tuple[np.ndarray, ...]:
        """(row, block, cell) of the best cells of each query, as many as it takes for ``OPEN_ROWS``
        vectors and more than ``top``; of a cell in several blocks one, by the query's lot."""
        order = np.argsort(-self.bounds(queries), axis=1, kind="stable")
        before = np.cumsum(self.counts[order], axis=1) - self.counts[order]
        row, at = np.nonzero((before <= max(OPEN_ROWS, 2 * self.top)) & (self.counts[order] > 0))
        cell = order[row, at]
        return row, self.first[cell] + lots[row] % self.parts[cell], cell

    def visited(self, queries: np.ndarray, bars: np.ndarray) -> tuple[np.ndarray, ...]:
        """(row, block, cell) of all cells that may hold a vector at the query's bar."""
        row, cell = np.nonzero((self.bounds(queries) >= bars[:, None]) & (self.counts > 0))
        each = self.parts[cell]
        step = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        row, cell = np.repeat(row, each), np.repeat(cell, each)
        return row, self.first[cell] + step, cell


def best_of(names: np.ndarray, ids: np.ndarray, scores: np.ndarray, top: int) -> tuple[np.ndarray, ...]:
    """The best ``top`` rows of each query, ties to the smaller id; names ascend in what comes back."""
    order = np.lexsort((ids, -scores, names))
    names, ids, scores = names[order], ids[order], scores[order]
    keep = np.arange(len(names)) - np.searchsorted(names, names) < top
    return names[keep], ids[keep], scores[keep]


def scan(query_ids: np.ndarray, queries: np.ndarray, bars: np.ndarray, asked: tuple[np.ndarray, np.ndarray], ids: np.ndarray, vectors: np.ndarray, code: tuple, cell: np.ndarray, index: Index, top: int, sigmas: float = SIGMAS) -> tuple[np.ndarray, ...]:
    """The best ``top`` of a block for each query: (query id, id, exact score), and how many of how
    many codes were looked up.  ``asked``: pairs (row of a query, cell)."""
    out, looked, seen = [], 0, 0
    bits, length, own = code
    order = np.argsort(cell, kind="stable")
    ids, vectors, bits, length, own = ids[order], vectors[order], bits[order], length[order], own[order]
    kinds, first = np.unique(cell[order], return_index=True)
    place = {c: slice(a, b) for c, a, b in zip(kinds.tolist(), first.tolist(), np.append(first[1:], len(order)).tolist())}
    for at in range(0, len(queries), 256):
        some, some_ids, bar = queries[at : at + 256], query_ids[at : at + 256], bars[at : at + 256].copy()
        mine = (asked[0] >= at) & (asked[0] < at + 256)
        row, want = asked[0][mine] - at, asked[1][mine]
        guess = np.full((len(some), len(ids)), -np.inf, dtype=np.float32)
        upper = guess.copy()
        for c in np.unique(want).tolist():
            if c in place:
                here, rows = place[c], row[want == c]
                guess[rows, here], off = estimate(some[rows], (bits[here], length[here], own[here]), index.centres[c], index.turn, sigmas)
                upper[rows, here] = guess[rows, here] + off
                seen += off.size
        same = some_ids[:, None] == ids
        guess[same] = upper[same] = -np.inf
        hit = upper >= np.maximum(bar, -1e300)[:, None]
        near = min(FIRST * top, len(ids))
        many = np.flatnonzero(hit.sum(axis=1) > 2 * near)
        if len(many) and near >= top:
            # the best estimates are scored first; the last of their best scores is a bar of its own
            best = np.argpartition(-guess[many], near - 1, axis=1)[:, :near]
            scores = np.einsum("ij,ikj->ik", some[many], vectors[best])
            scores[~np.isfinite(np.take_along_axis(guess[many], best, axis=1))] = -np.inf
            bar[many] = np.maximum(bar[many], np.partition(scores, -top, axis=1)[:, -top])
            hit[many] &= upper[many] >= bar[many][:, None]
            r, c = np.nonzero(np.isfinite(scores))
            looked += len(r)
            out.append((some_ids[many[r]], ids[best[r, c]], scores[r, c]))
            hit[many[:, None], best] = False
        row, col = np.nonzero(hit)
        looked += len(row)
        out.append((some_ids[row], ids[col], np.einsum("ij,ij->i", some[row], vectors[col])))
    if not out:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0), 0, 0
    return *best_of(*(np.concatenate(x) for x in zip(*out)), top), looked, seen


def pack_cells(counts: np.ndarray, centres: np.ndarray, block_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """First block and number of blocks of each cell: cells side by side along the centres'
    main direction share a block while they fit."""
    rest = centres - centres.mean(axis=0)
    axis = np.linalg.svd(rest, full_matrices=False)[2][0] if len(centres) > 1 else rest[0]
    first, parts = np.zeros(len(counts), dtype=np.int32), np.ones(len(counts), dtype=np.int32)
    block, held = 0, 0
    for c in np.argsort(rest @ axis, kind="stable"):
        if held and held + counts[c] > block_rows:
            block, held = block + 1, 0
        first[c], parts[c] = block, max(1, -(-int(counts[c]) // block_rows))
        held += int(counts[c])
        if parts[c] > 1:
            block, held = block + int(parts[c]), 0
    return first, parts


def search(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", top: int = TOP, sigmas: float = SIGMAS, reach: float = REACH) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``top`` largest inner products found.

    Queries are the ids for which ``is_query`` (over the column id) holds; candidates all rows but those with
    the query's own id.  Equal scores rank by the smaller id.  Vectors that are null, empty,
    zero or of another dimension than most, or hold null or non-finite components, take no
    part.  An id that repeats is one query, with its smallest vector, and a candidate for each
    row.  ``sigmas``: how far estimates are distrusted (more: fewer misses, more exact scores);
    ``reach``: how far from its centre a cell's vectors are expected (more: more cells visited).
    """
    rows = written(clean(vectors, id_col, vector_col))
    n = rows.count()
    if n == 0:
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score"))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(FIT_ROWS).toPandas()
    points = np.stack(sample["vec"].to_numpy())
    centres = fit_cells(points, min(MOST_CELLS, max(1, n // CELL_ROWS), len(points)))
    index = Index(centres, rotation(points.shape[1]), points, top, reach)
    session = vectors.sparkSession.sparkContext
    coarse = session.broadcast((centres, index.turn))

    @F.pandas_udf("cell int, code binary, length double, own double, square double")
    def coded(vecs: pd.Series) -> pd.DataFrame:
        c, turn = coarse.value
        if not len(vecs):
            return pd.DataFrame({"cell": pd.Series(dtype="int32"), "code": pd.Series(dtype=object), "length": pd.Series(dtype=float), "own": pd.Series(dtype=float), "square": pd.Series(dtype=float)})
        x = np.stack(vecs.to_numpy())
        cell = nearest_cell(x, c)
        bits, length, own = encode(x, c[cell], turn)
        return pd.DataFrame({"cell": cell.astype(np.int32), "code": [b.tobytes() for b in bits], "length": length, "own": own, "square": length**2})

    placed = written(rows.withColumn("k", coded("vec")).select("k.*", "id", "vec"))
    counts, radius = np.zeros(len(centres), dtype=np.int64), np.zeros(len(centres))
    for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.avg("square").alias("r")).collect():  # a row for each cell
        counts[r["cell"]], radius[r["cell"]] = r["n"], math.sqrt(r["r"])
    shared = session.broadcast(index.sized(counts, radius, BLOCK_ROWS))
    first, parts = session.broadcast(index.first), session.broadcast(index.parts)

    @F.pandas_udf("int")
    def block_of(cell: pd.Series, lot: pd.Series) -> pd.Series:
        c = cell.to_numpy()
        return pd.Series(first.value[c] + lot.to_numpy() % parts.value[c], dtype="int32")

    indexed = placed.select(block_of("cell", _lot("id")).alias("block"), F.lit(1).alias("kind"), "id", "vec", F.array("cell").alias("cells"), "code", "length", "own")
    queries = placed.where(is_query).groupBy("id").agg(F.min("vec").alias("vec"))
    opened = written(_scanned(indexed, queries.withColumn("bar", F.lit(float("-inf"))), False, shared, top, sigmas))
    # an answer is at least as good as the last of enough others
    bars = opened.groupBy("query_id").agg(F.slice(F.sort_array(F.collect_list("score"), asc=False), top, 1).alias("last"))
    bar = F.coalesce(F.get("last", F.lit(0)), F.lit(float("-inf"))).alias("bar")
    asked = written(queries.join(bars.withColumnRenamed("query_id", "id"), "id", "left").select("id", "vec", bar))
    best = opened.union(_scanned(indexed, asked, True, shared, top, sigmas))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def _lot(name: str) -> Column:
    """By which a row of a cell in several blocks belongs to one of them."""
    return F.pmod(F.xxhash64(name), F.lit(1 << 20))


def _scanned(indexed: DataFrame, queries: DataFrame, rest: bool, shared, top: int, sigmas: float) -> DataFrame:
    """(query_id, vec_id, score): the best of each block for each of ``queries`` (id, vec, bar) that
    asks for it: for the cells it opens, or, with ``rest``, for all others that may reach its bar."""
    lots = queries.select("id", "vec", "bar", _lot("id").alias("lot"))
    asks = lots.mapInArrow(_asker(shared, rest), "block int, id long, vec array<double>, cells array<int>, bar double")
    few = lots.mapInArrow(_asker(shared, rest, count=True), "block int, n long").groupBy("block").agg(F.ceil(F.sum("n") / QUERY_ROWS).cast("int").alias("lots"))
    hot = written(few.where("lots > 1"))
    copies = F.coalesce("lots", F.lit(1))
    vectors = indexed.join(hot, "block", "left").withColumn("lot", F.explode(F.sequence(F.lit(0), copies - 1))).drop("lots")
    asks = asks.join(hot, "block", "left").select(
        "block", F.lit(0).alias("kind"), "id", "vec", "cells", F.lit(None).cast("binary").alias("code"), F.col("bar").alias("length"), F.lit(None).cast("double").alias("own"),
        F.pmod(F.xxhash64(F.lit("lot"), "id"), copies).cast("int").alias("lot"),
    )
    dealt = vectors.unionByName(asks).select("block", "lot", "kind", "cells", "id", "vec", "code", "length", "own")
    dealt = dealt.repartition("block", "lot").sortWithinPartitions("block", "lot", F.desc("kind"), "id")
    return dealt.mapInArrow(_searcher(shared, top, sigmas), "query_id long, vec_id long, score double")


def _asker(shared, rest: bool, count: bool = False):
    """Which blocks queries ask for, and for which of their cells; or how many queries ask for each block."""

    def asks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            if not len(batch):
                continue
            x = batch.column(1).flatten().to_numpy().reshape(len(batch), -1)
            row, block, cell = index.opened(x, batch.column(3).to_numpy())
            if rest:
                place = lambda r, b, c: (r.astype(np.int64) << 46) | (b.astype(np.int64) << 13) | c
                done = place(row, block, cell)
                row, block, cell = index.visited(x, batch.column(2).to_numpy())
                new = ~np.isin(place(row, block, cell), done)
                row, block, cell = row[new], block[new], cell[new]
            order = np.lexsort((cell, block, row))
            row, block, cell = row[order], block[order], cell[order]
            start = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (block[1:] != block[:-1]))) if len(row) else np.zeros(0, dtype=np.int64)
            if count:
                blocks, n = np.unique(block[start], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array(n, pa.int64())], names=["block", "n"])
                continue
            for at in range(0, len(start), 10_000):
                some = start[at : at + 10_000]
                end = start[at + 10_000] if at + 10_000 < len(start) else len(row)
                cells = pa.ListArray.from_arrays(pa.array(np.append(some, end) - some[0], pa.int32()), pa.array(cell[some[0] : end], pa.int32()))
                of = pa.array(row[some])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block[some], pa.int32()), batch.column(0).take(of), batch.column(1).take(of), cells, batch.column(2).take(of)], names=["block", "id", "vec", "cells", "bar"]
                )

    return asks


def _searcher(shared, top: int, sigmas: float):
    """Scans blocks: rows come with a block's vectors first, then the queries that ask for it (whose
    bar stands in the column length)."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        key, held, ready = None, [], None
        for batch in batches:
            block, lot, kind = (batch.column(i).to_numpy() for i in range(3))
            ids, lengths = batch.column(4).to_numpy(), batch.column(7).to_numpy(zero_copy_only=False)
            vecs = batch.column(5).flatten().to_numpy().reshape(len(batch), -1)
            edges = np.flatnonzero((block[1:] != block[:-1]) | (lot[1:] != lot[:-1]) | (kind[1:] != kind[:-1])) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(batch)]):
                if key != (block[a], lot[a]):
                    key, held, ready = (block[a], lot[a]), [], None
                piece = batch.slice(a, b - a)
                cells = piece.column(3).flatten().to_numpy().astype(np.int64)
                if kind[a] == 1:
                    bits = np.frombuffer(b"".join(piece.column(6).to_pylist()), dtype=np.uint8).reshape(b - a, -1)
                    held.append((ids[a:b], vecs[a:b], bits, lengths[a:b], piece.column(8).to_numpy(zero_copy_only=False), cells))
                elif held:
                    if ready is None:
                        own_ids, own, bits, length, scalar, own_cells = (np.concatenate(x) for x in zip(*held))
                        ready = (own_ids, own, (bits, length, scalar), own_cells)
                    each = piece.column(3).value_lengths().to_numpy()
                    found = scan(ids[a:b], vecs[a:b], lengths[a:b], (np.repeat(np.arange(b - a), each), cells), *ready, index, top, sigmas)[:3]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["query_id", "vec_id", "score"])

    return blocks

"""The prefix trie of conversations, as a Z-fast trie.

A conversation is the sequence of its turns.  All prefixes have a hash of 128 bits, a sum over the
turns so far of a hash of position, role and text; equal conversations are one string.  The trie
is compacted: an edge stands for a run of turns without a branch.  Every compacted node is held
under its handle, the hash of its prefix at the two-fattest depth of its edge (the depth there
that the highest power of two divides).  A string finds where it leaves the trie by fat binary
search: at most about log2(depth) handles are looked up, then the turns of one edge.

Strings are inserted in batches.  All strings that wait at the same gap, a branch of the trie that
has no node yet, go to the same tasks.  About ``BATCH`` of them, taken by hash, are inserted; the
others only look for their exit, at most ``SEEKERS`` to a task, each task with the same batch.
What they find are points where edges split and new gaps, where they wait for the next batch.  As
batches are random, gaps shrink by about ``BATCH`` each time: 10^9 strings take three or four rounds.

So an edge belongs to the string that opened it, and all splits found on it cut it into compacted
nodes.  What nodes sum over their subtrees comes by doubling: in round k a node adds what those
2^k below it have, so the number of rounds is the logarithm of the compacted trie's height.  Edges
are expanded to a node for each turn last, as all turns of an edge share their members.

Hashes stand for turns and prefixes throughout (128 bits: for n prefixes a chance of about n^2 / 10^39
that any two are taken for one).  A conversation's hashes, 24 bytes for each turn, are one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelake.llm.shared import Scratch, written

#: Strings of a gap that are inserted at once, on average, and strings that look for their exit in one task.
BATCH, SEEKERS = 1_024, 8_192
#: Ids of one end that are joined to a text before they are sorted together (by the id's quotient).
ID_RUN = 8_192


def turns_of(rows: DataFrame) -> DataFrame:
    """(conv_id, turns array<struct<a long, b long, size long>>) of turns (conv_id, turn, role, text).

    In order of turn, null first; equal turn numbers in order of their hashes.  Null role and text
    are empty; rows without conv_id are no conversation's.  size: UTF-8 bytes of the text.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    turn = F.struct(F.col("turn").cast("long").alias("turn"), *[F.xxhash64(F.lit(n), role, text).alias(n) for n in ("a", "b")], F.octet_length(text).cast("long").alias("size"))
    found = rows.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    in_order = F.sort_array(F.collect_list("t"))
    return found.groupBy("conv_id").agg(F.transform(in_order, lambda t: F.struct(t.a.alias("a"), t.b.alias("b"), t.size.alias("size"))).alias("turns"))


def _scramble(x: np.ndarray, at: np.ndarray, odd: int) -> np.ndarray:
    """A hash of a turn's hash and its position."""
    x = (x.view(np.uint64) + at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(odd)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def prefixes(turns: DataFrame) -> DataFrame:
    """(id, n, end_a, end_b, a, b, sizes): arrays of the hashes of all prefixes and of the bytes in them."""
    schema = "id long, n int, end_a long, end_b long, a array<long>, b array<long>, sizes array<long>"

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns = batch.column("turns")
            n, flat = turns.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64), turns.flatten()
            start = np.cumsum(n) - n
            at = np.arange(len(flat)) - np.repeat(start, n)
            ends = pa.array(np.append(start, len(flat)).astype(np.int32))

            def sums(x):
                total = np.cumsum(np.append(x.dtype.type(0), x))
                upto = (total[1:] - np.repeat(total[start], n)).view(np.int64)
                last = np.where(n > 0, np.append(upto, 0)[np.maximum(start + n - 1, 0)], 0)
                return pa.array(last), pa.ListArray.from_arrays(ends, pa.array(upto))

            column = lambda c: pc.struct_field(flat, c).to_numpy(zero_copy_only=False)
            end_a, a = sums(_scramble(column("a"), at, 0xBF58476D1CE4E5B9))
            end_b, b = sums(_scramble(column("b"), at, 0x94D049BB133111EB))
            sizes = sums(column("size"))[1]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(n.astype(np.int32)), end_a, end_b, a, b, sizes], names=[x.split()[0] for x in schema.split(", ")])

    return turns.mapInArrow(made, schema)


# --- the trie of a gap's batch ----------------------------------------------------------


def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] that the highest power of two divides."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


class String:
    """One string: its id, its length and the hashes of its prefixes."""

    __slots__ = ("id", "n", "a", "b", "sizes")

    def __init__(self, id: int, n: int, a: np.ndarray, b: np.ndarray, sizes: np.ndarray):
        self.id, self.n, self.a, self.b, self.sizes = id, n, a, b, sizes

    def at(self, depth: int) -> tuple[int, int]:
        """Hash of the prefix of ``depth`` turns."""
        return (int(self.a[depth - 1]), int(self.b[depth - 1])) if depth else (0, 0)

    def size(self, depth: int) -> int:
        return int(self.sizes[depth - 1]) if depth else 0


class Node:
    """A compacted node: the turns low + 1 to high of the string that opened its edge."""

    __slots__ = ("owner", "low", "high")

    def __init__(self, owner: String, low: int, high: int):
        self.owner, self.low, self.high = owner, low, high


class ZFastTrie:
    """Strings that share their first ``base`` turns."""

    def __init__(self, base: int):
        self.base = base
        self.handles: dict[tuple[int, int], Node] = {}
        self.first: dict[tuple[int, int], Node] = {}  # by the hash of the first turn of the edge

    def _hold(self, node: Node) -> None:
        self.handles[node.owner.at(two_fattest(node.low, node.high))] = node
        self.first[node.owner.at(node.low + 1)] = node

    def exit(self, x: String) -> tuple[Node | None, int]:
        """The node on whose edge ``x`` leaves the trie, and the number of turns they share."""
        low, high, node = self.base, x.n, None
        while low < high:  # fat binary search
            f = two_fattest(low, high)
            found = self.handles.get(x.at(f))
            if found is None:
                high = f - 1
            else:
                node, low = found, found.high
        upto = self.base
        if node is not None:
            upto = self._shared(x, node)
            if upto < node.high:
                return node, upto
        below = self.first.get(x.at(upto + 1)) if upto < x.n else None
        return (below, self._shared(x, below)) if below is not None else (node, upto)

    @staticmethod
    def _shared(x: String, node: Node) -> int:
        low, high = node.low, min(x.n, node.high)
        while low < high:
            mid = two_fattest(low, high)
            if x.at(mid) == node.owner.at(mid):
                low = mid
            else:
                high = mid - 1
        return low

    def insert(self, x: String) -> tuple[Node | None, int]:
        """Adds ``x``; gives its exit before."""
        node, at = self.exit(x)
        if node is not None and at < node.high:
            del self.handles[node.owner.at(two_fattest(node.low, node.high))]
            self._hold(Node(node.owner, node.low, at))
            self._hold(Node(node.owner, at, node.high))
        if at < x.n:
            self._hold(Node(x, at, x.n))
        return node, at


_FOUND = "kind int, id long, depth int, a long, b long, size long, gap_a long, gap_b long"
_EDGE, _SPLIT, _WAITS = 0, 1, 2


def _insert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Works off gaps: rows (gap_a, gap_b, part, seeks, base, id, n, a, b, sizes) in that order."""
    key, trie = None, None
    for batch in batches:
        out: list[tuple] = []
        gap_a, gap_b, part, seeks, base, ids, n = (batch.column(i).to_numpy().tolist() for i in range(7))
        ends = batch.column("a").offsets.to_numpy().tolist()
        a, b, sizes = (batch.column(c).values.to_numpy() for c in ("a", "b", "sizes"))
        for i in range(len(batch)):
            own = gap_a[i], gap_b[i], part[i]
            if own != key:
                key, trie = own, ZFastTrie(base[i])
            s, e = ends[i], ends[i + 1]
            x = String(ids[i], n[i], a[s:e], b[s:e], sizes[s:e])
            node, at = trie.exit(x) if seeks[i] else trie.insert(x)
            if not seeks[i] and part[i]:
                continue  # the first part tells what the batch did
            if node is not None and at > base[i]:
                out.append((_SPLIT, node.owner.id, at, *x.at(at), x.size(at), 0, 0))
            if at < x.n:
                out.append((_WAITS, x.id, at, *x.at(at), x.size(at), *x.at(at + 1)) if seeks[i] else (_EDGE, x.id, at, *x.at(at), x.size(at), 0, 0))
        if trie is not None:  # strings of the batch outlive the Arrow batch
            for node in trie.handles.values():
                o = node.owner
                if o.a.base is not None:
                    o.a, o.b, o.sizes = o.a.copy(), o.b.copy(), o.sizes.copy()
        kinds = [pa.int32(), pa.int64(), pa.int32(), *[pa.int64()] * 5]
        names = [c.split()[0] for c in _FOUND.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 8, kinds)], names=names)


def edges_and_splits(strings: DataFrame, batch: int = BATCH, seekers: int = SEEKERS) -> DataFrame:
    """(kind, id, depth, a, b, size): the edges that strings open (kind 0: where they begin) and the
    points at which edges split (kind 1), of different, non-empty strings as ``prefixes`` has them."""
    waiting = strings.select("id", F.lit(0).alias("base"), F.lit(0).cast("long").alias("gap_a"), F.lit(0).cast("long").alias("gap_b"))
    found = None
    while True:
        gaps = waiting.groupBy("gap_a", "gap_b").agg(F.count(F.lit(1)).alias("all"), F.min("id").alias("least"))
        lot = F.pmod(F.xxhash64(F.lit("batch"), "id"), F.lit(1 << 30))
        goes = (F.col("all") <= batch) | (F.col("id") == F.col("least")) | (lot * F.col("all") < F.lit(batch << 30))
        parts = F.ceil(F.col("all") / seekers).cast("int")
        dealt = waiting.join(gaps, ["gap_a", "gap_b"]).withColumn("seeks", F.when(goes, 0).otherwise(1)).withColumn("parts", parts)
        own = F.pmod(F.xxhash64("id"), "parts").cast("int")
        dealt = dealt.withColumn("part", F.explode(F.when(F.col("seeks") == 0, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(own))))
        dealt = dealt.join(strings, "id").select("gap_a", "gap_b", "part", "seeks", "base", "id", "n", "a", "b", "sizes")
        dealt = dealt.repartition("gap_a", "gap_b", "part").sortWithinPartitions("gap_a", "gap_b", "part", "seeks", "id")
        new = written(dealt.mapInArrow(_insert, _FOUND))
        told = new.where(F.col("kind") != _WAITS)
        found = told if found is None else found.union(told)
        left = new.where(F.col("kind") == _WAITS)
        if left.isEmpty():
            return found.select("kind", "id", "depth", "a", "b", "size").distinct()
        waiting = left.select("id", F.col("depth").alias("base"), "gap_a", "gap_b")


# --- nodes ------------------------------------------------------------------------------


def compacted(strings: DataFrame, found: DataFrame) -> DataFrame:
    """(a, b, owner, low, high, up_a, up_b, low_size, high_size) of every compacted node but the root:
    the points on each edge, one after the other."""
    ends = strings.select("id", F.col("n").alias("depth"), F.col("end_a").alias("a"), F.col("end_b").alias("b"), F.element_at("sizes", -1).alias("size"))
    points = found.select("id", "depth", "a", "b", "size").union(ends.join(found.where(F.col("kind") == _EDGE).select("id"), "id", "left_semi")).distinct()
    before = Window.partitionBy("id").orderBy("depth")
    rows = points.withColumn("up", F.lag(F.struct("depth", "a", "b", "size")).over(before)).where("up is not null")
    return rows.select("a", "b", F.col("id").alias("owner"), F.col("up.depth").alias("low"), F.col("depth").alias("high"), F.col("up.a").alias("up_a"), F.col("up.b").alias("up_b"), F.col("up.size").alias("low_size"), F.col("size").alias("high_size"))


def subtree_sums(nodes: DataFrame) -> DataFrame:
    """``nodes`` (a, b, up_a, up_b, ends, first, walked, edge, leaf; up 0, 0: the root) with these
    five over each node's whole subtree: sums, and the least ``first``."""
    spark = nodes.sparkSession
    sums = lambda: [*[F.sum(c).alias(f"+{c}") for c in ("ends", "walked", "edge", "leaf")], F.min("first").alias("+first")]
    held, state = Scratch(spark), nodes.select("a", "b", "up_a", "up_b", "ends", "first", "walked", "edge", "leaf")
    state = held.written(state)
    going = (F.col("up_a") != 0) | (F.col("up_b") != 0)
    while not state.where(going).isEmpty():
        more = state.where(going).groupBy(F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(*sums())
        further = state.where(going).select(F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("up_a").alias("next_a"), F.col("up_b").alias("next_b"))
        plus = [(F.col(c) + F.coalesce(f"`+{c}`", F.lit(0))).alias(c) for c in ("ends", "walked", "edge", "leaf")]
        joined = state.join(more, ["a", "b"], "left").join(further, ["up_a", "up_b"], "left")
        new = Scratch(spark)
        state = new.written(joined.select("a", "b", F.coalesce("next_a", F.lit(0)).alias("up_a"), F.coalesce("next_b", F.lit(0)).alias("up_b"), *plus, F.least("first", "`+first`").alias("first")))
        held.drop()
        held = new
    return state.select("a", "b", "ends", "first", "walked", "edge", "leaf")


def digests(convs: DataFrame) -> DataFrame:
    """(a, b, sha): SHA-256 of the ids that end at each prefix, ascending, joined by commas.  Runs of
    ids are joined first; a group's runs then pass through one hash, in order and never together."""
    runs = convs.groupBy(F.col("end_a").alias("a"), F.col("end_b").alias("b"), F.floor(F.col("id") / ID_RUN).alias("run")).agg(F.concat_ws(",", F.transform(F.sort_array(F.collect_list("id")), lambda i: i.cast("string"))).alias("ids"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, out = None, None, []
        for batch in batches:
            for a, b, ids in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("ids").to_pylist()):
                if (a, b) == key:
                    digest.update(b"," + ids.encode())
                    continue
                if key:
                    out.append((*key, digest.hexdigest()))
                key, digest = (a, b), hashlib.sha256(ids.encode())
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["a", "b", "sha"])
                out = []
        if key:
            out.append((*key, digest.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["a", "b", "sha"])

    return runs.repartition("a", "b").sortWithinPartitions("a", "b", "run").select("a", "b", "ids").mapInArrow(hashed, "a long, b long, sha string")


def nodes(turns: DataFrame, batch: int = BATCH, seekers: int = SEEKERS) -> DataFrame:
    """Every node of the trie of ``turns`` (conv_id, turns), the root included.

    Returns (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256): conv_id is the smallest member; saved_tokens the bytes that all but one member
    of every node of the subtree need not store again; ends_sha256 of the ids that end there.
    Conversations without turns are members of the root alone.  No conversations: no rows.
    """
    convs = written(prefixes(turns))
    ends = written(convs.groupBy(F.col("end_a").alias("a"), F.col("end_b").alias("b")).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("ends")))
    strings = written(convs.where("n > 0").join(ends.select(F.col("first").alias("id")), "id", "left_semi"))
    found = edges_and_splits(strings, batch, seekers)
    flat = written(compacted(strings, written(found)))
    kids = written(flat.groupBy(F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(F.count(F.lit(1)).alias("kids")))
    rows = flat.join(ends.select("a", "b", "first", "ends"), ["a", "b"], "left").join(kids, ["a", "b"], "left").select(
        *flat.columns, "first", F.coalesce("ends", F.lit(0)).alias("ends"), (F.coalesce("ends", F.lit(0)) * F.col("high_size")).alias("walked"),
        (F.col("high_size") - F.col("low_size")).alias("edge"), F.when(F.col("kids").isNull(), 1).otherwise(0).cast("long").alias("leaf"), F.coalesce("kids", F.lit(0)).alias("kids"),
    )
    rows = written(rows)
    sums = written(subtree_sums(rows))
    sha = digests(convs)
    nobody = F.lit(hashlib.sha256(b"").hexdigest())

    total = rows.agg(F.coalesce(F.sum("walked"), F.lit(0)).alias("walked"), F.coalesce(F.sum("edge"), F.lit(0)).alias("edge"), F.greatest(F.coalesce(F.sum("leaf"), F.lit(0)), F.lit(1)).alias("leaf"))
    whole = ends.agg(F.min("first").alias("conv_id"), F.sum("ends").alias("n_convs")).where("conv_id is not null")
    zero = F.lit(0).cast("long")
    root = whole.crossJoin(total).select("*", zero.alias("a"), zero.alias("b")).join(kids, ["a", "b"], "left").join(sha, ["a", "b"], "left")  # one row each
    root = root.select("conv_id", zero.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", F.coalesce("kids", zero).alias("n_children"), F.col("leaf").alias("n_leaves"), (F.col("walked") - F.col("edge")).alias("saved_tokens"), F.coalesce("sha", nobody).alias("ends_sha256"))

    known = rows.select("a", "b", "owner", "low", "high", "up_a", "up_b", "low_size", "kids").join(sums, ["a", "b"]).join(sha, ["a", "b"], "left")
    above = sums.select(F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("first").alias("up_first")).unionByName(whole.select(zero.alias("up_a"), zero.alias("up_b"), F.col("conv_id").alias("up_first")))
    known = known.join(above, ["up_a", "up_b"]).join(strings.select(F.col("id").alias("owner"), "sizes"), "owner")
    steps = F.transform(F.slice(F.concat(F.array(zero), "sizes"), F.col("low") + 1, F.col("high") - F.col("low")), lambda s, i: F.struct((i + F.col("low") + 1).cast("long").alias("depth"), s.alias("above")))
    known = known.select("first", "ends", "leaf", "walked", "edge", "kids", "sha", "low", "high", "low_size", "up_first", F.explode(steps).alias("s")).select("*", "s.depth", "s.above")
    saved = F.col("walked") - F.col("ends") * F.col("above") - (F.col("edge") - (F.col("above") - F.col("low_size")))
    last = F.col("depth") == F.col("high")
    expanded = known.select(
        F.col("first").alias("conv_id"), "depth", F.when(F.col("depth") == F.col("low") + 1, F.col("up_first")).otherwise(F.col("first")).alias("parent_conv_id"), F.col("ends").alias("n_convs"),
        F.when(last, F.col("kids")).otherwise(1).cast("long").alias("n_children"), F.col("leaf").alias("n_leaves"), saved.alias("saved_tokens"), F.when(last, F.coalesce("sha", nobody)).otherwise(nobody).alias("ends_sha256"),
    )
    return expanded.unionByName(root)

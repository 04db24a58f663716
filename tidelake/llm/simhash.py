"""Near-duplicates by SimHash, linked through Gray-order hierarchical indexes.

Fingerprints are made per text (64 majority bits over hashed word shingles).  Two
fingerprints within ``max_bits`` differing bits are linked.  To find the links without a
cross join, the 64 bits are cut into blocks so that linked fingerprints must agree on all
bits of at least one choice of blocks; that choice and those bits are the shuffle key.
Inside a key the fingerprints stand in Gray-code order, where neighbours share most bits.
Sixteen neighbours at a time form a node that keeps the bits all of them share (mask and
pattern), sixteen nodes form an upper node, and so on.  Pairs of nodes are visited from the
top; the differing bits of two nodes' shared patterns are a lower bound for every pair below
them, so a pair of whole groups is dropped as soon as that bound exceeds ``max_bits``.

A key with more than ``KEY_ROWS`` fingerprints is dealt over several tasks: its members are
salted, and every pair of salts becomes a group of its own, so that no task holds more than
about twice that many and still every pair meets.  Only a spanning forest of each group's
links leaves the task, never all pairs.

``keep_one`` may judge by similarity instead, the Jaccard similarity of the sets of shingles.  Then
further fingerprints are made of other hashes of the same shingles.  Each has the keys of the index;
how many there are grows with the table, as keys must be cut finer there, so that a pair of
similarity 0.8 meets with a chance of at least 0.93 at every size (``KEYED``).  Pairs that meet and
differ in at most ``WIDE_BITS`` of the first four fingerprints' 256 bits are candidates; of these a
few edge-disjoint forests of each key leave the task, near pairs first (``FORESTS``).  The shingle
sets of a candidate's texts are then compared, and only pairs that are similar enough become links.
Candidates that no forest took lie inside sets of the last forest.  Where such a set is not one group by
the links found, its texts meet once more, in blocks whose pairs are judged inside a task (``rest_links``),
so every link that the forests left out is found.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.llm.shared import connected_components, numbered, written

MAX_BITS = 4
SHINGLE = 4
SEED = 42
#: Fingerprints of one key that one task takes before the key is salted.
KEY_ROWS = 32_768
#: Members of a node of the index.
FANOUT = 16
#: Node pairs that are opened at a time: each has up to FANOUT^2 pairs of codes, about 100 bytes a pair while they are judged.
OPENED = 2_048
#: Mean number of fingerprints of a key at which the bits are cut more finely.
MEAN_KEY = 64
#: The four fingerprints by which candidates are judged.
WIDE = ["fp", "more1", "more2", "more3"]
#: Differing bits of those four up to which texts are candidates: sets of a Jaccard similarity of
#: 0.8 differ in 38 of 256 bits on average and in more than 52 with a chance of 0.005.
WIDE_BITS = 52
#: Differing bits of the key's own fingerprint up to which they are looked at; as above 9, and over 24 with a chance below 1e-6.
OWN_BITS = 24
#: Fingerprints that have keys, by the number of blocks: pairs of similarity 0.8 meet with a chance
#: of 0.93, 0.94, 0.93 and 0.92, computed for independent bits.
KEYED = {5: 4, 6: 8, 7: 12, 8: 16}
#: As MEAN_KEY, where candidates are judged by similarity.
MEAN_WIDE_KEY = 1_024
#: Candidates of a key: so many forests, none with an edge of another, each taken in these steps of
#: differing bits.  What is behind them is asked for where it may still link two groups.
FORESTS, STEPS = 3, (20, 32, 42, WIDE_BITS)
#: Shingles of a block of texts that is held against another one, and what a text counts beside its own.
BLOCK_WORDS, TEXT_WORDS = 1 << 20, 32
#: 64-bit words of a set's sketch, how many of them are looked at first, and pairs that are judged at a time.
SKETCH, SKETCH_FIRST, JUDGED = 16, 4, 1 << 20


# --- fingerprints -----------------------------------------------------------------------


def shingle_hashes(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """A hash for each shingle of one UTF-8 text; none for null and for texts without words."""
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, dtype="<u8")
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(len(words) - shingle + 1, 1)
    pairs = zip(starts[:last].tolist(), ends[min(shingle, len(words)) - 1 :].tolist())
    return np.array([xxhash.xxh64_intdigest(line[s:e], seed) for s, e in pairs], dtype="<u8")


def majority(hashes: np.ndarray) -> int:
    """64 bits, signed: those set in over half the hashes."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<i8")[0])


def simhash(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit fingerprint, signed, of one UTF-8 text; 0 for null and for texts without words."""
    return majority(shingle_hashes(text, shingle, seed))


def second_hashes(hashes: np.ndarray) -> np.ndarray:
    """Other hashes of the same shingles, by multiplying and shifting."""
    mixed = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)


def wide_names(n: int) -> list[str]:
    """The columns of n fingerprints of a text; the first four are those of WIDE."""
    return ["fp", *[f"more{i}" for i in range(1, n)]]


def wide_simhash(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED, n: int = len(WIDE)) -> list[int]:
    """n fingerprints of one text, each of other hashes made of those before."""
    hashes, out = shingle_hashes(text, shingle, seed), []
    for _ in range(n):
        out.append(majority(hashes))
        hashes = second_hashes(hashes)
    return out


def fingerprints(docs: DataFrame, text: Column, name: str = "fp", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``docs`` with a further long column ``name``: the fingerprint of ``text``."""

    @F.pandas_udf("long")
    def of(texts):
        import pandas as pd

        return pd.Series([simhash(t, shingle, seed) for t in texts], dtype="int64")

    return docs.withColumn(name, of(text.cast("binary")))


def wide_fingerprints(docs: DataFrame, text: Column, shingle: int = SHINGLE, seed: int = SEED, n: int = len(WIDE)) -> DataFrame:
    """``docs`` with n further long columns: fp as above, and fingerprints of other hashes."""
    names = wide_names(n)

    @F.pandas_udf(", ".join(f"{c} long" for c in names))
    def of(texts):
        import pandas as pd

        return pd.DataFrame([wide_simhash(t, shingle, seed, n) for t in texts], columns=names, dtype="int64")

    return docs.withColumn("wide", of(text.cast("binary"))).select(*docs.columns, "wide.*")


def shingle_sets(docs: DataFrame, text: Column, name: str = "set", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``docs`` with a further column ``name``: the different hashes of a text's shingles, ascending."""

    @F.pandas_udf("array<long>")
    def of(texts):
        import pandas as pd

        return pd.Series([np.unique(shingle_hashes(t, shingle, seed).view("<i8")) for t in texts], dtype=object)

    return docs.withColumn(name, of(text.cast("binary")))


def hex16(fp: Column) -> Column:
    """A fingerprint as 16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# --- the index --------------------------------------------------------------------------


def gray_rank(fp: Column) -> Column:
    """Position of a code in the reflected Gray sequence, as a long that sorts like it."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp.bitwiseXOR(F.lit(-(2**63)))


def _runs(n: int, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last+1 child of each node, FANOUT consecutive children of one key to a node.
    ``starts``: first child of each key.  Also returns the first node of each key."""
    sizes = np.diff(np.append(starts, n))
    nodes = -(-sizes // FANOUT)
    key_of = np.repeat(np.arange(len(starts)), nodes)
    first_node = np.cumsum(nodes) - nodes
    first = starts[key_of] + (np.arange(nodes.sum()) - first_node[key_of]) * FANOUT
    return first, first_node


def _join_labels(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unite the sets of a[i] and b[i] in place; afterwards parent points at each set's root."""
    while len(a):
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent[:] = up


def _span(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Unites the sets of a[i] and b[i] in place and tells which pairs did it: a forest."""
    taken, open_ = np.zeros(len(a), dtype=bool), np.arange(len(a))
    while True:
        ra, rb = parent[a[open_]], parent[b[open_]]
        apart = ra != rb
        open_, ra, rb = open_[apart], ra[apart], rb[apart]
        if not len(open_):
            return taken
        # each larger root hooks once, by its first pair
        hooked, first = np.unique(np.maximum(ra, rb), return_index=True)
        taken[open_[first]] = True
        parent[hooked] = np.minimum(ra, rb)[first]
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent[:] = up


def _visit(keys: np.ndarray, codes: np.ndarray, max_bits: int, root: np.ndarray, found) -> None:
    """Gives ``found`` all pairs of codes of a key that groups of up to ``max_bits`` differing bits
    leave, but for those of nodes whose members ``root`` has in one set already."""
    n = len(codes)
    starts = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1))
    # levels[j]: first child of each node, end of the children, shared bits, their mask, first node of each key
    levels, both, either = [], codes, codes
    while True:
        first, key_first = _runs(len(both), starts)
        both, either = np.bitwise_and.reduceat(both, first), np.bitwise_or.reduceat(either, first)
        end = np.append(first[1:], len(levels[-1][0]) if levels else n)
        levels.append((first, end, both, ~(both ^ either)))
        if len(key_first) == len(first):
            break
        starts = key_first
    top = np.arange(len(levels[-1][0]))
    work = [(len(levels) - 1, top, top)]
    while work:
        level, a, b = work.pop()
        if len(a) > OPENED:
            work.append((level, a[OPENED:], b[OPENED:]))
            a, b = a[:OPENED], b[:OPENED]
        first, end, _, _ = levels[level]
        if level == 0:
            # a pair of nodes whose members are all linked already has nothing to add
            low, high = np.minimum.reduceat(root, first), np.maximum.reduceat(root, first)
            todo = ~((low[a] == high[b]) & (high[a] == low[b]))
            a, b = a[todo], b[todo]
        na, nb = end[a] - first[a], end[b] - first[b]
        each = na * nb
        pair = np.repeat(np.arange(len(a)), each)
        k = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        ca, cb = first[a][pair] + k // nb[pair], first[b][pair] + k % nb[pair]
        if level == 0:
            found(ca[ca < cb], cb[ca < cb])
            continue
        _, _, shared, mask = levels[level - 1]
        keep = (ca <= cb) & (np.bitwise_count((shared[ca] ^ shared[cb]) & mask[ca] & mask[cb]) <= max_bits)
        if keep.any():
            work.append((level - 1, ca[keep], cb[keep]))


def gray_links(keys: np.ndarray, codes: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """For each code the smallest index linked to it, through any number of links, inside its key.

    keys: a number for each code, equal ones together.  codes: uint64, in Gray order in a key.
    """
    root = np.arange(len(codes))
    if len(codes) < 2:
        return root
    near = lambda a, b: np.bitwise_count(codes[a] ^ codes[b]) <= max_bits
    at = np.flatnonzero(keys[1:] == keys[:-1])
    at = at[near(at, at + 1)]
    _join_labels(root, at, at + 1)

    def found(a, b):
        hit = near(a, b)
        _join_labels(root, a[hit], b[hit])

    _visit(keys, codes, max_bits, root, found)
    return root


def gray_forests(keys: np.ndarray, codes: np.ndarray, judged: np.ndarray, own_bits: int = OWN_BITS, steps: tuple = STEPS, forests: int = FORESTS) -> tuple[np.ndarray, ...]:
    """Pairs (a, b, bits) of codes of a key that differ in at most ``own_bits`` and, in the words of
    ``judged`` (a row for each code), in at most the last of ``steps``: forests of them, near pairs first."""
    return _forests(keys, codes, judged, own_bits, steps, forests)[:3]


def _forests(keys: np.ndarray, codes: np.ndarray, judged: np.ndarray, own_bits: int = OWN_BITS, steps: tuple = STEPS, forests: int = FORESTS) -> tuple[np.ndarray, ...]:
    """As ``gray_forests``, and the set of each code in the last forest: both codes of a pair that no
    forest has taken are in one set, of three codes or more, as each forest has joined them before."""
    roots, out = [np.arange(len(codes)) for _ in range(forests)], []
    if len(codes) < 2:
        return *(np.zeros(0, dtype=np.int64),) * 3, roots[-1]
    for low, high in zip((-1, *steps), steps):

        def found(a, b, low=low, high=high):
            some = np.bitwise_count(codes[a] ^ codes[b]) <= own_bits
            a, b = a[some], b[some]
            bits = np.bitwise_count(judged[a] ^ judged[b]).sum(axis=1, dtype=np.int64)
            some = (bits > low) & (bits <= high)
            a, b, bits = a[some], b[some], bits[some]
            for root in roots:
                taken = _span(root, a, b)
                out.append((a[taken], b[taken], bits[taken]))
                a, b, bits = a[~taken], b[~taken], bits[~taken]

        _visit(keys, codes, own_bits, roots[-1], found)
    taken = tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, dtype=np.int64),) * 3
    return *taken, roots[-1]


def _open_sets(node: np.ndarray, root: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(smallest node of its set, node) of the nodes in sets of three or more."""
    _, own, size = np.unique(root, return_inverse=True, return_counts=True)
    least = np.full(len(size), np.iinfo(np.int64).max)
    np.minimum.at(least, own, node)
    some = size[own] > 2
    return least[own][some], node[some]


# --- links and groups -------------------------------------------------------------------


def block_masks(blocks: int, max_bits: int = MAX_BITS) -> list[int]:
    """Signed masks of every choice of blocks on which two fingerprints may have to agree."""
    cut = [64 * i // blocks for i in range(blocks + 1)]
    part = [((1 << (e - s)) - 1) << s for s, e in zip(cut, cut[1:])]
    masks = [sum(x) for x in combinations(part, blocks - max_bits)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def blocks_for(n: int, max_bits: int = MAX_BITS, mean_key: int = MEAN_KEY) -> int:
    """The fewest blocks at which random fingerprints leave at most ``mean_key`` to a key."""
    for blocks in range(max_bits + 1, 2 * max_bits + 1):
        if n <= mean_key * 2 ** (64 * (blocks - max_bits) / blocks):
            return blocks
    return 2 * max_bits


def _dealt(fps: DataFrame, node: str, keyed: dict[str, list[str]], masks: list[int], key_rows: int) -> DataFrame:
    """(choice, bits, p, q, node, code0, ...): rows where they meet, by each choice of blocks of each
    fingerprint of ``keyed`` (code0; the further ones are those that ``keyed`` has for it), in Gray order."""
    codes = ["node", *[f"code{i}" for i in range(1 + len(next(iter(keyed.values()))))]]
    choices = F.array(
        *[
            F.struct(
                F.lit(turn * len(masks) + i).alias("choice"),
                F.col(own).bitwiseAND(F.lit(m)).alias("bits"),
                *[F.col(c).alias(code) for c, code in zip([node, own, *others], codes)],
            )
            for turn, (own, others) in enumerate(keyed.items())
            for i, m in enumerate(masks)
        ]
    )
    rows = fps.select(F.explode(choices).alias("key")).select("key.*")
    hot = (
        rows.groupBy("choice", "bits")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > key_rows)
        .select("choice", "bits", F.ceil(F.col("n") / key_rows).cast("int").alias("parts"))
    )
    salt = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    met = (
        rows.join(hot, ["choice", "bits"], "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        .withColumn("own", salt)
        .withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
        .select("choice", "bits", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), *codes)
    )
    dealt = met.repartition("choice", "bits", "p", "q").withColumn("gray", gray_rank(F.col("code0")))
    return dealt.sortWithinPartitions("choice", "bits", "p", "q", "gray").select("choice", "bits", "p", "q", *codes)


def _by_key(settle):
    """A function over Arrow batches that gives ``settle`` whole keys, many at a time."""

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(len(x) for x in held) >= 262_144:
                held = yield from _settle(held, settle, False)
        if held:
            yield from _settle(held, settle, True)

    return run


def links(fps: DataFrame, max_bits: int = MAX_BITS, key_rows: int = KEY_ROWS) -> DataFrame:
    """Edges (a, b) that connect all fingerprints within ``max_bits`` of each other.

    ``fps``: a long column fp, each value once.  The edges are a forest of each key's links, so
    their number is at most that of the rows times the choices of blocks.
    """
    masks = block_masks(blocks_for(fps.count(), max_bits), max_bits)

    def linked(keys, node, codes):
        root = gray_links(keys, codes[0], max_bits)
        at = np.flatnonzero(root != np.arange(len(root)))
        return {"a": node[at], "b": node[root[at]]}

    return _dealt(fps, "fp", {"fp": []}, masks, key_rows).mapInArrow(_by_key(linked), "a long, b long")


def candidates(fps: DataFrame, blocks: int, max_bits: int = MAX_BITS, key_rows: int = KEY_ROWS) -> DataFrame:
    """Different pairs (a, b) of nodes that may be similar, ``tried``: what ``gray_forests`` finds in each
    key.  Not ``tried``: (set, node) of the sets of a key's last forest, in which all its other candidates lie.

    ``fps``: a long column node and the fingerprints of ``wide_names(KEYED[blocks])``.
    """

    names = wide_names(KEYED[blocks])
    # where no other fingerprints have keys, those that judge are the key's own and the rest of them
    keyed = {c: [w for w in WIDE if w != c] if names == WIDE else WIDE for c in names}

    def near(keys, node, codes):
        a, b, _, root = _forests(keys, codes[0], np.column_stack(codes[-len(WIDE) :]))
        of, member = _open_sets(node, root)
        first, second = np.minimum(node[a], node[b]), np.maximum(node[a], node[b])
        return {"a": np.append(first, of), "b": np.append(second, member), "tried": np.arange(len(a) + len(of)) < len(a)}

    dealt = _dealt(fps, "node", keyed, block_masks(blocks, max_bits), key_rows)
    return dealt.mapInArrow(_by_key(near), "a long, b long, tried boolean").distinct()


def similar_pairs(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose ``sets`` (node, set) have a Jaccard similarity of ``least`` or more; two
    empty sets are alike.  Sets are compared a pair at a time by Spark, so none waits in a batch for others."""
    side = lambda c: sets.select(F.col("node").alias(c), F.col("set").alias(f"set_{c}"))
    both, all_ = F.size(F.array_intersect("set_a", "set_b")), F.size("set_a") + F.size("set_b")
    # both / (all - both) >= least, with each asked for once
    enough = both >= all_ * F.lit(least / (1 + least)) - F.lit(1e-9)
    return pairs.join(side("a"), "a").join(side("b"), "b").where(enough).select("a", "b")


def open_nodes(rest: DataFrame, groups: DataFrame) -> DataFrame:
    """(cloud, node, part) of the nodes in clouds that are more than one group; cloud: sets (a, b) that have
    nodes in common; part: a node's group, by ``groups`` (node, root), which has those that are linked."""
    clouds = connected_components(rest.select("a", "b")).withColumnRenamed("root", "cloud")
    nodes = rest.select(F.col("b").alias("node")).distinct().join(clouds, "node", "left").join(groups, "node", "left")
    own = written(nodes.select(F.coalesce("cloud", "node").alias("cloud"), "node", F.coalesce("root", "node").alias("part")))
    apart = own.groupBy("cloud").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high")
    return own.join(apart, "cloud", "left_semi")


def rest_pairs(nodes: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) of ``nodes`` (node, part) of different parts, among them all whose ``sets`` (node, set)
    have a Jaccard similarity of ``least`` or more: by prefix filtering, exact for sets that are not empty.

    Similar sets share at least ``least`` of either one's shingles.  So, with shingles in one order, they
    share one of those that stand before the last ``least`` of each; the order begins with the rarest, and
    of those only what two parts have is kept.  Every pair is a row, so this is for few nodes (``rest_links``).
    """
    words = nodes.join(sets, "node").select("node", "part", F.size("set").alias("n"), F.explode("set").alias("word"))
    times = words.groupBy("word").agg(F.count(F.lit(1)).alias("times"))
    place = F.row_number().over(Window.partitionBy("node").orderBy("times", "word"))
    begins = words.join(times, "word").withColumn("place", place).where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * F.lit(least) - F.lit(1e-6)) + 1)
    begins = written(begins.where("times > 1").select("word", "node", "part", "n"))
    shared = begins.groupBy("word").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high")
    begins = begins.join(shared.select("word"), "word", "left_semi")
    other = begins.select("word", *[F.col(c).alias(f"other_{c}") for c in ("node", "part", "n")])
    alike = F.least("n", "other_n") >= F.greatest("n", "other_n") * F.lit(least) - F.lit(1e-6)
    met = begins.join(other, "word").where((F.col("part") < F.col("other_part")) & alike)
    return met.select(F.least("node", "other_node").alias("a"), F.greatest("node", "other_node").alias("b")).distinct()


def _sketches(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """SKETCH words of bits for each set of shingles: whether an odd number of its shingles has a bit.  Two
    sketches differ in no more bits than there are shingles that only one of the sets has."""
    bits, starts, out = 64 * SKETCH, np.append(0, ends[:-1]), []
    spread = (second_hashes(words.view(np.uint64)) % np.uint64(bits)).astype(np.int64)
    for at in range(0, len(ends), 1_024):
        last = min(at + 1_024, len(ends))
        own = np.repeat(np.arange(last - at), ends[at:last] - starts[at:last])
        odd = np.bincount(own * bits + spread[starts[at] : ends[last - 1]], minlength=(last - at) * bits) & 1
        out.append(np.packbits(odd.astype(bool).reshape(-1, bits), axis=1).view(np.uint64))
    return np.concatenate(out)


def cloud_links(part: np.ndarray, words: np.ndarray, ends: np.ndarray, side: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of texts whose sets have a Jaccard similarity of ``least`` or more, enough of them to join all
    parts that such pairs join.  ``words``: the sets, one behind the other, none empty, each up to its ``ends``.

    side: texts of side 0 meet those of side 1, or, where there is none, each other.  Sketches tell how
    many shingles only one of two sets has at least; what that leaves is compared by the sets themselves.
    """
    sizes, root = np.diff(ends, prepend=0), np.unique(part, return_index=True, return_inverse=True)
    root, out = root[1][root[2]], []
    sketch, (seen, code) = _sketches(words, ends), np.unique(words, return_inverse=True)
    own, mark = [code[e - n : e] for e, n in zip(ends.tolist(), sizes.tolist())], np.zeros(len(seen), dtype=bool)
    one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    alone = not len(two)
    two = one if alone else two
    step = max(1, JUDGED // max(1, len(two)))
    for at in range(0, len(one), step):
        a = one[at : at + step, None]
        most = (sizes[a] + sizes[two]) * ((1 - least) / (1 + least)) + 1e-6
        differ = np.zeros(most.shape, dtype=np.int64)
        for w in range(SKETCH_FIRST):
            differ += np.bitwise_count(sketch[a, w] ^ sketch[two, w])
        x, y = np.nonzero((differ <= most) & (np.abs(sizes[a] - sizes[two]) <= most) & (root[a] != root[two]) & ((a < two) | (not alone)))
        some = np.bitwise_count(sketch[a[x, 0]] ^ sketch[two[y]]).sum(axis=1, dtype=np.int64) <= most[x, y]
        first, second = a[x[some], 0], two[y[some]]
        cut = np.flatnonzero(np.diff(first, prepend=-1))
        for i, others in zip(first[cut].tolist(), np.split(second, cut[1:])):
            others = others[root[others] != root[i]]
            if not len(others):
                continue
            mark[own[i]] = True
            both = np.add.reduceat(mark[np.concatenate([own[j] for j in others])], np.cumsum(sizes[others]) - sizes[others], dtype=np.int64)
            mark[own[i]] = False
            others = others[both >= (sizes[i] + sizes[others]) * (least / (1 + least)) - 1e-9]
            taken = others[_span(root, np.full(len(others), i), others)]
            out.append((np.full(len(taken), i), taken))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, dtype=np.int64),) * 2


def _met(nodes: DataFrame, block_words: int) -> DataFrame:
    """``nodes`` (cloud, node, part, set) where they meet: cloud, p and q (two blocks) and side, each pair of
    nodes of different parts once.  A part of over ``block_words`` is dealt over blocks of its own, which need
    not meet each other; the other parts of a cloud are dealt over common blocks, each as a whole."""
    size = F.size("set") + F.lit(TEXT_WORDS)
    parts = nodes.groupBy("cloud", "part").agg(F.sum(size).alias("n"))
    parts = parts.withColumn("home", F.when(F.col("n") > block_words, F.col("part")).otherwise(F.lit(-1)))
    homes = parts.groupBy("cloud", "home").agg(F.ceil(F.sum("n") / block_words).cast("int").alias("blocks"))
    nr = F.pmod(F.xxhash64(F.when(F.col("home") < 0, F.col("part")).otherwise(F.col("node"))), F.col("blocks")).cast("int")
    dealt = nodes.join(parts.join(homes, ["cloud", "home"]).select("cloud", "part", "home", "blocks"), ["cloud", "part"])
    dealt = written(dealt.select("cloud", "node", "part", "set", F.struct("home", nr.alias("nr")).alias("block")))
    blocks = dealt.select("cloud", F.col("block").alias("p")).distinct()
    pairs = blocks.join(blocks.withColumnRenamed("p", "q"), "cloud").where("p <= q and (p.home <> q.home or p.home < 0)")
    sides = F.array(F.struct(F.col("p").alias("block"), F.lit(0).alias("side")), F.struct(F.col("q").alias("block"), F.lit(1).alias("side")))
    sides = pairs.select("cloud", "p", "q", F.explode(sides).alias("s")).where("p <> q or s.side = 0").select("cloud", "p", "q", "s.block", "s.side")
    return dealt.join(sides, ["cloud", "block"]).select("cloud", F.xxhash64("p", "q").alias("pair"), "side", "node", "part", "set")


def rest_links(nodes: DataFrame, sets: DataFrame, least: float, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Links (a, b) that connect all ``nodes`` (cloud, node, part) of one cloud whose ``sets`` (node, set) have
    a Jaccard similarity of ``least`` or more, beyond what their parts connect.

    The texts of a cloud meet in blocks, each pair of blocks in one task, so no pair is a row: a task holds
    two blocks and gives a forest of its links.  The work is that of all pairs of different parts, as texts
    that are nearly similar must all be told from those that are.
    """

    def settle(batches):
        held = []
        for batch in batches:
            held.append(batch)
            if sum(len(x) for x in held) >= 16_384:
                held = yield from settled(held, False)
        if held:
            yield from settled(held, True)

    def settled(held, last):
        table = pa.Table.from_batches(held).combine_chunks()
        cloud, pair = table.column("cloud").to_numpy(), table.column("pair").to_numpy()
        cuts = np.append(np.flatnonzero(np.append(True, (cloud[1:] != cloud[:-1]) | (pair[1:] != pair[:-1]))), len(table))
        for s, e in zip(cuts, cuts[1:] if last else cuts[1:-1]):
            rows = table.slice(s, e - s)
            words = rows.column("set").combine_chunks()
            part, side, node = (rows.column(c).to_numpy() for c in ("part", "side", "node"))
            a, b = cloud_links(part, words.flatten().to_numpy(), np.cumsum(words.value_lengths().to_numpy(), dtype=np.int64), side, least)
            yield pa.RecordBatch.from_pydict({"a": pa.array(np.minimum(node[a], node[b])), "b": pa.array(np.maximum(node[a], node[b]))})
        return [] if last else table.slice(cuts[-2]).to_batches()

    met = _met(nodes.join(sets, "node").where(F.size("set") > 0), block_words)
    return met.repartition("cloud", "pair").sortWithinPartitions("cloud", "pair").mapInArrow(settle, "a long, b long")


def similar_links(found: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Links (a, b) that connect all candidates of a similarity of ``least`` or more: of the pairs that were
    tried (``candidates``), and between the groups that these make of the sets that hold the rest."""
    tried = written(similar_pairs(found.where("tried").select("a", "b"), sets, least))
    nodes = written(open_nodes(found.where("not tried"), connected_components(tried)))
    return tried if nodes.isEmpty() else tried.unionByName(rest_links(nodes, sets, least))


def _settle(held: list, settle, last: bool):
    """Settles the whole keys among the held batches; gives back the rows of the last key unless it is complete."""
    table = pa.Table.from_batches(held).combine_chunks()
    cols = [table.column(c).to_numpy() for c in ("choice", "bits", "p", "q")]
    new = np.zeros(len(table), dtype=bool)
    for c in cols:
        new[1:] |= c[1:] != c[:-1]
    keys = np.cumsum(new)
    upto = len(table) if last else int(np.searchsorted(keys, keys[-1]))
    codes = [table.column(c).to_numpy()[:upto].view(np.uint64) for c in table.column_names if c.startswith("code")]
    found = settle(keys[:upto], table.column("node").to_numpy()[:upto], codes)
    yield pa.RecordBatch.from_pydict({c: pa.array(v) for c, v in found.items()})
    return table.slice(upto).to_batches()


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """Every row's id, fingerprint and group.

    Returns (doc_id, fp long, component_id): component_id is the smallest id that can be
    reached over links, the row's own included; nulls are passed over, so a group whose ids
    are all null has a null component_id.  Null and empty texts have fingerprint 0, which is
    linked like any other.  Rows that repeat stay repeated.  No rows: no rows.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    rows = written(fingerprints(rows, F.col("text")).select("doc_id", "fp"))
    firsts = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    groups = roots(firsts, links(firsts, max_bits))
    ids = groups.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = groups.select("fp", "root").join(ids, "root").select("fp", "component_id")
    return rows.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def roots(firsts: DataFrame, edges: DataFrame, name: str = "fp") -> DataFrame:
    """``firsts`` with root: the smallest ``name`` that its own one reaches over the edges."""
    parts = connected_components(edges).withColumnRenamed("node", "member")
    joined = firsts.join(parts, F.col(name) == F.col("member"), "left")
    return joined.withColumn("root", F.coalesce("root", name)).drop("member")


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_bits: int = MAX_BITS,
    shingle: int = SHINGLE,
    similar: float | None = None,
) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one with the smallest id
    (null ids last; of equal ids the first row).  All null texts, empty ones and those without
    words have fingerprint 0 and so are one group.  Rows that repeat are one group each.

    Texts are linked up to ``max_bits`` differing bits, or, if there is ``similar``, by that Jaccard
    similarity of their sets of shingles or more; then ``max_bits`` only cuts the keys.
    """
    rows = numbered(docs, text_col)
    order = F.struct(F.col("id").isNull().alias("late"), "id", "rid")
    marked = rows.select("rid", F.col("doc").getField(id_col).alias("id"), "text")
    if similar is None:
        marked = written(fingerprints(marked, F.col("text"), shingle=shingle).select("rid", "id", "fp"))
        firsts = marked.groupBy("fp").agg(F.min(order).alias("first"))
        groups = roots(firsts, links(firsts, max_bits))
    else:
        blocks = blocks_for(rows.count(), max_bits, MEAN_WIDE_KEY)
        names = wide_names(KEYED[blocks])
        marked = written(wide_fingerprints(marked, F.col("text"), shingle=shingle, n=len(names)).select("rid", "id", *names))
        firsts = written(marked.groupBy(*names).agg(F.min(order).alias("first"), F.min("rid").alias("node")))
        pairs = written(candidates(firsts, blocks, max_bits))
        asked = pairs.where("tried").select(F.explode(F.array("a", "b")).alias("rid")).distinct()
        sets = shingle_sets(rows.join(asked, "rid").select(F.col("rid").alias("node"), "text"), F.col("text"), shingle=shingle)
        groups = roots(firsts, similar_links(pairs, written(sets.select("node", "set")), similar), "node")
    groups = groups.groupBy("root").agg(F.min("first").alias("first"))
    kept = groups.select(F.col("first.rid").alias("rid"))
    return rows.join(kept, "rid", "left_semi").select("doc.*")

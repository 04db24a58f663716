"""Removal of strings that occur more than once, through suffix arrays.

A text is a sequence of symbols: its bytes, or the hashes of its words.  Every window of
``window`` symbols has one owner: the gram of ``gram`` symbols inside it with the smallest
hash (the first of equals).  Equal windows have equal owners at the same offset, so windows
have to meet only where their owner grams are equal.  The windows that one gram occurrence
owns start at consecutive symbols; the symbols they span are a segment.

1. Each text gives its segments: place, number of windows, hash of the gram, hash of the
   segment (one row for about ``(window - gram) / 2`` symbols of text).
2. Equal segments of a gram are counted before anything moves: a segment that occurs twice
   as a whole is repeated as a whole, and only one copy of it goes on.
3. The distinct segments of a gram that has several go to the task of their gram, where a
   suffix array over them, cut into pieces of ``piece`` symbols counted from the gram, brings
   suffixes with a common head of ``window / piece - 1`` pieces together.  Windows are equal
   where their heads are equal and the few symbols before and after them are.
4. The intervals found go back to the texts, which lose the symbols.

A gram with more than ``GROUP_ROWS`` distinct segments is split before it is gathered: its
windows fall into classes by the gram's offset, ``piece`` offsets to a class, and a class
into groups by the ``window - piece + 1`` symbols that all its windows share.  Equal windows
are in one class and group.  What is still larger shares all but ``piece`` symbols, and is
split once more, into single windows, where a group's size tells whether its window repeats.
So no group that meets in a task is larger than ``GROUP_ROWS`` segments, however hot its gram.

The suffix array is built by grouping suffixes by their Lyndon prefixes: groups are
processed in descending order; the members' previous-smaller pointers say whose prefix grows
by the group's, and those suffixes move to new groups just above their old ones.  A second
pass then fills the array from the left, putting each suffix at the next place of its
group; nothing is renamed, nothing recurses and no suffix is compared.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm.shared import Scratch, numbered, text_in, written


@dataclass(frozen=True)
class Shape:
    """What is looked for: lengths in symbols, which are bytes or whole words."""

    window: int
    gram: int
    piece: int
    words: bool = False

    def __post_init__(self):
        if not 0 < self.gram <= self.window or self.window < 2 * self.piece:
            raise ValueError("a window holds a gram and at least two pieces")


#: Strings of 400 bytes.
BYTES = Shape(400, 64, 16)
#: Passages of over 50 words, blanks between them aside.
PASSAGES = Shape(51, 8, 5, words=True)
#: Distinct segments of one group that one task takes at most.
GROUP_ROWS = 2_000
#: Bytes of segments that make one suffix array, but for the last group's.
BATCH_BYTES = 1_000_000
#: Longest stretch of a text that is hashed at a time.
STRETCH = 1 << 18
#: Rows, and bytes of cut segments, that a task gives back at a time.
OUT_ROWS = 100_000
OUT_BYTES = 4_000_000

_PLACE = np.uint64(20)
_LOW = np.uint64((1 << 20) - 1)


# --- the suffix array -------------------------------------------------------------------


def lyndon_groups(s: list[int]) -> tuple[list[list[int]], list[int]]:
    """Suffixes of s grouped by their longest Lyndon prefix, groups in ascending order, and
    each suffix's nearest smaller suffix to the left (-1: none)."""
    n = len(s)
    by_symbol: dict[int, list[int]] = {}
    for i, c in enumerate(s):
        by_symbol.setdefault(c, []).append(i)
    members = [by_symbol[c] for c in sorted(by_symbol)]  # suffixes that have moved on stay listed and are skipped
    size = [len(m) for m in members]
    below = list(range(-1, len(members) - 1))
    above = list(range(1, len(members) + 1))
    group = [0] * n
    for g, m in enumerate(members):
        for i in m:
            group[i] = g
    previous = [-1] * n
    seen = bytearray(n)
    g = len(members) - 1
    descending: list[list[int]] = []
    while g >= 0:
        if not size[g]:
            g = below[g]
            continue
        # in ascending order without a sort: symbols are listed so, and what moves to a new group is found
        # through the previous-smaller pointers of an ascending group, which never decrease
        current = [i for i in members[g] if group[i] == g]
        descending.append(current)
        times: dict[int, int] = {}
        for i in current:
            seen[i] = 1
            p = i - 1
            while p >= 0 and seen[p]:
                p = previous[p]
            previous[i] = p
            if p >= 0:
                times[p] = times.get(p, 0) + 1
        grown: dict[int, dict[int, list[int]]] = {}
        for p, k in times.items():
            grown.setdefault(k, {}).setdefault(group[p], []).append(p)
        for k in sorted(grown, reverse=True):  # k different counts need k(k+1)/2 members: sorting them stays linear
            for q, those in grown[k].items():
                if len(those) == size[q]:
                    continue  # the whole group grows alike, so its place stays
                new = len(members)
                members.append(those)
                size.append(len(those))
                size[q] -= len(those)
                for p in those:
                    group[p] = new
                below[above[q]] = new
                above.append(above[q])
                below.append(q)
                above[q] = new
        g = below[g]
    descending.reverse()
    return descending, previous


def grouped_suffix_array(s: list[int]) -> list[int]:
    """Suffix array of s, whose last symbol must be its unique smallest."""
    groups, previous = lyndon_groups(s)
    n = len(s)
    place = [0] * n  # of a suffix: its group
    free = []  # of a group: its next place
    at = 0
    for g, m in enumerate(groups):
        free.append(at)
        at += len(m)
        for i in m:
            place[i] = g
    array = [0] * n
    array[0] = n - 1
    done = bytearray(n)
    done[n - 1] = 1
    for k in range(n):
        i = array[k] - 1
        while i >= 0 and not done[i]:
            g = place[i]
            array[free[g]] = i
            free[g] += 1
            done[i] = 1
            i = previous[i]
    return array


# --- symbols and windows of a text ------------------------------------------------------

_ODD = 0x9E3779B97F4A7C15
_TABLES = [np.random.default_rng(seed).integers(1, 2**63, 256, dtype=np.uint64) for seed in (1, 2)]
_BASES = [np.uint64(0xD1342543DE82EF95), np.uint64(0xAF251AF3B0F025B5)]
_INVERSES = [np.uint64(pow(int(b), -1, 2**64)) for b in _BASES]
_BLANK = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_powers: dict[tuple[int, bool], np.ndarray] = {}


def _power(which: int, inverse: bool, n: int) -> np.ndarray:
    """Powers 0 to n-1 of a base or its inverse, modulo 2^64."""
    have = _powers.get((which, inverse))
    if have is None or len(have) < n:
        base = (_INVERSES if inverse else _BASES)[which]
        have = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _powers[which, inverse] = have
    return have[:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads a polynomial hash over all 64 bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(_ODD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _prefixes(data: np.ndarray, which: int) -> np.ndarray:
    """Prefix sums that give the hash of any stretch of symbols in one subtraction."""
    value = _TABLES[which][data] if data.dtype == np.uint8 else _mixed(data ^ _BASES[which])
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(value * _power(which, False, len(data)), out=out[1:])
    return out


def _hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int) -> np.ndarray:
    return _mixed((prefix[ends] - prefix[starts]) * _power(which, True, len(prefix))[starts])


def word_places(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word."""
    blank = _BLANK[np.frombuffer(text, dtype=np.uint8)]
    edge = np.diff(np.concatenate(([True], blank, [True])).astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def symbols(text: bytes, shape: Shape) -> np.ndarray:
    """The text's bytes (uint8), or a 64-bit hash of each of its words."""
    data = np.frombuffer(text, dtype=np.uint8)
    if not shape.words:
        return data
    starts, ends = word_places(text)
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = int(np.searchsorted(ends, base + STRETCH, "right"))
        if j <= i:  # a word longer than a stretch
            out[i] = xxhash.xxh64_intdigest(text[base : ends[i]])
            j = i + 1
        else:
            out[i:j] = _hashes(_prefixes(data[base : ends[j - 1]], 0), starts[i:j] - base, ends[i:j] - base, 0)
        i = j
    return out


def _first_least(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` consecutive values."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def segments(data: np.ndarray, shape: Shape = BYTES) -> tuple[np.ndarray, ...]:
    """(start, windows, gram's offset, gram hash, segment hash) of the segments of a text's symbols.

    A long text is taken in stretches; a segment that a border cuts is two segments, each
    with the windows it owns, which are compared like any others.
    """
    window, gram = shape.window, shape.gram
    out = []
    for base in range(0, max(len(data) - window + 1, 0), STRETCH - window):
        part = data[base : base + STRETCH - 1]
        if len(part) < window:
            break
        prefix = _prefixes(part, 0)
        at = np.arange(len(part) - gram + 1)
        grams = _hashes(prefix, at, at + gram, 0)
        owner = _first_least(((grams >> _PLACE) << _PLACE) | at.astype(np.uint64), window - gram + 1) & _LOW
        owner = owner.astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(owner[1:] != owner[:-1]) + 1))
        count = np.diff(np.append(first, len(owner)))
        own = owner[first]
        whole = _hashes(prefix, first, first + count - 1 + window, 0)
        offset = own - first
        whole = _mixed(whole ^ (count.astype(np.uint64) << np.uint64(32)) ^ offset.astype(np.uint64))
        out.append((first + base, count, offset, grams[own].view(np.int64), whole.view(np.int64)))
    if not out:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty, empty, empty
    return tuple(np.concatenate(x) for x in zip(*out))


def window_hashes(data: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of every window of a few symbols."""
    at = np.arange(max(len(data) - window + 1, 0))
    return tuple(_hashes(_prefixes(data, k), at, at + window, k) for k in (0, 1))


def _words_of_memory(rows: np.ndarray) -> list[np.ndarray]:
    """The bytes of each row as columns of 64-bit numbers: equal where the rows are."""
    raw = np.ascontiguousarray(rows).view(np.uint8).reshape(len(rows), -1)
    padded = np.zeros((len(rows), -(-raw.shape[1] // 8) * 8), dtype=np.uint8)
    padded[:, : raw.shape[1]] = raw
    return list(padded.view(np.uint64).T)


def repeated_windows(parts: list[np.ndarray], offsets: list[int], shape: Shape = BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Which windows of some segments occur again in the same or another of them.

    offsets: where the gram stands in each segment; equal windows stand alike to their grams.
    Returns a mark for every window, one segment's after the other's, and where each
    segment's begin.
    """
    window, piece = shape.window, shape.piece
    size = window // piece - 1  # pieces of a head
    rest = window - size * piece
    data = np.concatenate(parts)
    lengths = np.array([len(p) for p in parts])
    starts = np.cumsum(lengths) - lengths
    windows = np.maximum(lengths - window + 1, 0)
    first_window = np.cumsum(windows) - windows
    flags = np.zeros(int(windows.sum()), dtype=bool)
    lead = np.array(offsets) % piece
    pieces = (lengths - lead) // piece
    # the pieces of each segment as numbers, then 1 as its end; 0 ends them all
    total = int(pieces.sum() + len(parts) + 1)
    segment = np.repeat(np.arange(len(parts)), pieces)
    nth = np.arange(len(segment)) - (np.cumsum(pieces) - pieces)[segment]
    begin = starts[segment] + lead[segment] + nth * piece
    columns = _words_of_memory(np.lib.stride_tricks.sliding_window_view(data, piece)[begin])
    by = np.lexsort(columns)
    fresh = np.zeros(len(by), dtype=np.int64)
    for c in columns:
        fresh[1:] |= c[by][1:] != c[by][:-1]
    spot = np.arange(len(segment)) + segment
    text = np.ones(total, dtype=np.int64)
    text[-1] = 0
    text[spot[by]] = np.cumsum(fresh) + 2
    array = np.array(grouped_suffix_array(text.tolist()))
    # suffixes that have a whole head before their segment's end, in suffix order: equal heads side by side
    piece_at = np.full(total, -1)
    piece_at[spot] = np.arange(len(segment))
    ranked = piece_at[array]
    ranked = ranked[ranked >= 0]
    ranked = ranked[nth[ranked] + size <= pieces[segment[ranked]]]
    if len(ranked) < 2:
        return flags, first_window
    heads = np.lib.stride_tricks.sliding_window_view(text, size)
    same = np.zeros(len(ranked) - 1, dtype=bool)
    for at in range(0, len(same), 65_536):
        to = min(at + 65_536, len(same))
        h = heads[spot[ranked[at : to + 1]]]
        same[at:to] = (h[1:] == h[:-1]).all(axis=1)
    run = np.concatenate(([0], np.cumsum(~same)))
    shared = np.concatenate((same, [False])) | np.concatenate(([False], same))
    ranked, run = ranked[shared], run[shared]
    # each such suffix stands for the windows that begin up to a piece before it
    back = np.arange(piece)
    x = (begin[ranked] - starts[segment[ranked]])[:, None] - back
    ok = (x >= 0) & (x + window <= lengths[segment[ranked]][:, None])
    if not ok.any():
        return flags, first_window
    of = np.broadcast_to(segment[ranked][:, None], x.shape)[ok]
    kind = (run[:, None] * piece + back)[ok]
    back = np.broadcast_to(back, x.shape)[ok]
    x = x[ok]
    # symbols of the window outside the head
    around = np.arange(rest)
    around = around + np.where(around < back[:, None], 0, size * piece)
    columns = [kind, *_words_of_memory(data[(starts[of] + x)[:, None] + around])]
    by = np.lexsort(columns)
    same = np.ones(len(by) - 1, dtype=bool)
    for c in columns:
        same &= c[by][1:] == c[by][:-1]
    hit = by[np.concatenate((same, [False])) | np.concatenate(([False], same))]
    flags[first_window[of[hit]] + x[hit]] = True
    return flags, first_window


def spans_of(flags: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of marked windows as (segment, start, end) in symbols of the segment."""
    gap = np.arange(len(first))  # an unmarked place after each segment's windows keeps runs apart
    at = np.flatnonzero(flags)
    segment = np.searchsorted(first, at, "right") - 1
    spread = np.zeros(len(flags) + len(first) + 1, dtype=np.int8)
    spread[at + gap[segment]] = 1
    edge = np.diff(np.concatenate(([0], spread)))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    segment = np.searchsorted(first + gap, start, "right") - 1
    base = (first + gap)[segment]
    return segment, start - base, end - 1 - base + window


# --- over all texts ---------------------------------------------------------------------

_SEGMENT = "rid long, start long, windows int, gram_at int, gram long, seg long"
_CUT = "gram long, rows long, rid long, start long, gram_at int, copies long, symbols binary"
_NAMES = [c.split()[0] for c in _CUT.split(", ")]
_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
_INTERVAL = "rid long, start long, end long"


def _read(raw: bytes, shape: Shape) -> np.ndarray:
    return np.frombuffer(raw, dtype=np.uint64 if shape.words else np.uint8)


def _segments_of(shape: Shape):
    def segments_of(batches):
        names = [c.split()[0] for c in _SEGMENT.split(", ")]
        held, n = [], 0

        def out():
            rid, start, count, offset, gram, seg = (np.concatenate(x) for x in zip(*held))
            return pa.RecordBatch.from_arrays([pa.array(rid), pa.array(start), pa.array(count.astype(np.int32)), pa.array(offset.astype(np.int32)), pa.array(gram), pa.array(seg)], names=names)

        for batch in batches:
            for rid, text in zip(batch.column(0), batch.column(1).cast(pa.binary())):
                found = segments(symbols(text.as_py(), shape), shape)
                if len(found[0]):
                    held.append((np.full(len(found[0]), rid.as_py()), *found))
                    n += len(found[0])
                if n >= OUT_ROWS:
                    yield out()
                    held, n = [], 0
        if held:
            yield out()

    return segments_of


def _batched(rows):
    """Rows of cut segments as record batches of bounded size."""
    out, held = [], 0
    for row in rows:
        out.append(row)
        held += len(row[-1])
        if held >= OUT_BYTES or len(out) >= OUT_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _TYPES)], names=_NAMES)
            out, held = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _TYPES)], names=_NAMES)


def _rows_of(batches, names):
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in names))


def _cut_out(shape: Shape):
    """Symbols of the segments asked for of each text."""

    def rows(batches):
        for batch in batches:
            for text, wanted in zip(batch.column("text").cast(pa.binary()), batch.column("wanted")):
                data = symbols(text.as_py(), shape)
                for w in wanted.as_py():
                    part = data[w["start"] : w["start"] + w["windows"] - 1 + shape.window]
                    yield w["gram"], w["rows"], w["rid"], w["start"], w["gram_at"], w["copies"], part.tobytes()

    return lambda batches: _batched(rows(batches))


def _classes(shape: Shape):
    """The windows of each segment by the offset of their gram, ``piece`` offsets to a class, with a
    key made of gram, class and the symbols that all windows of the class share."""
    window, piece = shape.window, shape.piece

    def rows(batches):
        for gram, rid, start, at, copies, raw in _rows_of(batches, ("gram", "rid", "start", "gram_at", "copies", "symbols")):
            data = _read(raw, shape)
            n = len(data) - window + 1
            for k in range(max(at - n + 1, 0) // piece, at // piece + 1):
                low, high = max(0, at - (k + 1) * piece + 1), min(n - 1, at - k * piece)
                shared = data[at - k * piece : at - (k + 1) * piece + 1 + window].tobytes()
                key = xxhash.xxh64_intdigest(shared, (gram + k * _ODD) % 2**64)
                yield key - 2**64 if key >= 2**63 else key, 0, rid, start + low, at - low, copies, data[low : high + window].tobytes()

    return lambda batches: _batched(rows(batches))


def _match(shape: Shape):
    """Repeated intervals among the segments of whole groups; rows come sorted by gram."""

    def matched(rows: list[tuple]):
        flags, first = repeated_windows([_read(r[5], shape) for r in rows], [r[3] for r in rows], shape)
        seg, start, end = spans_of(flags, first, shape.window)
        once = np.array([r[4] for r in rows])[seg] == 1  # all copies of the others go as a whole
        seg, start, end = seg[once], start[once], end[once]
        base = np.array([r[2] for r in rows])[seg]
        if len(seg):
            yield pa.RecordBatch.from_arrays([pa.array(np.array([r[1] for r in rows])[seg]), pa.array(base + start), pa.array(base + end)], names=["rid", "start", "end"])

    def match(batches):
        held, held_bytes, last = [], 0, None
        for row in _rows_of(batches, ("gram", "rid", "start", "gram_at", "copies", "symbols")):
            if held_bytes >= BATCH_BYTES and row[0] != last:
                yield from matched(held)
                held, held_bytes = [], 0
            held.append(row)
            held_bytes += len(row[5])
            last = row[0]
        if held:
            yield from matched(held)

    return match


def _each_window(shape: Shape):
    """The hashes of all windows of the segments."""

    def each(batches):
        held, n = [], 0
        for rid, start, copies, raw in _rows_of(batches, ("rid", "start", "copies", "symbols")):
            one, two = window_hashes(_read(raw, shape), shape.window)
            held.append((np.full(len(one), rid), start + np.arange(len(one)), np.full(len(one), copies), one.view(np.int64), two.view(np.int64)))
            n += len(one)
            if n >= OUT_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*held)], names=["rid", "start", "copies", "one", "two"])
                held, n = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*held)], names=["rid", "start", "copies", "one", "two"])

    return each


def repeated_spans(rows: DataFrame, temp: Scratch, shape: Shape = BYTES, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Intervals (rid, start, end), in symbols, of all windows that occur elsewhere too.
    They overlap and touch.  ``rows``: (rid, text), stored, each rid once; ``temp`` holds the
    tables in between and must last until the intervals are written."""
    window = shape.window
    found = temp.written(rows.select("rid", "text").mapInArrow(_segments_of(shape), _SEGMENT))
    # one copy of each segment; its columns come from one row
    one = [F.first(c).alias(c) for c in ("rid", "start", "windows", "gram_at")]
    distinct = temp.written(found.groupBy("gram", "seg").agg(F.count(F.lit(1)).alias("copies"), *one))
    interval = ["rid", "start", (F.col("start") + F.col("windows") - 1 + window).alias("end")]
    again = distinct.where("copies > 1").select("gram", "seg")
    whole = found.join(again, ["gram", "seg"], "left_semi").select(*interval)

    several = temp.written(distinct.groupBy("gram").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1"))
    wanted = (
        distinct.join(several, "gram")
        .select("rid", F.struct("gram", "rows", "rid", "start", "windows", "gram_at", "copies").alias("w"))
        .groupBy("rid")
        .agg(F.collect_list("w").alias("wanted"))
    )
    cut = rows.select("rid", "text").join(wanted.hint("shuffle_hash"), "rid").select("text", "wanted")
    cut = temp.written(cut.mapInArrow(_cut_out(shape), _CUT))
    split = temp.written(cut.where(F.col("rows") > group_rows).mapInArrow(_classes(shape), _CUT))
    sizes = temp.written(split.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    split = split.join(sizes, "gram").withColumn("rows", F.col("n")).drop("n")
    small = cut.where(F.col("rows") <= group_rows).unionByName(split.where(F.col("rows") <= group_rows))
    dealt = small.repartition("gram").sortWithinPartitions("gram")
    matched = dealt.select("gram", "rid", "start", "gram_at", "copies", "symbols").mapInArrow(_match(shape), _INTERVAL)

    single = temp.written(split.where(F.col("rows") > group_rows).mapInArrow(_each_window(shape), "rid long, start long, copies long, one long, two long"))
    twice = temp.written(single.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("one", "two"))
    counted = single.where("copies = 1").join(twice, ["one", "two"], "left_semi").select("rid", "start", (F.col("start") + window).alias("end"))
    return whole.union(matched).union(counted)


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching intervals as one."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def dedup(docs: DataFrame, text: str = "text", shape: Shape = BYTES, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Every row of ``docs`` with what is left of its text.

    Returns (doc, kept binary, n_bytes, n_removed, n_spans): doc holds the columns of docs,
    whatever their names.  ``shape`` says what counts as repeated; of words, those covered go
    with the blanks between them.  Null and empty texts, and those shorter than a window,
    lose nothing.  Rows that repeat are occurrences of their own, so their long texts go
    altogether.  Very long texts are taken whole, in stretches.  No rows: no rows.
    """
    rows = numbered(docs, text)
    with Scratch(docs.sparkSession) as temp:
        spans = repeated_spans(rows, temp, shape, group_rows)
        marked = written(spans.groupBy("rid").agg(F.collect_list(F.struct("start", "end")).alias("spans")))
    joined = rows.drop("text").join(marked.hint("shuffle_hash"), "rid", "left").select("doc", "spans").withColumn("text", text_in("doc", text))
    out = F.pandas_udf(_removed(shape), "kept binary, n_removed long, n_spans long")
    return joined.withColumn("out", out(F.col("text").cast("binary"), F.col("spans").getField("start"), F.col("spans").getField("end"))).select(
        "doc",
        "out.kept",
        F.octet_length("text").cast("long").alias("n_bytes"),
        "out.n_removed",
        "out.n_spans",
    )


def _removed(shape: Shape):
    import pandas as pd

    def removed(texts, starts, ends):
        out = []
        for text, s, e in zip(texts, starts, ends):
            spans = united(list(zip(s.tolist(), e.tolist()))) if s is not None else []
            if spans and shape.words:
                first, end = word_places(text)
                spans = [(int(first[a]), int(end[b - 1])) for a, b in spans]
            kept, at = [], 0
            for a, b in spans:
                kept.append(text[at:a])
                at = b
            kept.append(text[at:])
            out.append((b"".join(kept), sum(b - a for a, b in spans), len(spans)))
        return pd.DataFrame(out, columns=["kept", "n_removed", "n_spans"])

    return removed


def readable(kept):
    """Bytes kept as text; where a cut splits a character its remaining bytes go too."""
    return F.pandas_udf(lambda parts: parts.map(lambda b: b.decode("utf-8", "ignore")), "string")(kept)


def cleaned(docs: DataFrame, text: str = "text", shape: Shape = BYTES) -> DataFrame:
    """``docs`` with what repeats taken out of ``text``, as ``dedup`` finds it.  Where a cut
    splits a character its remaining bytes go too; a null text stays null."""
    new = F.when(F.col("doc").getField(text).isNotNull(), readable(F.col("kept")))
    return dedup(docs, text, shape).select(F.col("doc").withField(text, new).alias("doc")).select("doc.*")

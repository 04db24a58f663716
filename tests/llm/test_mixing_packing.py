import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tidelake.llm import mixing, packing

DOCS = "doc_id long, text string, source string, copies string"


def wanted(sizes):
    """Targets by the rule as written: share, stop, reshare."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    out, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > 3 * sizes[s]]
        if not over:
            out |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            out[s] = 3.0 * sizes[s]
            open_.discard(s)
        left -= sum(3.0 * sizes[s] for s in over)
    return out


def docs(rng, sources, n=3000):
    return [(i, " ".join(["w"] * rng.choice([0, 1, 5, 40, 300])), rng.choice(sources), "x") for i in range(n)]


@pytest.mark.parametrize("sources", [["a", "b", "c", "d", None], ["Z", "é", "a", "\U0001f600", "\uffff"] + ["h"] * 30, ["one"], [None]])
def test_targets_and_copies(spark, sources):
    rows = docs(random.Random(len(sources)), sources)
    out = mixing.copies(spark.createDataFrame(rows, DOCS)).collect()
    assert len(out) == len(rows)
    sizes, taken, target = Counter(), Counter(), {}
    for r in out:
        sizes[r.source] += r["size"]
        taken[r.source] += r["size"] * r.copies
        target[r.source] = r.target
        assert 0 <= r.copies <= 3
    want = wanted(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert taken[s] == pytest.approx(want[s], abs=400 + 0.02 * want[s])


def test_newton_agrees_with_the_closed_form(spark):
    rows = docs(random.Random(3), ["a", "b", "c"])
    sizes = spark.createDataFrame(rows, DOCS).select("source", mixing.word_count(F.col("text")).alias("size"))
    goals = mixing.targets(sizes)
    for r in mixing.multipliers(sizes, goals).withColumn("rate", F.exp("lambda")).collect():
        assert r.rate == pytest.approx(r.target / r.source_size, rel=1e-7)


def test_reruns_agree_and_rows_repeat_whole(spark):
    rows = docs(random.Random(9), ["a", "b"], 500)
    df = spark.createDataFrame([*rows, *rows[:50]], DOCS)
    one = Counter(tuple(r) for r in mixing.mixed(df).collect())
    two = Counter(tuple(r) for r in mixing.mixed(df.repartition(7)).collect())
    assert one == two and mixing.mixed(df).columns == df.columns


def test_edges_of_mixing(spark):
    assert mixing.copies(spark.createDataFrame([], DOCS)).count() == 0
    out = mixing.copies(spark.createDataFrame([(None, None, None, None), (1, "", "a", None), (2, "x y", "b", None), (2, "x y", "b", None)], DOCS)).collect()
    assert {r["source"]: r.target for r in out} == {None: 0.0, "a": 0.0, "b": 4.0}
    assert sum(r.copies for r in out if r.source == "b") == 2 and sum(r["size"] * r.copies for r in out) == 4


# --- packing ----------------------------------------------------------------------------


def padding(histogram, cut):
    return sum(c * (min(b for b in cut if b >= n) - n) for n, c in histogram.items())


@pytest.mark.parametrize("seed", range(15))
def test_bounds_are_the_best(seed):
    rng = random.Random(seed)
    histogram = {n: rng.randint(1, 30) for n in rng.sample(range(1, 40), rng.randint(1, 9))}
    k = rng.randint(1, 5)
    got = packing.bounds(histogram, k)
    lengths = sorted(histogram)
    best = min(padding(histogram, [*c, lengths[-1]]) for m in range(min(k, len(lengths))) for c in combinations(lengths[:-1], m))
    assert len(got) <= k and got == sorted(set(got)) and padding(histogram, got) == best
    assert packing.bounds({}, 4) == []


def test_batches_hold_every_token_once_within_budget(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ROWS", 20)
    rng = random.Random(6)
    rows = [(i, " ".join(["w"] * n), "s", "c") for i, n in enumerate(rng.choices([0, 1, 3, 10, 11, 50, 64, 65, 200, 1000], k=600))]
    rows += [(7, rows[7][1], "s", "c"), (None, None, None, None), (None, "a b", None, None)]
    out = packing.packed(spark.createDataFrame(rows, DOCS), longest=64, buckets=4, budget=256).collect()
    tokens, slots, batches = defaultdict(int), set(), defaultdict(list)
    for r in out:
        tokens[r.doc_id] += r.n_tokens
        assert r.n_tokens <= r.bucket <= 64 and r.padding == r.bucket - r.n_tokens and r.start == r.chunk * 64
        assert (r.bucket, r.batch, r.slot) not in slots
        slots.add((r.bucket, r.batch, r.slot))
        batches[r.bucket, r.batch].append(r)
    want = defaultdict(int)
    for i, t, _, _ in rows:
        want[i] += len((t or "").split())
    assert tokens == want
    for (bucket, batch), found in batches.items():
        assert bucket * len(found) <= 256
        full = 256 // bucket if bucket else 256
        last = batch == max(b for k, b in batches if k == bucket)
        assert len(found) == full or last
    assert len({b for b, _ in batches} - {0}) <= 4
    assert packing.packed(spark.createDataFrame([], DOCS)).count() == 0
    with pytest.raises(ValueError):
        packing.packed(spark.createDataFrame(rows, DOCS), longest=300, budget=256)


def test_given_lengths_are_taken(spark):
    df = spark.createDataFrame([(1, "x", "s", "c"), (2, "x", "s", None)], DOCS)
    out = packing.packed(df, length=F.when(F.col("doc_id") == 1, 5)).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in out) == [(1, 5), (2, 0)]


def plain_packing(rows, longest, buckets, budget):
    """The same result from plain loops: (doc_id, chunk, start, n_tokens, bucket, batch, slot)."""
    chunks = []
    for i, text in rows:
        n = len([w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w])
        chunks += [(i, k, k * longest, min(longest, n - k * longest)) for k in range(max(1, -(-n // longest)))]
    histogram = Counter(c[3] for c in chunks if c[3])
    lengths = sorted(histogram)
    best = {(0, 0): (0, ())}
    for k in range(1, buckets + 1):
        for j in range(len(lengths) + 1):
            options = [best[k - 1, j]] if (k - 1, j) in best else []
            for i in range(j):
                if (k - 1, i) in best:
                    cost, cut = best[k - 1, i]
                    options.append((cost + sum(histogram[x] * (lengths[j - 1] - x) for x in lengths[i:j]), (*cut, lengths[j - 1])))
            if options:
                best[k, j] = min(options)
    least = best[buckets, len(lengths)][0]
    return chunks, histogram, least


def test_the_query_against_plain_loops(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    chunks, histogram, least = plain_packing(rows, 256, 5, 1024)
    out = packing.packed(docs, longest=256, buckets=5, budget=1024).collect()
    assert sum(r.padding for r in out if r.n_tokens) == least
    cut = sorted({r.bucket for r in out} - {0})
    want, place = [], Counter()
    for i, k, start, n in sorted(chunks, key=lambda c: (-c[3], c[0], c[1])):
        bucket = min(b for b in cut if b >= n) if n else 0
        each = 1024 // bucket if bucket else 1024
        want.append((i, k, start, n, bucket, place[bucket] // each, place[bucket] % each, bucket - n))
        place[bucket] += 1
    assert sorted(map(tuple, out)) == sorted(want)


def test_every_length_frequent(spark, monkeypatch):
    """2,048 lengths, each with more chunks than a shard holds: the plan stays as small."""
    monkeypatch.setattr(packing, "SHARD_ROWS", 2)
    df = spark.range(2_048 * 3).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), (F.col("id") % 2_048 + 1).alias("n"))
    out = packing.packed(df, length=F.col("n"))
    rows = out.collect()
    assert len(rows) == 2_048 * 3
    assert len({(r.bucket, r.batch, r.slot) for r in rows}) == len(rows)
    for b in {r.bucket for r in rows}:
        places = sorted(r.batch * (packing.BUDGET // b) + r.slot for r in rows if r.bucket == b)
        assert places == list(range(len(places)))


def test_very_long_texts_are_packed_whole(spark):
    df = spark.createDataFrame([(1, "w " * 300_000, "s", "c")], DOCS)
    out = packing.packed(df).collect()
    assert sum(r.n_tokens for r in out) == 300_000 and sorted(r.chunk for r in out) == list(range(-(-300_000 // packing.LONGEST)))

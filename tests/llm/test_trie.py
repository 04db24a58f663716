"""The trie against a plain one, over small alphabets that force splits, gaps and several batches."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tidelake.llm import registry, trie

SCHEMA = "conv_id long, turn long, role string, text string, a int, id string"


def plain(convs):
    """(conv_id, depth, parent, n_convs, n_children, n_leaves, saved, sha) of every node; convs: id -> [(role, text)]."""
    members, ends, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    for c in sorted(convs):
        path = tuple(convs[c])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
            if d:
                kids[path[: d - 1]].add(path[:d])
        ends[path].append(c)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = sum(saved[k] for k in kids[p]) + (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
    sha = lambda p: hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()
    return sorted(((members[p][0], len(p), members[p[:-1]][0] if p else -1, len(members[p]), len(kids[p]), leaves[p], saved[p], sha(p)) for p in members))


def found(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, *r[3:]) for r in df.collect())


def table(spark, convs):
    rows = [(c, n, role, text, 1, "x") for c, turns in convs.items() for n, (role, text) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("seed, batch, seekers", [(0, 1, 3), (1, 2, 5), (2, 3, 100), (3, 1024, 8192)])
def test_equals_a_plain_trie(spark, seed, batch, seekers):
    rng = random.Random(seed)
    convs = {}
    for c in range(-5, 90):
        if convs and rng.random() < 0.7:
            other = rng.choice(list(convs.values()))
            turns = other[: rng.randint(0, len(other))] + [(rng.choice("ua"), rng.choice(["", "x", "é", "long text"])) for _ in range(rng.choice([0, 0, 1, 5]))]
        else:
            turns = [(rng.choice("ua"), rng.choice("xyz")) for _ in range(rng.randint(1, 40))]
        convs[c] = turns or [("u", "")]
    got = trie.nodes(trie.turns_of(table(spark, convs)), batch, seekers)
    assert found(got) == plain(convs)


def test_chain_and_copies(spark):
    convs = {c: [("u", "t")] * (c + 1) for c in range(60)} | {c: [("u", "t")] * 30 for c in range(100, 300)}
    assert found(trie.nodes(trie.turns_of(table(spark, convs)), 4, 7)) == plain(convs)


def test_no_turns_and_nulls(spark):
    assert trie.nodes(trie.turns_of(table(spark, {}))).collect() == []
    empty = spark.createDataFrame([(5, []), (3, [])], "conv_id long, turns array<struct<a long, b long, size long>>")
    assert found(trie.nodes(empty)) == [(3, 0, -1, 2, 0, 1, 0, hashlib.sha256(b"3,5").hexdigest())]
    rows = [(1, None, None, "z"), (1, 2, "u", None), (2, 0, "", "z"), (2, 1, "u", ""), (None, 0, "u", "q"), (2, 2, "u", "w"), (2, 2, "u", "w")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert found(trie.nodes(trie.turns_of(df))) == plain({1: [("", "z"), ("u", "")], 2: [("", "z"), ("u", ""), ("u", "w"), ("u", "w")]})


def test_very_long_texts_and_conversations(spark):
    convs = {0: [("u", "x" * 200_000)] + [("a", str(i % 7)) for i in range(3_000)], 1: [("u", "x" * 200_000)] + [("a", str(i % 7)) for i in range(2_000)] + [("u", "")]}
    assert found(trie.nodes(trie.turns_of(table(spark, convs)))) == plain(convs)


def test_query_rebuilds_conversations(spark, tmp_path):
    rng = random.Random(5)
    convs = {c: [("u", rng.choice("ab")) for _ in range(rng.randint(1, 12))] for c in [*range(40), 51, 52, 63]}
    table(spark, convs).write.parquet(f"{tmp_path}/conversations.parquet")
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in convs}
    want = {c: convs.get(c - c % 5, [])[: h[c]] + convs[c][h[c] :] for c in convs}
    assert found(registry.op12_trie(spark, str(tmp_path))) == plain(want)


def test_fat_binary_search_looks_up_few_handles():
    assert [trie.two_fattest(a, b) for a, b in [(0, 7), (4, 7), (6, 7), (3, 4), (8, 15), (0, 8)]] == [4, 6, 7, 4, 12, 8]
    rng = np.random.default_rng(0)
    held = trie.ZFastTrie(0)
    seen = []

    class Counting(dict):
        def get(self, key):
            seen.append(key)
            return super().get(key)

    turns = rng.integers(0, 2, 1_000)
    for i in range(200):
        turns = np.append(turns[: rng.integers(0, 1_000)], rng.integers(0, 2, 1_000))[:1_000]
        own = [hash(tuple(turns[: d + 1].tolist())) for d in range(1_000)]
        x = trie.String(i, 1_000, np.array(own), np.array(own) ^ 5, np.arange(1_000))
        held.insert(x)
    held.handles = Counting(held.handles)
    for _ in range(20):
        seen.clear()
        held.exit(x)
        assert len(seen) <= 11

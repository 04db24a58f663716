import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tidelake.llm import simhash
from tidelake.llm.shared import connected_components

DOCS = "doc_id long, text string"


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    parts = [" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_groups(codes, max_bits=4):
    root = list(range(len(codes)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= max_bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(codes))]


def brute(rows):
    codes = [plain_fingerprint(t) for _, t in rows]
    distinct = sorted(set(codes))
    group = dict(zip(distinct, plain_groups(distinct)))
    ids = {}
    for (i, _), c in zip(rows, codes):
        if i is not None:
            ids[group[c]] = min(i, ids.get(group[c], i))
    return sorted(((i, f"{c:016x}", ids.get(group[c])) for (i, _), c in zip(rows, codes)), key=repr)


def run(spark, rows):
    df = simhash.near_groups(spark.createDataFrame(rows, DOCS))
    out = df.select("doc_id", simhash.hex16(df.fp).alias("f"), "component_id").collect()
    return sorted((tuple(r) for r in out), key=repr)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aB É\t \n", max_size=40))
def test_fingerprint_of_any_text(text):
    assert simhash.simhash(text.encode()) % 2**64 == plain_fingerprint(text)


@pytest.mark.parametrize("seed", range(6))
def test_index_finds_all_links(seed):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(12)]
    codes = set()
    for _ in range(900):
        c = rng.choice(centres)
        for _ in range(rng.randint(0, 9)):
            c ^= 1 << rng.randrange(64)
        codes.add(c)
    keys_of = sorted((rng.randrange(3), c) for c in codes)

    def rank(c):
        for s in (1, 2, 4, 8, 16, 32):
            c ^= c >> s
        return c

    keys_of.sort(key=lambda x: (x[0], rank(x[1])))
    keys = np.array([k for k, _ in keys_of])
    got = simhash.gray_links(keys, np.array([c for _, c in keys_of], dtype=np.uint64))
    for k in range(3):
        at = [i for i, x in enumerate(keys_of) if x[0] == k]
        want = plain_groups([keys_of[i][1] for i in at])
        assert [at[w] for w in want] == got[at].tolist()


def test_blocks_leave_an_equal_choice():
    for blocks in (5, 6, 7, 8):
        masks = [m % 2**64 for m in simhash.block_masks(blocks)]
        for _ in range(200):
            d = 0
            for b in random.sample(range(64), 4):
                d |= 1 << b
            assert any(d & m == 0 for m in masks)
    assert simhash.blocks_for(10) == 5 and simhash.blocks_for(3 * 10**10) == 8


@pytest.mark.parametrize("key_rows", [2, 32_768])
def test_links_of_hot_keys(spark, key_rows):
    rng = random.Random(3)
    base = rng.getrandbits(64)
    codes = {base ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(20)} | {rng.getrandbits(64) for _ in range(100)}
    signed = sorted(c - 2**64 if c >= 2**63 else c for c in codes)
    edges = simhash.links(spark.createDataFrame([(c,) for c in signed], "fp long"), key_rows=key_rows)
    got = {r.node: r.root for r in connected_components(edges).collect()}
    want = plain_groups([c % 2**64 for c in signed])
    assert [signed.index(got.get(c, c)) for c in signed] == want


def test_components_of_a_path_and_a_star(spark):
    rng = random.Random(1)
    path = list(range(60))
    edges = [(a, b) for a, b in zip(path, path[1:])] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: 0 for n in path[1:]} | {100 + i: 100 for i in range(1, 40)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_nulls_ties_and_long_texts(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(9, None), (3, ""), (4, " \n"), (None, "a b"), (5, "A b"), (6, "a b"), (6, "a b"), (None, None), (7, long), (8, long + " end"), (None, "only null ids here")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = run(spark, rows)
    assert got == brute(rows)
    assert any(i != c for i, _, c in got)


def test_one_of_each_group_stays_with_its_columns(spark):
    df = spark.createDataFrame(
        [(2, "same text of five words", 1, "x"), (1, "Same text of five words", 2, "y"), (1, "same text of five words", 3, "z"), (None, "same text of five words", 4, None), (5, "quite another text than that", 5, "fp")],
        "doc_id long, text string, rid int, fp string",
    )
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 5]


def similar_texts(seed, bases=12, copies=4, words=160):
    """Texts and copies of them with a few words changed, and texts of their own."""
    draw = random.Random(seed)
    out = []
    for _ in range(bases):
        base = [f"w{draw.randrange(4000)}" for _ in range(words)]
        out.append(" ".join(base))
        for k in range(copies):
            other = list(base)
            for at in draw.sample(range(words), k):
                other[at] = f"x{draw.randrange(4000)}"
            out.append(" ".join(other))
    draw.shuffle(out)
    return [(i + 1, t) for i, t in enumerate(out)] + [(None, None), (900, ""), (901, " ")]


def plain_set(text):
    words = (text or "").lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def plain_jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def plain_similar(rows, least=0.8):
    """Ids that stay, by the similarity of all pairs."""
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if plain_jaccard(sets[i], sets[j]) >= least:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    groups = {}
    for i, (x, _) in enumerate(rows):
        groups.setdefault(find(i), []).append((x is None, x or 0))
    return sorted(min(g) for g in groups.values())


@pytest.mark.parametrize("seed", [1, 2])
def test_similar_texts_go_as_by_all_pairs(spark, seed):
    """No text goes that all pairs keep; of those that go by all pairs a few may stay, as their keys did not meet."""
    rows = similar_texts(seed)
    kept = {(r.doc_id is None, r.doc_id or 0) for r in simhash.keep_one(spark.createDataFrame(rows, DOCS), max_bits=4, shingle=5, similar=0.8).collect()}
    want = set(plain_similar(rows))
    assert want <= kept and len(kept - want) <= 0.07 * (len(rows) - len(want))


def test_candidates_that_are_not_similar_enough_do_not_link(spark):
    """Pairs between 0.6 and 0.8 are candidates often, and both stay."""
    draw, rows = random.Random(4), []
    for n in range(40):
        base = [f"w{draw.randrange(10**6)}" for _ in range(300)]
        other = list(base)
        for at in range(0, 300, 38):  # eight words, each in five shingles: similarity of about 0.76
            other[at] = "changed"
        assert plain_jaccard(plain_set(" ".join(base)), plain_set(" ".join(other))) < 0.8
        rows += [(2 * n, " ".join(base)), (2 * n + 1, " ".join(other))]
    assert simhash.keep_one(spark.createDataFrame(rows, DOCS), shingle=5, similar=0.8).count() == 80


@pytest.mark.parametrize("blocks", [5, 6, 7, 8])
def test_pairs_of_similarity_08_meet_at_every_size(blocks):
    """Chance that two texts at 0.8 agree on a choice of blocks in one of the fingerprints that have keys."""
    draw = np.random.default_rng(blocks)
    n, pairs, masks = 300, 400, [m % 2**64 for m in simhash.block_masks(blocks)]
    common, met, near = round(n * 1.6 / 1.8), 0, 0
    for _ in range(pairs):
        same = draw.integers(0, 2**64, common, dtype=np.uint64)
        one, two = (np.concatenate([same, draw.integers(0, 2**64, n - common, dtype=np.uint64)]) for _ in range(2))
        differ = []
        for _ in range(simhash.KEYED[blocks]):
            differ.append((simhash.majority(one) ^ simhash.majority(two)) % 2**64)
            one, two = simhash.second_hashes(one), simhash.second_hashes(two)
        near += sum(d.bit_count() for d in differ[:4]) <= simhash.WIDE_BITS
        met += any(d & m == 0 for d in differ for m in masks)
    assert met / pairs > 0.88 and near / pairs > 0.97


def test_forests_connect_what_near_pairs_connect():
    draw = random.Random(6)
    codes = [[draw.getrandbits(64) for _ in range(5)] for _ in range(6)]
    rows = []
    for _ in range(400):
        c = list(draw.choice(codes))
        for _ in range(draw.randint(0, 25)):
            c[draw.randrange(5)] ^= 1 << draw.randrange(64)
        rows.append(c)
    rows = np.array(rows, dtype=np.uint64)
    a, b, bits = simhash.gray_forests(np.zeros(400, dtype=int), rows[:, 0], rows[:, 1:])
    assert len(set(zip(a, b))) == len(a) <= 3 * 399 and (bits <= simhash.WIDE_BITS).all()
    both = lambda pairs: plain_components(400, pairs)
    judge = [(i, j, sum((int(x) ^ int(y)).bit_count() for x, y in zip(rows[i, 1:], rows[j, 1:]))) for i in range(400) for j in range(i) if (int(rows[i, 0]) ^ int(rows[j, 0])).bit_count() <= simhash.OWN_BITS]
    for most in simhash.STEPS:
        assert both([(i, j) for i, j, d in judge if d <= most]) == both([(i, j) for i, j, d in zip(a, b, bits) if d <= most])


def plain_components(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in pairs:
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_second_fingerprints_are_others():
    draw = np.random.default_rng(5)
    hashes = draw.integers(0, 2**64, (400, 50), dtype=np.uint64)
    first = [simhash.majority(h) for h in hashes]
    for _ in simhash.WIDE[1:]:
        hashes = [simhash.second_hashes(h) for h in hashes]
        bits = [((simhash.majority(h) ^ f) & (2**64 - 1)).bit_count() for h, f in zip(hashes, first)]
        assert 31 < np.mean(bits) < 33


def test_texts_with_two_words_changed_are_similar():
    """Their five-word shingles have a similarity of about 0.93."""
    draw = random.Random(9)
    hits = []
    for _ in range(200):
        base = [f"w{draw.randrange(10**6)}" for _ in range(300)]
        other = list(base)
        for at in draw.sample(range(300), 2):
            other[at] = "changed"
        one, two = (simhash.wide_simhash(" ".join(x).encode(), 5) for x in (base, other))
        hits.append(sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(one, two)) <= simhash.WIDE_BITS)
    assert np.mean(hits) > 0.98


def test_a_link_behind_nearer_candidates_is_found(spark):
    """Sixty fingerprints that are all candidates of each other: the forests leave most pairs out; the
    only similar one is among those."""
    draw = random.Random(8)
    centre = [draw.getrandbits(62) for _ in range(4)]
    rows = [(n, *[c ^ 1 << draw.randrange(60) for c in centre]) for n in range(60)]
    fps = spark.createDataFrame(rows, "node long, fp long, more1 long, more2 long, more3 long")
    found = simhash.candidates(fps, 5).localCheckpoint()
    tried = {(r.a, r.b) for r in found.where("tried").collect()}
    a, b = next((i, j) for j in range(59, 0, -1) for i in range(j) if (i, j) not in tried)
    own = {n: [1000 * n + i for i in range(20)] for n in range(60)}
    own[b] = own[a][:18] + [-1]
    sets = spark.createDataFrame(list(own.items()), "node long, set array<long>")
    assert not simhash.similar_pairs(found.where("tried").select("a", "b"), sets, 0.8).collect()
    assert [tuple(r) for r in simhash.similar_links(found, sets, 0.8).collect()] == [(a, b)]


def test_rest_pairs_hold_all_similar_pairs_of_different_parts(spark):
    draw = random.Random(3)
    sets = {}
    for n in range(120):
        base = random.Random(n % 4).sample(range(10**6), 10 + 15 * (n % 4))
        gone = set(draw.sample(base, draw.randint(0, len(base) // 5)))
        sets[n] = sorted({x if x not in gone else draw.randrange(10**6) for x in base})
    parts = {n: n % 7 for n in sets}
    nodes = spark.createDataFrame(list(parts.items()), "node long, part long")
    frame = spark.createDataFrame(list(sets.items()), "node long, set array<long>")
    got = {(r.a, r.b) for r in simhash.rest_pairs(nodes, frame, 0.8).collect()}
    want = {(i, j) for j in sets for i in range(j) if parts[i] != parts[j] and plain_jaccard(set(sets[i]), set(sets[j])) >= 0.8}
    assert len(want) > 50 and want <= got and all(i < j and parts[i] != parts[j] for i, j in got)


def test_sets_of_the_last_forest_hold_every_candidate_that_no_forest_took():
    draw = random.Random(12)
    centre = [draw.getrandbits(64) for _ in range(5)]
    rows = np.array([[c ^ 1 << draw.randrange(64) ^ 1 << draw.randrange(64) for c in centre] for _ in range(120)], dtype=np.uint64)
    a, b, _, root = simhash._forests(np.zeros(120, dtype=int), rows[:, 0], rows[:, 1:])
    of, member = simhash._open_sets(np.arange(120), root)
    where, taken = dict(zip(member.tolist(), of.tolist())), {frozenset(p) for p in zip(a.tolist(), b.tolist())}
    bits = lambda i, j: sum((int(x) ^ int(y)).bit_count() for x, y in zip(rows[i, 1:], rows[j, 1:]))
    left = [(i, j) for i in range(120) for j in range(i) if bits(i, j) <= simhash.WIDE_BITS and frozenset((i, j)) not in taken]
    assert len(left) > 1000 and all(i in where and where[i] == where.get(j) for i, j in left)


def cloud(n, seed=5, least=0.8):
    """Near copies in one cloud: sets, parts, and what links beyond the parts connect."""
    draw = random.Random(seed)
    base = draw.sample(range(10**6), 60)
    sets = {i: sorted({x if draw.random() > draw.choice((0.03, 0.12, 0.2)) else draw.randrange(-(2**60), 2**60) for x in base}) for i in range(n)}
    parts = {i: i // 9 * 9 if i < n // 2 else i for i in range(n)}
    pairs = [(i, j) for j in sets for i in range(j) if parts[i] != parts[j] and plain_jaccard(set(sets[i]), set(sets[j])) >= least]
    return sets, parts, pairs


@pytest.mark.parametrize("block_words", [simhash.BLOCK_WORDS, 2_000, 300])
def test_rest_links_connect_what_all_pairs_connect(spark, block_words):
    sets, parts, pairs = cloud(150)
    nodes = spark.createDataFrame([(i % 2, i, parts[i] + i % 2) for i in sets], "cloud long, node long, part long")
    frame = spark.createDataFrame(list(sets.items()), "node long, set array<long>")
    got = [(r.a, r.b) for r in simhash.rest_links(nodes, frame, 0.8, block_words).collect()]
    apart = [(parts[i] + i % 2, i) for i in sets]
    assert got and set(got) <= set(pairs)
    assert plain_components(200, apart + got) == plain_components(200, apart + [p for p in pairs if p[0] % 2 == p[1] % 2])


def test_texts_of_a_cloud_do_not_meet_as_rows_of_pairs(spark):
    """400 near copies, few of them similar: no join makes rows of more than a few a text."""
    sets, _, _ = cloud(400)
    found = spark.createDataFrame([(0, 1, True), *[(0, i, False) for i in sets]], "a long, b long, tried boolean")
    frame = spark.createDataFrame(list(sets.items()), "node long, set array<long>")
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    got = [(r.a, r.b) for r in simhash.similar_links(found, frame, 0.8).collect()]
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    rows = []
    for at in range(before, store.executionsCount()):
        run = store.executionsList().apply(at).executionId()
        told, plan = store.executionMetrics(run), store.planGraph(run).allNodes()
        for i in range(plan.size()):
            if "Join" in plan.apply(i).name():
                own = plan.apply(i).metrics()
                for m in (own.apply(k) for k in range(own.size())):
                    if m.name() == "number of output rows" and told.contains(m.accumulatorId()):
                        rows.append(int(told.apply(m.accumulatorId()).replace(",", "")))
    assert rows and max(rows) < 8 * len(sets)
    want = [(i, j) for j in sets for i in range(j) if plain_jaccard(set(sets[i]), set(sets[j])) >= 0.8]
    assert plain_components(400, got) == plain_components(400, want)

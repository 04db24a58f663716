import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidelake.llm import suffix


def brute(texts, w=400, join=bytes):
    seen = Counter(t[i : i + w] for t in texts for i in range(len(t) - w + 1))
    out = []
    for t in texts:
        mark = bytearray(len(t))
        for i in range(len(t) - w + 1):
            if seen[t[i : i + w]] > 1:
                mark[i : i + w] = b"\x01" * w
        spans = sum(1 for i in range(len(t)) if mark[i] and (i == 0 or not mark[i - 1]))
        out.append((len(t), sum(mark), spans, join(c for c, m in zip(t, mark) if not m)))
    return out


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = suffix.dedup(df, **more).collect()
    return sorted((r.doc.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in out)


def want(rows, w=400):
    found = brute([(t or "").encode() for _, t in rows], w)
    return sorted((i, n, r, s, hashlib.sha256(k).hexdigest()) for (i, _), (n, r, s, k) in zip(rows, found))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60))
def test_suffix_array(s):
    s = [*s, 0]
    assert suffix.grouped_suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])


def noise(rng, n, letters="abcdefgh "):
    return "".join(rng.choices(letters, k=n))


def fixture(rng):
    passage, other = noise(rng, 700), noise(rng, 450, "abcé ö")
    rows = [(i, noise(rng, rng.randint(0, 900)) + passage[rng.randint(0, 200) : rng.randint(500, 700)] + noise(rng, rng.randint(0, 900))) for i in range(20)]
    rows += [(30 + i, noise(rng, 300) + other + noise(rng, 50 * i)) for i in range(4)]
    rows += [(40, noise(rng, 399)), (41, rows[3][1]), (42, "a" * 1500), (43, noise(rng, 60) * 20), (44, None), (45, ""), (46, passage + passage)]
    edited = list(rows[5][1] * 3)
    for _ in range(4):
        edited[rng.randrange(len(edited))] = "#"
    return rows + [(47, "".join(edited)), (48, noise(rng, 400)), (49, "a" * 400)]


@pytest.mark.parametrize("seed,group_rows", [(1, suffix.GROUP_ROWS), (2, 8), (3, 2)])
def test_against_all_windows(spark, seed, group_rows):
    rows = fixture(random.Random(seed))
    got = run(spark, rows, group_rows=group_rows)
    assert got == want(rows)
    assert any(r[2] for r in got)


@pytest.mark.parametrize("shape", [suffix.Shape(100, 20, 8), suffix.Shape(230, 64, 16), suffix.Shape(64, 64, 32)])
def test_other_windows(spark, shape):
    rows = fixture(random.Random(shape.window))
    got = run(spark, rows, shape=shape, group_rows=8)
    assert got == want(rows, shape.window)
    assert any(r[2] for r in got)


@pytest.mark.parametrize("group_rows", [suffix.GROUP_ROWS, 3])
def test_passages_of_words(spark, group_rows):
    """Words in a row that occur elsewhere too go, whatever blanks stand between them."""
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 9))) for _ in range(400)]
    some = lambda n: [rng.choice(words) for _ in range(n)]
    passage = some(60)
    texts = [some(rng.randint(0, 80)) + passage[rng.randint(0, 5) : rng.randint(52, 60)] + some(rng.randint(0, 80)) for _ in range(12)]
    texts += [some(50), some(51), passage[:50], [], ["x"] * 300]
    texts.append(list(texts[13]))
    rows = [(i, rng.choice([" ", "\n", " \t"]).join(t)) for i, t in enumerate(texts)] + [(90, None), (91, " ")]
    got = {r.doc_id: r.text for r in suffix.cleaned(spark.createDataFrame(rows, "doc_id long, text string"), shape=suffix.PASSAGES).collect()}
    number = {w: i for i, w in enumerate({w for t in texts for w in t})}
    kept = brute([tuple(number[w] for w in t) for t in texts], suffix.PASSAGES.window, tuple)
    back = {i: w for w, i in number.items()}
    for i, (n, removed, _, k) in enumerate(kept):
        assert got[i].split() == [back[w] for w in k]
        assert removed == n - len(k)
    assert got[90] is None and got[91] == " "
    assert sum(r > 0 for _, r, _, _ in kept) > 5


def test_a_gram_in_very_many_segments_is_split(spark, monkeypatch):
    """No array is larger than the bound, and the result is the same."""
    rng = random.Random(4)
    line = noise(rng, 390)
    rows = [(i, noise(rng, 30) + line + noise(rng, 30)) for i in range(300)]
    rows += [(1_000 + i, rows[i][1][:440]) for i in range(5)]
    assert run(spark, rows, group_rows=20) == want(rows)


def test_arrays_compare_symbols_not_hashes(monkeypatch):
    """Equal windows are found from the suffix order even if every hash were the same."""
    rng = random.Random(6)
    common = noise(rng, 430).encode()
    parts = [np.frombuffer(common[:420], dtype=np.uint8), np.frombuffer(common[3:], dtype=np.uint8)]
    monkeypatch.setattr(suffix, "_hashes", None)
    flags, first = suffix.repeated_windows(parts, [100, 97])
    assert first.tolist() == [0, 21]
    assert np.flatnonzero(flags).tolist() == [*range(3, 21), *range(21, 21 + 18)]


def test_long_texts_are_cut_alike(spark, monkeypatch):
    rng = random.Random(5)
    one = noise(rng, 30_000)
    rows = [(1, one), (2, noise(rng, 777) + one[9_000:15_000] + noise(rng, 5_000))]
    monkeypatch.setattr(suffix, "STRETCH", 4_096)
    texts = [t.encode() for _, t in rows]
    places = [suffix.segments(np.frombuffer(t, dtype=np.uint8)) for t in texts]
    assert all(sum(p[1]) == len(t) - 399 for p, t in zip(places, texts))
    assert run(spark, rows) == want(rows)


def test_edges(spark):
    assert run(spark, []) == []
    rows = [(1, "x" * 399), (1, "x" * 399), (2, "y" * 400), (2, "y" * 400), (3, None)]
    assert run(spark, rows) == want(rows)


def test_columns_stay_and_characters_stay_whole(spark):
    rng = random.Random(8)
    common = noise(rng, 500)
    df = spark.createDataFrame(
        [(1, "é" + common + "é", 7, "r"), (2, "è" + common + "ê", 8, None), (3, None, 9, "kept"), (4, "short", 1, "s")],
        "doc_id long, text string, start int, spans string",
    )
    out = suffix.cleaned(df)
    assert out.columns == df.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {1: "é", 2: "è", 3: None, 4: "short"} or got == {1: "éé", 2: "èê", 3: None, 4: "short"}


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = run(spark, rows)
    assert got == want(rows)
    assert any(r[2] for r in got)

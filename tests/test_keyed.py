"""Stored tables: merges rewrite what they touch, replays start from before, leftovers are not read."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tidelake.operators import history, state
from tidelake.sources.keyed import KeyedTable
from tests.test_history_trips import changes, windows

ROWS = "k long, lsn long, v string"
guarded = lambda old, new: state.latest_state(new, ["k"]) if old is None else state.merge_latest_guarded(old, new, ["k"])


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def table(spark, path, buckets=8):
    return KeyedTable(spark, str(path), ["k"], buckets)


def content(t, before=None):
    return {r.k: (r.lsn, r.v) for r in t.read(before).collect()}


def test_a_merge_leaves_the_files_of_other_buckets(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    assert t.read() is None
    assert t.merge(spark.range(200).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("lsn"), F.lit("a").alias("v")), 0, guarded) == list(range(8))
    before = files(t.path)
    touched = t.merge(spark.createDataFrame([(5, 2, "b"), (5, 3, "c"), (1000, 2, "n")], ROWS), 1, guarded)
    after = files(t.path)
    assert 1 <= len(touched) <= 2
    assert len(after - before) == len(touched) and before <= after
    assert content(t)[5] == (3, "c") and content(t)[1000] == (2, "n") and len(content(t)) == 201
    # a further merge of the same buckets removes the copies before the last one
    t.merge(spark.createDataFrame([(5, 4, "d")], ROWS), 2, guarded)
    t.merge(spark.createDataFrame([(5, 5, "e")], ROWS), 3, guarded)
    assert content(t)[5] == (5, "e") and all(f in files(t.path) for f in before if f"bucket={touched[0]}/" not in f and f"bucket={touched[-1]}/" not in f)
    assert len(files(t.path)) <= 8 + 2 * len(touched)


def test_disk_grows_with_changes(spark, tmp_path):
    t = table(spark, tmp_path / "t", 16)
    t.merge(spark.range(1_000).select(F.col("id").alias("k"), F.lit(0).cast("long").alias("lsn"), F.lit("x").alias("v")), 0, guarded)
    for n in range(1, 7):
        t.merge(spark.createDataFrame([(n % 2, n, "y")], ROWS), n, guarded)
    assert len(files(t.path)) <= 16 + 2


@pytest.mark.parametrize("add", [lambda old, new: new if old is None else old.unionByName(new)])
def test_a_batch_that_runs_again_counts_once(spark, tmp_path, add):
    t = table(spark, tmp_path / "t", 4)
    first, second = spark.createDataFrame([(1, 1, "a"), (2, 1, "a")], ROWS), spark.createDataFrame([(1, 2, "b")], ROWS)
    for number, batch in ((0, first), (1, second), (1, second)):
        t.merge(batch, number, add)
    assert sorted((r.k, r.lsn) for r in t.read().collect()) == [(1, 1), (1, 2), (2, 1)]
    assert sorted((r.k, r.lsn) for r in t.read(before=1).collect()) == [(1, 1), (2, 1)]


def test_what_an_unfinished_batch_left_is_not_read(spark, tmp_path):
    t = table(spark, tmp_path / "t", 4)
    t.merge(spark.createDataFrame([(1, 1, "a")], ROWS), 0, guarded)
    b = t.versions().popitem()[0]
    left = spark.createDataFrame([(1, 9, "broken off"), (77, 9, "broken off")], ROWS)
    left.coalesce(1).write.parquet(f"{t.path}/bucket={b}/version=1")
    assert content(t) == {1: (1, "a")}
    t.merge(spark.createDataFrame([(1, 2, "b")], ROWS), 1, guarded)
    assert content(t) == {1: (2, "b")}
    t.merge(spark.createDataFrame([], ROWS), 2, guarded)
    assert content(t) == {1: (2, "b")} and t.batches() == [0, 1, 2]


@pytest.mark.parametrize("seed", range(2))
def test_history_in_batches_equals_one_shot(spark, tmp_path, seed):
    """scd2_stage and merge_scd2 on a stored dimension, with a replayed batch."""
    rng = random.Random(seed)
    rows = [(rng.randrange(6), lsn, rng.choice("AB")) for lsn in range(30)]
    t = KeyedTable(spark, str(tmp_path / "dim"), ["k"], 4)

    def merge(old, batch):
        if old is None:
            return history.scd2_versions(batch, "k")
        new = history.scd2_versions(batch, "k", old.where("is_current"))
        return history.merge_scd2(old, history.scd2_stage(new, "k"), "k")

    for number, (low, high) in enumerate(((0, 9), (9, 20), (0, 20), (20, 30))):
        t.merge(changes(spark, rows[low:high]), number, merge)
    assert windows(t.read()) == windows(history.scd2_versions(changes(spark, rows), "k"))


def test_merge_scd2_closes_and_adds(spark):
    old = history.scd2_versions(changes(spark, [(1, 1, "A"), (1, 2, "B"), (2, 1, "A")]), "k")
    new = history.scd2_versions(changes(spark, [(1, 5, "C"), (1, 6, "D"), (3, 5, "A")]), "k", old.where("is_current"))
    got = windows(history.merge_scd2(old, history.scd2_stage(new, "k"), "k"))
    assert got == windows(history.apply_changes(old, changes(spark, [(1, 5, "C"), (1, 6, "D"), (3, 5, "A")]), "k"))
    assert [(k, lsn, now) for k, lsn, _, _, now in got] == [(1, 1, False), (1, 2, False), (1, 5, False), (1, 6, True), (2, 1, True), (3, 5, True)]

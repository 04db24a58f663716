import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidelake.functions.geo import bearing_deg, haversine_km
from tidelake.functions.keys import attribute_hash, surrogate_key
from tidelake.operators import history, trips

CHANGES = "k long, lsn long, valid_from timestamp, attr_hash string, is_deleted boolean"


def at(n):
    return dt.datetime(2024, 1, 1, tzinfo=dt.UTC) + dt.timedelta(hours=n)


def naive(n):
    return at(n).replace(tzinfo=None)


def changes(spark, rows):
    return spark.createDataFrame([(k, lsn, at(lsn), h, False) for k, lsn, h in rows], CHANGES)


def windows(df):
    return sorted((r.k, r.lsn, r.valid_from, r.valid_to, r.is_current) for r in df.select("k", "lsn", F.col("valid_from").cast("timestamp_ntz"), F.col("valid_to").cast("timestamp_ntz"), "is_current").collect())


def test_a_chain_and_back_again_is_three_versions(spark):
    got = windows(history.scd2_versions(changes(spark, [(1, 3, "A"), (1, 1, "A"), (1, 2, "B"), (1, 4, "A"), (2, 9, "Z")]), "k"))
    assert got == [(1, 1, naive(1), naive(2), False), (1, 2, naive(2), naive(3), False), (1, 3, naive(3), None, True), (2, 9, naive(9), None, True)]


@pytest.mark.parametrize("seed", range(3))
def test_any_split_into_batches_gives_the_one_shot_result(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.randrange(4), lsn, rng.choice("AB")) for lsn in range(24)]
    cuts = sorted(rng.sample(range(1, 24), 2))
    table = None
    for low, high in ((0, cuts[0]), (cuts[0], cuts[1]), (0, cuts[1]), (cuts[1], 24)):  # the third is a replay
        table = history.apply_changes(table, changes(spark, rows[low:high]), "k")
        table = spark.createDataFrame(table.collect(), table.schema)
    assert windows(table) == windows(history.scd2_versions(changes(spark, rows), "k"))
    assert history.scd2_overlaps(table, "k").count() == 0 and history.scd2_orphaned_windows(table, "k").count() == 0


def test_restated_value_opens_nothing_across_batches(spark):
    table = history.apply_changes(None, changes(spark, [(1, 1, "A")]), "k")
    assert len(windows(history.apply_changes(table, changes(spark, [(1, 2, "A")]), "k"))) == 1


def test_as_of_takes_the_begin_and_not_the_end(spark):
    dim = history.scd2_effective_from(history.scd2_versions(changes(spark, [(1, 5, "A"), (1, 10, "B")]), "k"), "k")
    facts = spark.createDataFrame([(i, 1, at(h)) for i, h in enumerate((0, 5, 9, 10, 50))] + [(9, 2, at(5))], "id long, k long, ts timestamp")
    got = {r.id: r.h for r in history.scd2_as_of_join(facts, dim, "k", "ts", {"attr_hash": "h"}).collect()}
    assert got == {0: "A", 1: "A", 2: "A", 3: "B", 4: "B", 9: None}


@pytest.mark.parametrize("seed", range(2))
def test_as_of_join_equals_the_range_join(spark, seed):
    """Gaps, nulls, many buckets of time and equal times, against the pairs of a range join."""
    rng = random.Random(seed)
    days = lambda n: at(24 * n)
    rows = []
    for k in range(5):
        cuts = sorted(rng.sample(range(0, 900), 8))
        rows += [(k, days(a), None if b == cuts[-1] and k % 2 else days(b), f"{k}-{a}") for a, b in zip(cuts, cuts[1:]) if rng.random() < 0.8]
    dim = spark.createDataFrame([*rows, (None, days(1), None, "n")], "k long, effective_from timestamp, valid_to timestamp, h string")
    facts = spark.createDataFrame([(i, rng.choice([0, 1, 2, 3, 4, 7, None]), rng.choice([None, *map(days, range(-5, 950))])) for i in range(400)], "id long, k long, ts timestamp")
    got = history.scd2_as_of_join(facts, dim, "k", "ts", {"h": "h"})
    assert got.columns == ["id", "k", "ts", "h"]
    side = dim.withColumnRenamed("k", "j")
    pairs = facts.join(side, (F.col("k") == F.col("j")) & history.in_force(F.col("ts"), F.col("effective_from"), F.col("valid_to")), "left")
    assert {(r.id, r.h) for r in got.collect()} == {(r.id, r.h) for r in pairs.collect()} and got.count() == 400


def test_as_of_join_of_a_hot_key(spark):
    """10,000 versions and 100,000 facts of one key: no pairs, many tasks."""
    dim = spark.range(10_000).select(F.lit(1).alias("k"), F.timestamp_seconds(F.col("id") * 3600).alias("effective_from"), F.timestamp_seconds((F.col("id") + 1) * 3600).alias("valid_to"), F.col("id").alias("v"))
    facts = spark.range(100_000).select("id", F.lit(1).alias("k"), F.timestamp_seconds(F.col("id") * 360 + 1).alias("ts"))
    got = history.scd2_as_of_join(facts, dim, "k", "ts", {"v": "v"})
    assert got.where(F.col("v") != F.floor((F.col("id") * 360 + 1) / 3600)).count() == 0 and got.where("v is not null").count() == 100_000


def test_one_key_with_all_facts_of_a_day_is_many_tasks(spark):
    """The longest range of the sequence, null keys and times, and the path by a row key."""
    dim = spark.createDataFrame([(1, at(0), at(6), "a"), (1, at(6), None, "b"), (2, at(0), None, "c")], "k long, effective_from timestamp, valid_to timestamp, h string")
    second = F.lit(at(0)) + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)") * F.lit(86_400) / 40_000)
    facts = spark.range(40_000).select("id", F.when(F.col("id") % 10 == 0, None).otherwise(F.lit(1)).cast("long").alias("k"), F.when(F.col("id") % 7 != 0, second).alias("ts"), F.lit("wide").alias("more"))
    want = F.when(F.col("k").isNull() | F.col("ts").isNull(), None).when(F.col("ts") < F.lit(at(6)), "a").otherwise("b")
    for row_key in ((), ("id",)):
        got = history.scd2_as_of_join(facts, dim, "k", "ts", {"h": "h"}, row_key=row_key)
        assert got.columns == ["id", "k", "ts", "more", "h"] and got.count() == 40_000
        assert got.where(~F.col("h").eqNullSafe(want)).count() == 0
    side = dim.select(F.col("k").alias("__k"), F.col("effective_from").alias("__t"), F.lit(0).alias("__kind"), F.coalesce("valid_to", F.lit(at(999))).alias("__end"), F.struct("h").alias("__v"))
    asked = facts.where("k is not null and ts is not null").select(F.col("k").alias("__k"), F.col("ts").alias("__t"), "id", F.lit(1).alias("__kind"))
    told = history._last_before(asked.unionByName(side, allowMissingColumns=True), ["id"], 2_000)
    assert told.count() == asked.count() and told.where("__v is null").count() == 0
    spread = asked.repartitionByRange(16, "__k", "__t").groupBy(F.spark_partition_id()).count()
    assert spread.count() >= 12 and spread.agg(F.max("count")).first()[0] < asked.count() / 4


def test_as_of_ranges_without_versions_carry_on(spark):
    """Ranges that hold no version take the one of several ranges before; other keys do not."""
    rows = [(1, 0, 0, "a"), *[(1, n, 1, None) for n in range(1, 200)], *[(2, n, 1, None) for n in range(50)], (2, 25, 0, "b"), (3, 1, 1, None)]
    df = spark.createDataFrame(rows, "__k long, __t long, __kind int, v string").withColumn("__v", F.when(F.col("v").isNotNull(), F.struct("v"))).withColumn("__end", F.lit(0)).drop("v")
    got = {(r["__k"], r["__t"]): r["__v"] and r["__v"].v for r in history._last_before(df, [], 10).collect()}
    assert got == {(k, t): "a" if k == 1 else "b" if k == 2 and t >= 25 else None for k, t, kind, _ in rows if kind}


@pytest.mark.parametrize("most", [None, 40])
def test_dealt_facts_take_the_version_in_force(spark, most):
    """As the range join: gaps, nulls, equal times, a time that half of a key's facts share, keys cut by time (40) and not."""
    rng = random.Random(3)
    days = lambda n: at(24 * n)
    rows = []
    for k in range(6):
        cuts = sorted(rng.sample(range(0, 900), 8))
        rows += [(k, days(a), None if b == cuts[-1] and k % 2 else days(b), f"{k}-{a}") for a, b in zip(cuts, cuts[1:]) if rng.random() < 0.8]
    # a version without length begins with the one that lasts; key 5 has one version, long before its facts
    rows = [r for r in rows if r[0] != 5] + [(4, days(901), days(901), "none"), (4, days(901), None, "lasts"), (5, days(0), None, "old"), (None, days(1), None, "n")]
    dim = spark.createDataFrame(rows, "k long, effective_from timestamp, valid_to timestamp, h string")
    asked = [(i, rng.choice([0, 1, 2, 3, 4, 4, 4, 7, None]), rng.choice([None, days(300), days(901), *map(days, range(-5, 950, 5))])) for i in range(600)]
    asked += [(600 + i, 5, days(500) if i % 2 else days(400 + i)) for i in range(200)]
    facts = spark.createDataFrame(asked, "id long, j long, ts timestamp")
    got = history.scd2_as_of_dealt(facts, dim, "k", "ts", {"h": "h"}, fact_key="j", most=most)
    assert got.columns == ["id", "j", "ts", "h"]
    pairs = facts.join(dim, (F.col("k") == F.col("j")) & history.in_force(F.col("ts"), F.col("effective_from"), F.col("valid_to")), "left")
    want = {(r.id, r.h) for r in pairs.collect()}
    assert {(r.id, r.h) for r in got.collect()} == want and got.count() == 800 and sum(h is not None for _, h in want) > 300


def test_a_dealt_key_of_many_facts_is_many_groups(spark):
    """One key with all facts: no group of the window has more than a part of them, and lines travel once."""
    dim = spark.range(1_000).select(F.lit(1).alias("k"), F.timestamp_seconds(F.col("id") * 3600).alias("effective_from"), F.timestamp_seconds((F.col("id") + 1) * 3600).alias("valid_to"), F.col("id").alias("v"))
    facts = spark.range(20_000).select("id", F.lit(1).alias("k"), F.timestamp_seconds(F.col("id") * 180 + 1).alias("ts"))
    got = history.scd2_as_of_dealt(facts, dim, "k", "ts", {"v": "v"}, most=1_000)
    assert got.where(~F.col("v").eqNullSafe(F.floor((F.col("id") * 180 + 1) / 3600))).count() == 0 and got.count() == 20_000
    spread = history.scd2_as_of_dealt(facts.withColumn("one", F.lit(1)), dim, "k", "ts", {"v": "v"}, most=1_000).groupBy(F.spark_partition_id()).count()
    assert spread.agg(F.max("count")).first()[0] < 20_000


def test_null_and_empty_differ_in_hashes(spark):
    df = spark.createDataFrame([(None, "a"), ("", "a"), ("a", None)], "x string, y string")
    assert df.select(attribute_hash(["x", "y"]).alias("h")).distinct().count() == 3
    assert df.select(surrogate_key(["x", "y"]).alias("h")).distinct().count() == 3


PINGS = "rider_id long, trip_id string, lat double, lon double, speed_kmph double, event_ts timestamp"


def test_trip_ends_are_by_event_time(spark):
    rows = [(1, "t", 12.95, 77.6, 20.0, at(3)), (1, "t", 12.936, 77.6, 10.0, at(1)), (1, "t", 12.94, 77.6, 30.0, at(2)), (2, "t", 12.9, 77.6, 0.0, at(1)), (2, "t", 12.9, 77.6, 0.0, at(2))]
    got = {r.rider_id: r for r in trips.trips(spark.createDataFrame(rows, PINGS)).collect()}
    assert len(got) == 2 and got[1].start_lat == 12.936 and got[1].end_lat == 12.95
    assert got[1].straight_line_km == pytest.approx(1.557, abs=0.02) and got[1].duration_s == 7200 and got[1].avg_speed_kmph == 20
    assert got[2].straight_line_km == 0


def test_bearings(spark):
    df = spark.createDataFrame([(0.0, 0.0, 1.0, 0.0), (0.0, 0.0, 0.0, 1.0), (0.0, 0.0, -1.0, 0.0), (0.0, 0.0, 0.0, -1.0)], "a double, b double, c double, d double")
    c = [F.col(x) for x in "abcd"]
    assert [round(r[0]) for r in df.select(bearing_deg(*c)).collect()] == [0, 90, 180, 270]
    assert df.select(haversine_km(c[0], c[1], c[0], c[1])).first()[0] == 0


def test_orphaned_windows_meet_without_a_join(spark):
    """Nulls, windows without length, and no broadcast however small the versions seem."""
    rows = [(1, at(1), at(2), "a"), (1, at(2), at(9), "b"), (1, at(5), at(5), "c"), (2, at(9), at(1), "d"), (3, at(1), None, "e"), (None, at(1), at(1), "f"), (4, None, at(4), "g")]
    df = spark.createDataFrame(rows, "k long, valid_from timestamp, valid_to timestamp, name string")
    got = history.scd2_orphaned_windows(df, "k")
    assert got.columns == df.columns and {r.name for r in got.collect()} == {"b", "d", "f", "g"}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Broadcast" not in plan


def test_changes_at_one_position_have_one_order(spark):
    """However the rows arrive, changes of a key that share a log position give the same versions."""
    rows = [(k, lsn, h) for k in range(20) for lsn in (1, 2) for h in "ABC"]
    shown = lambda df: sorted((r.k, r.lsn, r.attr_hash, r.is_current) for r in df.select("k", "lsn", "attr_hash", "is_current").collect())
    one, other = (shown(history.scd2_versions(changes(spark, x).coalesce(1), "k")) for x in (rows, rows[::-1]))
    assert one == other


def test_first_versions_need_two_windows_and_nothing_of_open_rows(spark):
    """Of no open row nothing has to be known: only the change before and the one behind are looked at."""
    rows = spark.createDataFrame([(1, 1, 10, "a"), (1, 2, 20, "a"), (1, 3, 30, "b"), (2, 1, 5, "a")], "k long, lsn long, valid_from long, attr_hash string")
    got = history.scd2_versions(rows, "k")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 2
    assert sorted(tuple(r) for r in got.select("k", "lsn", "valid_to", "is_current").collect()) == [(1, 1, 30, False), (1, 3, None, True), (2, 1, None, True)]


def test_versions_of_rows_dealt_by_bucket_are_not_shuffled_again(spark, tmp_path):
    from tidelake.sources.keyed import KeyedTable

    rows = spark.createDataFrame([(k, n, 10 * n, "ab"[n % 2]) for k in range(40) for n in range(3)], "k long, lsn long, valid_from long, attr_hash string")
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"], 4)
    made = []

    def merge(old, batch):
        made.append(history.scd2_versions(table.dealt(batch), ["bucket", "k"]))
        return made[-1]

    assert table.merge(rows, 0, merge) == [0, 1, 2, 3]
    plan = made[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    want = history.scd2_versions(rows, "k")
    names = ["k", "lsn", "valid_from", "valid_to", "is_current"]
    assert sorted(map(tuple, table.read().select(names).collect()), key=repr) == sorted(map(tuple, want.select(names).collect()), key=repr)
    # a bucket is one file
    assert len(table.read().inputFiles()) == 4

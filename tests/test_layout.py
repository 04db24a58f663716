"""Layouts by several keys, mergeable aggregates, counts observed in passing."""

import random

import pytest
from pyspark.sql import functions as F

from tidelake.operators import decode, reports
from tidelake.plans import marts
from tidelake.sources import tables


def test_a_lookup_by_either_key_reads_few_files(spark, tmp_path):
    rows = spark.range(40_000).select(F.col("id").alias("a"), F.concat(F.lit("k"), F.lpad((F.col("id") * 7919 % 40_009).cast("string"), 6, "0")).alias("b"), F.lit("x").alias("c"))
    rows.write.parquet(f"{tmp_path}/in")
    assert tables.maintain_layout(spark, f"{tmp_path}/in", f"{tmp_path}/out", ["a", "b"], 64)[1] == 64
    out = spark.read.parquet(f"{tmp_path}/out")
    assert tables.share_read(out, "a") < 0.25 and tables.share_read(out, "b") < 0.25
    assert out.count() == 40_000 and out.columns == ["a", "b", "c"]
    tables.maintain_layout(spark, f"{tmp_path}/in", f"{tmp_path}/one", "a", 16)
    one = spark.read.parquet(f"{tmp_path}/one")
    assert tables.share_read(one, "a") < 0.1 and tables.share_read(one, "b") > 0.9


def test_share_of_files_is_counted_over_all_values(spark, tmp_path):
    rng = random.Random(2)
    parts = [sorted(rng.sample(range(60), 5)) for _ in range(7)]
    for i, part in enumerate(parts):
        spark.createDataFrame([(v,) for v in part] + [(None,)], "k int").coalesce(1).write.mode("append").parquet(f"{tmp_path}/t")
    values = {v for p in parts for v in p}
    want = sum(sum(p[0] <= v <= p[-1] for p in parts) for v in values) / len(values) / 7
    assert tables.share_read(spark.read.parquet(f"{tmp_path}/t"), "k") == pytest.approx(want)


def test_odd_keys_of_a_layout(spark, tmp_path):
    rows = spark.createDataFrame([(None, None), (1, "a"), (1, None), (None, "ü"), (1, "a")], "a int, b string")
    assert sorted(map(repr, tables.clustered(rows, ["a", "b"], 3).collect())) == sorted(map(repr, rows.collect()))
    assert tables.clustered(rows.limit(0), ["a", "b"], 3).count() == 0
    rows.write.parquet(f"{tmp_path}/t")
    assert tables.files_of(spark, f"{tmp_path}/t") == 1 and tables.files_of(spark, f"{tmp_path}/t", 100) > 1
    assert tables.maintain_layout(spark, f"{tmp_path}/t", f"{tmp_path}/u", ["a", "b"])[1] == 1


def test_periods_come_from_parts(spark):
    facts = spark.range(30_000).select(
        F.timestamp_seconds(F.col("id") * 600).alias("placed_ts"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("c"), F.col("id") % 3)).alias("city"), (F.col("id") % 5).alias("restaurant_id"), (F.col("id") * 31 % 997 / 7.0).alias("total_minutes"),
        (F.col("id") % 11 != 0).alias("is_delivered"), (F.col("id") % 4 == 0).alias("sla_breach_flag"), *[F.col("id").cast("decimal(10,2)").alias(c) for c in ("gross_revenue_inr", "commission_inr", "contribution_margin_inr")],
    )
    got = {r.city: r for r in marts.sla_period(marts.sla_parts(facts), ["city"]).collect()}
    done = facts.where("is_delivered")
    for r in done.groupBy("city").agg(F.count(F.lit(1)).alias("n"), F.count_if("sla_breach_flag").alias("late"), F.sum("gross_revenue_inr").alias("s")).collect():
        assert (got[r.city].delivered_orders, got[r.city].breached_orders, got[r.city].gross_revenue_inr) == (r.n, r.late, r.s)
        own = done.where(F.col("city").eqNullSafe(F.lit(r.city)))
        for name, q in (("p50_total_minutes", 0.5), ("p95_total_minutes", 0.95)):
            assert own.where(F.col("total_minutes") <= got[r.city][name]).count() / r.n == pytest.approx(q, abs=0.02)
    assert len(got) == 3 and marts.sla_period(marts.sla_parts(facts.limit(0)), ["city"]).count() == 0


def test_messages_are_counted_as_they_land(spark):
    rows = [("m", i, None if i % 5 == 0 else b"x", None if i % 7 == 0 else "u", i // 2) for i in range(70)]
    batch = spark.createDataFrame(rows, "topic string, offset int, value binary, op string, lsn int")
    seen, told = reports.observed_kinds(batch, decode.kind_of("op"), "t")
    landed = tables.stored(seen.where(decode.kind_of("op") == "good").dropDuplicates(["lsn"]))
    row = reports.reconcile_counts(told, landed, ["lsn"]).first()
    good = {r[4] for r in rows if r[2] is not None and r[3] is not None}
    assert (row.messages, row.tombstones, row.quarantined, row.landed, row.is_consistent) == (70, 14, 8, len(good), True)
    plain = reports.reconcile_counts(batch.select(decode.kind_of("op").alias("kind")), landed, ["lsn"]).first()
    assert plain == row


def test_rows_without_a_day_outlive_a_backfill(spark):
    import datetime as dt

    day = dt.date(2024, 1, 1)
    df = spark.createDataFrame([(day, 1), (None, 2)], "d date, v int")
    assert [r.v for r in tables.without_day(df, "d", day).collect()] == [2]
    proof = reports.prove_backfill(df, lambda x: df.where(F.col("d") == F.lit(x)), "d", day).first()
    assert proof.is_equal and (proof.before_rows, proof.deleted_rows) == (1, 0)


def test_an_input_is_derived_in_as_many_tasks_as_there_are_cores(spark):
    """The tables are one split each; what is derived from them must not stay one task's, and a log's images are whole."""
    from tidelake.plans import inputs, registry, spec

    sf, cores = "/root/testdata/sf0.001", spark.sparkContext.defaultParallelism
    for name in ("order_changes", "menu_changes", "customer_changes"):
        rows = inputs.given(spark, sf, name, deal=True)
        assert rows.rdd.getNumPartitions() == cores
        assert rows.count() == inputs.given(spark, sf, name).count()
    log = registry.bronze_table(spark, sf, "order_changes", spec.ORDERS)
    assert log.where("op <> 'd' and try_variant_get(after, '$.order_id', 'bigint') is null").count() == 0
    assert spark.conf.get("spark.sql.variant.writeShredding.enabled") == "false"


def test_a_daily_aggregate_does_not_depend_on_the_order_of_rows(spark):
    """Means that lie on a half of their second decimal, summed in many orders."""
    rng = random.Random(1)
    rows = []
    for group in range(300):
        seconds = [rng.randrange(600, 4000) for _ in range(19)]
        # the sum of 20 is an odd multiple of 6 seconds: the mean's third decimal is 5
        seconds.append(600 + next(x for x in range(12) if (sum(seconds) + 600 + x) % 12 == 6))
        rows += [(group, s / 60.0) for s in seconds]
    fact = lambda given: spark.createDataFrame(given, "restaurant_id long, m double").coalesce(1).select(
        "restaurant_id", F.lit(True).alias("is_delivered"), F.lit(1).alias("date_sk"), F.lit(1).alias("weather_sk"), F.lit("c").alias("city"), F.lit("2024-01-01 10:00:00").cast("timestamp").alias("placed_ts"),
        *[F.col("m").alias(c) for c in ("total_minutes", "prep_minutes", "transit_minutes")], F.lit(False).alias("sla_breach_flag"),
        *[F.lit(1).cast("decimal(10,2)").alias(c) for c in ("gross_revenue_inr", "commission_inr", "contribution_margin_inr")],
    )
    dates = spark.sql("select 1 as date_sk, 'WEEKDAY' as day_type, false as is_weekend, false as is_holiday")
    weather = spark.sql("select 1 as weather_sk, 'CLEAR' as weather_band, false as is_rainy")
    shown = lambda x: {r.restaurant_id: r.avg_total_minutes for r in marts.agg_sla_daily(x, dates, weather).collect()}
    one, *others = (shown(fact(x)) for x in (rows, sorted(rows), sorted(rows, reverse=True)))
    assert len(one) == 300 and all(one == x for x in others)

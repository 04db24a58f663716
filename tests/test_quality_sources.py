import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidelake.operators import datatests, expectations, reports
from tidelake.sources import payloads, tables

ORDERS = (
    "order_id long, rider_id long, status string, placed_ts timestamp, promised_ts timestamp, delivered_ts timestamp, subtotal_inr decimal(10,2),"
    " delivery_fee_inr decimal(10,2), discount_inr decimal(10,2), total_inr decimal(10,2), is_deleted boolean"
)
T = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
H = dt.timedelta(hours=1)


def orders(spark, *changes):
    from decimal import Decimal as D

    base = {"order_id": 1, "rider_id": 1, "status": "DELIVERED", "placed_ts": T, "promised_ts": T + H, "delivered_ts": T + H, "subtotal_inr": D(10), "delivery_fee_inr": D(2), "discount_inr": D(1), "total_inr": D(11), "is_deleted": False}
    return spark.createDataFrame([tuple((base | c).values()) for c in changes], ORDERS)


def test_every_broken_rule_is_named_and_nulls_break_rules(spark):
    df = orders(spark, {}, {"order_id": None, "status": "x", "total_inr": None}, {"rider_id": None}, {"rider_id": None, "is_deleted": True}, {"rider_id": None, "status": "PLACED"})
    passed, failed = expectations.validate(df, expectations.order_suite())
    assert passed.count() == 3
    assert sorted(sorted(r.violations) for r in failed.collect()) == [["order_id_present", "status_is_known", "total_not_negative", "total_reconciles"], ["rider_assigned_once_picked_up"]]
    report = expectations.run_gate(df, expectations.order_suite(), "o").first()
    assert (report.total_rows, report.passed_rows, report.quarantined_rows, report.status) == (5, 3, 2, 1)
    assert expectations.run_gate(df.limit(0), expectations.order_suite(), "o").first().status == 0
    assert expectations.violation_counts(failed).count() == 5


def test_lifecycle_and_transitions(spark):
    schema = "order_id long, status string, placed_ts timestamp, accepted_ts timestamp, picked_up_ts timestamp, delivered_ts timestamp, cancel_reason string"
    rows = [
        (1, "DELIVERED", T, T + H, T + 2 * H, T + 3 * H, None), (2, "PLACED", T, T + H, None, None, None), (3, "DELIVERED", T, T + 2 * H, T + H, None, "x"), (4, "CANCELLED", T, None, None, None, None),
    ]
    got = {r.order_id: set(r.violations) for r in expectations.with_violations(spark.createDataFrame(rows, schema), expectations.lifecycle_suite()).collect()}
    assert got[1] == set() and got[2] == {"accepted_ts_not_before"} and got[4] == {"reason_exactly_if_cancelled"}
    assert got[3] == {"picked_up_ts_in_order", "delivered_ts_once_earned", "reason_exactly_if_cancelled"}
    steps = spark.createDataFrame([(1, 1, "PLACED"), (1, 2, "ACCEPTED"), (1, 3, "ACCEPTED"), (1, 4, "DELIVERED"), (2, 1, "ACCEPTED")], "order_id long, lsn long, status string")
    assert [r.lsn for r in expectations.transition_check(steps).collect()] == [4]


def test_data_tests(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, None)], "id long, v string")
    assert datatests.test_not_null(df, "id").count() == 2
    assert [tuple(r) for r in datatests.test_unique(df, "id").collect()] == [(1, 2)]
    assert {r.v for r in datatests.test_accepted_values(df, "v", ["a"]).collect()} == {"b", "c"}
    assert datatests.test_relationships(df, "id", spark.createDataFrame([(2,)], "p long"), "p").count() == 2


def test_parents_do_not_pass_through_the_driver(spark):
    """However small they seem, and however many versions a parent has; null parents are no one's, null references pass."""
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d"), (3, "e")], "id long, v string")
    parents = spark.createDataFrame([(2,), (2,), (2,), (None,)], "p long")
    got = datatests.test_relationships(df, "id", parents, "p")
    assert {r.v for r in got.collect()} == {"a", "e"} and got.columns == ["id", "v"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan


def test_freshness(spark):
    df = spark.createDataFrame([(T,), (T - 30 * H,), (None,)], "ts timestamp")
    now = F.lit(T + 2 * H)
    assert reports.freshness(df, "ts", now).first().status == "fresh"
    assert reports.freshness(df, "ts", now, 1).first().status == "stale"
    assert reports.freshness(df.limit(0), "ts", now).first().status == "error"
    with pytest.raises(ValueError):
        reports.freshness(df, "other")


def test_checksum_follows_content_and_not_order(spark):
    day = dt.date(2024, 1, 1)
    rows = [(day, "a", 1), (day, "b", None), (day + dt.timedelta(1), "c", 3)]
    of = lambda r: tuple(reports.day_checksum(spark.createDataFrame(r, "d date, c string, n long"), "d", day).first())
    assert of(rows) == of(rows[::-1]) == of([*rows[:2], (rows[2][0], "z", 9)])
    assert of(rows) != of([(day, "a", 2), *rows[1:]]) and of([])[0] == 0
    table = spark.createDataFrame(rows, "d date, c string, n long")
    proof = reports.prove_backfill(table, lambda d: table, "d", day).first()
    assert proof.is_equal and proof.deleted_rows == 0 and not reports.prove_backfill(table, lambda d: table.limit(0), "d", day).first().is_equal


def test_coverage_counts_absent_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0)], "city string, mm double")
    expected = spark.createDataFrame([("a",), ("b",), ("c",)], "city string")
    assert {(r.city, r.n, r.is_covered) for r in reports.coverage(df, "city", expected, "mm", 1).collect()} == {("a", 1, True), ("b", 1, True), ("c", 0, False)}


def test_payloads(spark):
    w = '{"daily":{"time":["2024-01-01","2024-01-02"],"precipitation_sum":[null,2.5],"temperature_2m_max":[30.0]}}'
    got = payloads.parse_weather_payload(spark.createDataFrame([("x", w), ("y", "{}"), ("z", None)], "city string, payload string")).collect()
    assert [tuple(r) for r in got] == [("x", dt.date(2024, 1, 1), None, 30.0, None), ("x", dt.date(2024, 1, 2), 2.5, None, None)]
    h = '[{"date":"2024-01-01","localName":"","name":"New Year","countryCode":"IN"},{"date":"2024-03-01","localName":"Holi","name":"x","countryCode":"IN"}]'
    assert [r.holiday_name for r in payloads.parse_holiday_payload(spark.createDataFrame([(h,), ("[]",)], "payload string")).collect()] == ["New Year", "Holi"]
    assert payloads.holiday_seed(spark).count() == 16 and dict(payloads.holiday_seed(spark).dtypes)["holiday_date"] == "date"


def test_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(dt.date(2024, 1, d), d) for d in (1, 1, 2)], "d date, n int")
    tables.append_partitioned(rows, path, "d")
    tables.overwrite_days(rows.where("n = 2").withColumn("n", F.lit(9)), path, "d")
    assert sorted(r.n for r in spark.read.parquet(path).collect()) == [1, 1, 9]
    tables.delete_day(spark, path, "d", dt.date(2024, 1, 1))
    assert [r.n for r in spark.read.parquet(path).collect()] == [9]
    empty = str(tmp_path / "e")
    tables.overwrite_extract(spark, [], payloads.WEATHER, empty)
    assert spark.read.parquet(empty).columns[0] == "city" and spark.read.parquet(empty).count() == 0
    assert tables.file_count(spark, str(tmp_path / "no")) == -1
    with pytest.raises(ValueError):
        tables.maintain_layout(spark, path, str(tmp_path / "o"), "n", 2, retention_hours=1)
    assert tables.maintain_layout(spark, path, str(tmp_path / "o"), "n", 2, dry_run=True)[0] == 1
    assert tables.register_sources(spark, {"t_here": path, "t_gone": str(tmp_path / "no")}) == ["t_here"]

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidelake.operators import decode, state
from tidelake.plans import spec

UTC = dt.UTC
RAW = "topic string, partition int, offset long, timestamp timestamp, value binary"
ENVELOPE = (
    "before struct<order_id: bigint, status: string>, after struct<order_id: bigint, status: string>, source struct<lsn: bigint>, op string, ts_ms bigint"
)
HEAD = b"\x00\x00\x00\x00\x07"


def messages(spark, bodies):
    at = dt.datetime(2024, 1, 1, tzinfo=UTC)
    rows = [("cdc.orders", 0, i, at, None if b is None else HEAD + b.encode()) for i, b in enumerate(bodies)]
    return decode.decode_envelope(decode.strip_wire_header(spark.createDataFrame(rows, RAW)), ENVELOPE)


def change(pk, lsn, op="u", status="PLACED"):
    image = f'{{"order_id":{pk},"status":"{status}"}}'
    side = f'"before":{image}' if op == "d" else f'"after":{image}'
    return f'{{{side},"source":{{"lsn":{lsn}}},"op":"{op}","ts_ms":1}}'


def test_split_is_disjoint_and_total(spark):
    df = messages(spark, [change(1, 10, "c"), change(1, 11), change(1, 12, "d"), None, "{broken", ""])
    good, tombs, bad = decode.classify_batch(df)
    assert (good.count(), tombs.count(), bad.count()) == (3, 1, 2)
    assert sorted(r.offset for part in (good, tombs, bad) for r in part.collect()) == list(range(6))
    assert {r.schema_id for r in df.collect()} == {7, None}


def test_a_delete_brings_its_old_row(spark):
    flat = decode.to_bronze_changes(decode.classify_batch(messages(spark, [change(5, 1, "c"), change(5, 2, "d")])).good, "orders")
    rows = {r.lsn: r for r in flat.collect()}
    assert rows[2].pk == 5 and rows[2].before_json and rows[2].after_json is None and rows[1].before_json is None


def test_redelivered_changes_collapse_and_real_ones_do_not(spark):
    rows = [("orders", 1, 10), ("orders", 1, 10), ("orders", 1, 11), ("orders", 2, 10), ("riders", 1, 10)]
    assert state.dedup_changes(spark.createDataFrame(rows, "source_table string, pk long, lsn long")).count() == 4


def test_ping_day_is_the_devices(spark):
    at = lambda h: dt.datetime(2024, 1, 1, h, tzinfo=UTC)
    rows = [((1, "t", 1.0, 2.0, 3.0, 4.0, 5.0, at(23)), "p", 0, 1, at(23) + dt.timedelta(hours=3))]
    schema = "ping struct<rider_id: long, trip_id: string, lat: double, lon: double, speed_kmph: double, heading_deg: double, accuracy_m: double, event_ts: timestamp>, topic string, partition int, offset long, timestamp timestamp"
    assert decode.to_bronze_pings(spark.createDataFrame(rows, schema)).first().event_date == dt.date(2024, 1, 1)


def test_payload_types_absent_fields_and_garbage(spark):
    rows = [
        ("u", 1, 0, None, '{"order_id":1,"status":"PLACED","placed_ts":"2024-01-01T10:00:00.123456Z","subtotal_inr":12.50}'),
        ("u", 2, 0, None, '{"order_id":2,"placed_ts":"no time"}'),
        ("d", 3, 0, '{"order_id":1}', None),
        ("u", 4, 0, None, "{broken"),
        ("u", 5, 0, None, None),
    ]
    df = spark.createDataFrame(rows, "op string, lsn long, event_ts_ms long, before_json string, after_json string")
    out = {r.lsn: r for r in decode.parse_changes(df, spec.ORDERS).collect()}
    assert sorted(out) == [1, 2, 3]
    assert str(out[1].subtotal_inr) == "12.50" and out[1].rider_id is None and out[1].placed_ts.microsecond == 123456
    assert out[2].placed_ts is None and out[3].is_deleted and not out[1].is_deleted


def test_images_are_stored_parsed_and_keep_unknown_fields(spark, tmp_path):
    rows = [("u", 1, 0, None, '{"order_id":1,"status":"PLACED","new_field":{"a":[1,2]}}'), ("u", 2, 0, None, "{broken"), ("d", 3, 0, '{"order_id":"no number"}', None), ("u", 4, 0, None, None)]
    df = decode.with_images(spark.createDataFrame(rows, "op string, lsn long, event_ts_ms long, before_json string, after_json string"))
    df.write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    assert dict(log.dtypes)["after"] == "variant"
    assert {r.lsn: r.x for r in log.select("lsn", F.try_variant_get("after", "$.new_field.a[1]", "int").alias("x")).collect()} == {1: 2, 2: None, 3: None, 4: None}
    # a broken image, one without a key and one whose key is no number are no rows
    assert [(r.order_id, r.lsn) for r in decode.parse_changes(log, spec.ORDERS).collect()] == [(1, 1)]


def test_wal_lines(spark):
    lines = [
        ("0/1", "BEGIN 5"), ("0/2", "table public.orders: INSERT: order_id[bigint]:7 status[text]:'x'"), ("0/3", "table public.orders: UPDATE: rider_id[bigint]:7"),
        ("0/4", "table public.unknown: INSERT: id[bigint]:1"), ("0/5", "table public.riders: DELETE: rider_id[bigint]:9"), ("0/6", None), ("0/7", "COMMIT 5"),
    ]
    got = decode.parse_wal_text(spark.createDataFrame(lines, "lsn string, data string")).collect()
    assert sorted(tuple(r) for r in got) == [("orders", "INSERT", 7, "0/2"), ("riders", "DELETE", 9, "0/5")]


ROWS = "k long, lsn long, v string"


def test_latest_is_by_key_and_log_position(spark):
    df = spark.createDataFrame([(1, 5, "a"), (2, 1, "b"), (1, 9, "c"), (1, 7, "d"), (None, 99, "e")], ROWS)
    assert sorted(tuple(r) for r in state.latest_state(df, ["k"]).collect()) == [(1, 9, "c"), (2, 1, "b")]
    assert sorted(tuple(r) for r in state.state_as_of(df, ["k"], F.lit(6)).collect()) == [(1, 5, "a"), (2, 1, "b")]


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 0, 2), (2, 2, 1)])
def test_guarded_merge_never_moves_back(spark, order):
    batches = [[(1, 1, "a"), (2, 2, "b")], [(1, 3, "c")], [(1, 5, "d"), (1, 4, "x"), (3, 6, "e")]]
    table = spark.createDataFrame([], ROWS)
    for i in order:
        table = state.merge_latest_guarded(table, spark.createDataFrame(batches[i], ROWS), ["k"])
    got = {r.k: r.v for r in table.collect()}
    assert got[1] == "d" and got[3] == "e"


def test_insert_only_and_restate_are_idempotent(spark):
    target, source = spark.createDataFrame([(1, 1, "a")], ROWS), spark.createDataFrame([(1, 1, "z"), (1, 2, "b"), (1, 2, "b")], ROWS)
    once = state.merge_insert_only(target, source, ["k", "lsn"])
    assert sorted(tuple(r) for r in state.merge_insert_only(once, source, ["k", "lsn"]).collect()) == [(1, 1, "a"), (1, 2, "b")]
    new = spark.createDataFrame([(1, 3, "n")], ROWS)
    again = state.merge_restate(state.merge_restate(target, new, ["k"]), new, ["k"])
    assert [tuple(r) for r in again.collect()] == [(1, 3, "n")]


def test_only_the_newest_image_of_a_key_is_parsed(spark):
    """As the latest state of all parsed changes; nine of ten images never become rows of the plan behind the ranks."""
    rows = [(op, lsn, 1000 * lsn, image if op == "d" else None, None if op == "d" else image) for lsn in range(40) for op in ("d" if lsn % 7 == 0 else "u",) for image in (f'{{"order_id": {lsn % 4}, "status": "S{lsn}", "subtotal_inr": "x", "placed_ts": "2024-01-01T00:00:{lsn:02d}Z"}}',)]
    rows += [("u", 90, 0, None, '{"status": "none"}'), ("u", 91, 0, None, "{broken"), ("u", 92, 0, None, None)]
    log = decode.with_images(spark.createDataFrame(rows, "op string, lsn long, event_ts_ms long, before_json string, after_json string"))
    whole = state.latest_state(decode.parse_changes(log, spec.ORDERS), ["order_id"])
    got = decode.latest_changes(log, spec.ORDERS)
    assert got.columns == whole.columns and sorted(map(str, got.collect())) == sorted(map(str, whole.collect())) and got.count() == 4
    ranked = got._jdf.queryExecution().optimizedPlan().toString().split("Window")[-1]
    assert "$.order_id" in ranked and "$.status" not in ranked

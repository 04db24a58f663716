"""Streams: bounded triggers, bounded state, timers, restarts, and what the listener tells."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from tidelake.operators import state, trips
from tidelake.sources.keyed import KeyedTable
from tidelake.streaming import streams

UTC = dt.UTC
CHANGE = "source_table string, pk long, lsn long, event_ts timestamp"


def at(hours):
    return dt.datetime(2024, 1, 1, tzinfo=UTC) + dt.timedelta(hours=hours)


def run(spark, stream, base, name, mode="append"):
    """All there is, batch by batch, with what the listener heard."""
    write = lambda batch, n: batch.write.mode("overwrite").parquet(f"{base}/out/batch={n}")
    with streams.progress_of(spark) as told:
        streams.foreach_batch_sink(stream, write, f"{base}/ck", name, mode=mode).awaitTermination()
    return told.of(name)


def test_25000_changes_come_in_batches_of_at_most_10000(spark, tmp_path):
    base = str(tmp_path)
    streams.land(spark.range(25_000).coalesce(1).withColumnRenamed("id", "lsn"), f"{base}/in")
    batches = run(spark, streams.read_change_stream(spark, f"{base}/in", schema="lsn long", files=1), base, "bounded")
    assert len(batches) >= 3 and max(b.rows for b in batches) <= 10_000 and sum(b.rows for b in batches) == 25_000
    assert all(b.seconds > 0 and b.rows_per_s > 0 for b in batches)
    assert spark.read.parquet(f"{base}/out").select("lsn").distinct().count() == 25_000


def test_triggers_are_bounded_by_bytes(spark, tmp_path):
    base = str(tmp_path)
    for i in range(4):
        streams.land(spark.range(1_000).withColumn("i", F.lit(i)).coalesce(1), f"{base}/in")
    batches = run(spark, streams.read_table_stream(spark, f"{base}/in", "id long, i int", size=1), base, "bytes")
    assert [b.rows for b in batches] == [1_000] * 4


def test_redelivery_is_dropped_and_the_state_stays_bounded(spark, tmp_path):
    base, seen = str(tmp_path), []
    for n in range(6):
        new = [("orders", k, n * 10 + k, at(10 * n)) for k in range(10)]
        again = [("orders", k, (n - 1) * 10 + k, at(10 * n - 10)) for k in range(10)] if n else []
        spark.createDataFrame(new + again + again, CHANGE).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = streams.dedup_stream(streams.read_change_stream(spark, f"{base}/in", schema=CHANGE), state.CHANGE_IDENTITY, "event_ts", "12 hours")
        seen += run(spark, stream, base, f"dedup{n}")
    got = spark.read.parquet(f"{base}/out")
    assert got.count() == got.select("lsn").distinct().count() == 60
    assert max(b.state_rows for b in seen) <= 40 < 60 and sum(b.dropped for b in seen) == 0


PINGS = "rider_id long, trip_id string, lat double, lon double, speed_kmph double, event_ts timestamp"


def test_streamed_trips_equal_batch_trips_over_a_restart_and_end_by_timer(spark, tmp_path):
    base = str(tmp_path)
    parts = [
        [(1, "a", 12.0, 77.0, 10.0, at(0)), (1, "a", 12.1, 77.0, None, at(0.1)), (2, "b", 12.0, 77.0, 5.0, at(0.2))],
        [(1, "a", 12.2, 77.1, 30.0, at(0.3)), (1, "a", 11.9, 77.0, 20.0, at(0))],  # the same time as the first, further south
        [(3, "c", 12.0, 77.0, 5.0, at(30)), (None, "c", 12.0, 77.0, 5.0, at(30)), (3, "c", None, 77.0, 5.0, at(30))],
        [(4, "d", 12.0, 77.0, 5.0, at(31))],
    ]
    table = KeyedTable(spark, f"{base}/trips", trips.TRIP_KEY, 4)
    merge = lambda old, batch: batch if old is None else state.merge_restate(old, batch, trips.TRIP_KEY)
    states = []
    for n, part in enumerate(parts):  # every part is a new start of the query
        spark.createDataFrame(part, PINGS).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = streams.trips_stream(streams.read_ping_stream(spark, f"{base}/in", schema=PINGS), "1 hour")
        with streams.progress_of(spark) as told:
            streams.foreach_batch_sink(stream, table.merging(merge), f"{base}/ck", f"trips{n}", mode="update").awaitTermination()
        states.append([b.state_rows for b in told.batches if b.query == f"trips{n}"][-1])
    whole = trips.trips(spark.createDataFrame([r for p in parts for r in p if None not in (r[0], r[2])], PINGS))
    names = ["rider_id", "trip_id", "started_ts", "ended_ts", "ping_count", "avg_speed_kmph", "max_speed_kmph", "start_lat", "end_lat", "end_lon", "straight_line_km", "trip_date"]
    pick = lambda df: sorted(tuple(r) for r in df.select(names).collect())
    assert pick(table.read()) == pick(whole) and table.read().columns == whole.columns
    assert states[-1] == 2 < table.read().count()  # the trips of the first day have left the state


def test_a_query_that_stays_up_is_fed_stopped_and_started(spark, tmp_path):
    base = str(tmp_path)
    table = KeyedTable(spark, f"{base}/t", ["pk"], 4)
    merge = lambda old, new: state.latest_state(new, ["pk"]) if old is None else state.merge_latest_guarded(old, new, ["pk"])
    rows = lambda n: spark.createDataFrame([("orders", k, n, at(n)) for k in range(5 * n, 5 * n + 10)], CHANGE)

    def start(n):
        return streams.foreach_batch_sink(streams.read_change_stream(spark, f"{base}/in", schema=CHANGE), table.merging(merge), f"{base}/ck", f"up{n}", once=False, every="200 milliseconds")

    with streams.progress_of(spark) as told:
        streams.land(rows(0), f"{base}/in")
        query = start(0)
        try:
            query.processAllAvailable()
            streams.land(rows(1), f"{base}/in")
            query.processAllAvailable()
            assert query.isActive
        finally:
            query.stop()
        streams.land(rows(2), f"{base}/in")
        query = start(1)
        try:
            query.processAllAvailable()
        finally:
            query.stop()
    assert {r.pk: r.lsn for r in table.read().collect()} == {k: min(k // 5, 2) for k in range(20)}
    assert [sum(b.rows for b in told.of(f"up{n}")) for n in (0, 1)] == [20, 10]


def test_late_rows_are_what_the_engine_drops(spark, tmp_path):
    base = str(tmp_path)
    keeper, told_dropped = streams.LateRows(spark, f"{base}/late", "1 hour"), 0
    schema = "topic string, partition int, offset long, event_ts timestamp"
    for n, hours in enumerate(([0, 5], [6, 1, 2, 5.5], [6.5, 0, 9])):
        spark.createDataFrame([("p", 0, 10 * n + i, at(h)) for i, h in enumerate(hours)], schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
        read = lambda: streams.read_ping_stream(spark, f"{base}/in", schema=schema)
        streams.foreach_batch_sink(read(), keeper.write, f"{base}/late_ck", f"late{n}").awaitTermination()
        stream = streams.dedup_stream(read().observe("sent", F.count(F.lit(1)).alias("n")), state.PING_IDENTITY, "event_ts", "1 hour")
        batches = run(spark, stream, base, f"drop{n}")
        told_dropped += sum(b.dropped for b in batches)
        assert sum(b.observed["sent"]["n"] for b in batches) == len(hours)
    assert told_dropped == keeper.read(schema).count() == 3


@pytest.mark.parametrize("files, size", [(None, 10), (3, 10)])
def test_one_bound_is_set(spark, tmp_path, files, size):
    spark.range(3).write.parquet(f"{tmp_path}/in")
    assert streams.read_table_stream(spark, f"{tmp_path}/in", "id long", files, size).isStreaming


def test_a_dimension_does_not_depend_on_the_order_of_batches(spark, tmp_path):
    """Files of a log come in any order, one in a trigger, the last one twice: as if read at once."""
    from tidelake.operators import history

    rows = [(k, lsn, f"2024-01-{lsn:02d}", h) for k in range(3) for lsn, h in enumerate("AABBACAB", 1)]
    df = spark.createDataFrame(rows, "k long, lsn long, valid_from string, attr_hash string")
    log = streams.ChangeLog(spark, str(tmp_path / "dim"), lambda batch: batch)
    for lsns in ((5, 6), (1, 2), (7, 8), (3, 4), (3, 4)):
        df.where(F.col("lsn").isin(*lsns)).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
        stream = streams.read_table_stream(spark, str(tmp_path / "log"), df.schema, files=1)
        streams.foreach_batch_sink(stream, log.write, str(tmp_path / "ck"), f"any_{lsns[0]}").awaitTermination()
    shown = lambda x: sorted((r.k, r.lsn, r.valid_from, r.valid_to, r.is_current) for r in x.select("k", "lsn", "valid_from", "valid_to", "is_current").collect())
    got = history.scd2_versions(log.read(["k", "lsn", "attr_hash"]), "k")
    assert shown(got) == shown(history.scd2_versions(df, "k")) and got.count() == 18


def test_trips_of_a_rider_share_one_state_and_end_one_by_one(spark, tmp_path):
    """A rider's trips that overlap are kept apart, each leaves at its own time, and what is asked for is one state a rider."""
    base, sizes = str(tmp_path), []
    parts = [
        [(1, f"t{i}", 12.0 + i, 77.0, float(i), at(i)) for i in range(6)],
        [(1, "t5", 13.0, 77.0, 50.0, at(5.5)), (1, "t9", 12.0, 77.0, 5.0, at(20))],
        [(1, "t9", 12.5, 77.0, 7.0, at(20.5)), (1, "t3", 12.5, 77.0, 7.0, at(20.5))],  # t3 has ended: a trip of its own now
    ]
    rows = []
    for n, part in enumerate(parts):
        spark.createDataFrame(part, PINGS).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = streams.trips_stream(streams.read_ping_stream(spark, f"{base}/in", schema=PINGS), "2 hours")
        with streams.progress_of(spark) as told:
            write = lambda batch, k: rows.extend((n, r.trip_id, r.ping_count, r.max_speed_kmph, r.start_lat, r.end_lat) for r in batch.collect())  # noqa: B023, E731
            streams.foreach_batch_sink(stream, write, f"{base}/ck", f"shared{n}", mode="update").awaitTermination()
        sizes.append([b.state_rows for b in told.batches if b.query == f"shared{n}"][-1])
    assert sizes == [1, 1, 1]
    assert sorted(rows) == [(0, f"t{i}", 1, float(i), 12.0 + i, 12.0 + i) for i in range(6)] + [(1, "t5", 2, 50.0, 17.0, 13.0), (1, "t9", 1, 5.0, 12.0, 12.0), (2, "t3", 1, 7.0, 12.5, 12.5), (2, "t9", 2, 7.0, 12.0, 12.5)]


def test_lanes_are_worked_off_at_once_in_bounded_batches(spark, tmp_path):
    base = str(tmp_path)
    rows = spark.range(60_000).withColumnRenamed("id", "lsn")
    lanes = streams.land_in_lanes(rows, f"{base}/in", ["lsn"], lanes=3)
    assert lanes == ["lane=0", "lane=1", "lane=2"]
    write = lambda lane: lambda batch, n: batch.write.mode("overwrite").parquet(f"{base}/out/{lane}/batch={n}")
    with streams.progress_of(spark) as told:
        started = [streams.foreach_batch_sink(streams.read_change_stream(spark, f"{base}/in/{x}", schema="lsn long", files=1), write(x), f"{base}/ck/{x}", x, hold=False) for x in lanes]
        for query in started:
            query.awaitTermination()
    batches = [told.of(x) for x in lanes]
    assert all(len(b) >= 2 for b in batches) and max(b.rows for x in batches for b in x) <= 10_000
    got = spark.read.parquet(f"{base}/out")
    assert got.count() == got.select("lsn").distinct().count() == 60_000


def test_bounded_triggers_does_not_wait_for_a_listener(spark, monkeypatch):
    """A listener that loses events, as one that lags behind many triggers does, changes nothing."""
    from tidelake.plans import registry

    monkeypatch.setattr(streams.Progress, "onQueryProgress", lambda self, event: None)
    found = registry.QUERIES["bounded_triggers"](spark, "/root/testdata/sf0.001").collect()
    assert [tuple(r) for r in found] == [(1_143, True, True)]


def test_a_slow_listener_is_heard_out(spark, tmp_path, monkeypatch):
    """Events come for longer than one may be quiet, and longer than any one wait."""
    tell = streams.Progress.onQueryProgress

    def slowly(self, event):
        time.sleep(0.8)
        tell(self, event)

    monkeypatch.setattr(streams.Progress, "onQueryProgress", slowly)
    streams.land(spark.range(60).coalesce(1), f"{tmp_path}/in", 10)
    with streams.progress_of(spark, quiet_s=1.5) as told:
        write = lambda batch, n: batch.count()
        streams.foreach_batch_sink(streams.read_change_stream(spark, f"{tmp_path}/in", schema="id long", files=1), write, f"{tmp_path}/ck", "slowly").awaitTermination()
    assert [b.rows for b in told.of("slowly")] == [10] * 6

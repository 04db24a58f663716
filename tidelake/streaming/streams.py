"""The operators on streams: sources, sinks that merge, and trips with bounded state."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from typing import Any, NamedTuple

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from tidelake.functions.geo import haversine_km
from tidelake.sources.keyed import KeyedTable
from tidelake.sources.tables import has_source

#: Rows of a trigger at most (Kafka offsets; rows of a file that ``land`` writes).
CHANGES_PER_TRIGGER, PINGS_PER_TRIGGER = 10_000, 50_000
#: Lanes of a landed log, each of which a query of its own may work off.
LANES = 8
#: Bytes of files that a trigger takes at most, unless told how many files.
BYTES_PER_TRIGGER = 256 << 20


def land(rows: DataFrame, folder: str, per_file: int = CHANGES_PER_TRIGGER) -> None:
    """Appends messages to a folder in files of at most ``per_file`` rows: a stream that takes a
    file in a trigger has batches of that bound."""
    rows.write.mode("append").option("maxRecordsPerFile", per_file).parquet(folder)


def land_in_lanes(rows: DataFrame, folder: str, by: Sequence[str], lanes: int = LANES, per_file: int = CHANGES_PER_TRIGGER) -> list[str]:
    """As ``land``, into a folder for each lane, ``<folder>/lane=<n>``; a message's lane is that of the hash of ``by``.
    Gives the names of the lanes that have rows; a row for each of them comes to the driver."""
    lane = F.pmod(F.xxhash64(*by), F.lit(lanes)).cast("int")
    dealt = rows.withColumn("lane", lane).repartition(lanes, "lane")
    dealt.write.mode("append").option("maxRecordsPerFile", per_file).partitionBy("lane").parquet(folder)
    there = rows.sparkSession.read.parquet(folder).select("lane").distinct().collect()
    return sorted(f"lane={r.lane}" for r in there)


def _bounded(reader, files: int | None, size: int):
    return reader.option("maxFilesPerTrigger", files) if files else reader.option("maxBytesPerTrigger", size)


def _read_messages(spark: SparkSession, where: str, per_trigger: int, starting: str, schema: StructType | str | None, files: int | None, size: int) -> DataFrame:
    """``where``: a topic (with ``kafka:servers/topic``) or a folder of message files.  A trigger is
    bounded by rows of a topic, and by ``files`` or else by ``size`` bytes of a folder."""
    if where.startswith("kafka:"):
        if not has_source(spark, "kafka"):
            raise RuntimeError("the Kafka source is not on the class path")
        servers, _, topic = where.removeprefix("kafka:").rpartition("/")
        options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting, "maxOffsetsPerTrigger": str(per_trigger), "failOnDataLoss": "false"}
        return spark.readStream.format("kafka").options(**options).load().select("topic", "partition", "offset", "timestamp", "value")
    schema = schema or "topic string, partition int, offset bigint, timestamp timestamp, value binary"
    return _bounded(spark.readStream.schema(schema), files, size).parquet(where)


def read_change_stream(spark: SparkSession, where: str, starting: str = "earliest", per_trigger: int = CHANGES_PER_TRIGGER, schema: StructType | str | None = None, files: int | None = None, size: int = BYTES_PER_TRIGGER) -> DataFrame:
    """Messages of one change topic, a bounded number in a trigger."""
    return _read_messages(spark, where, per_trigger, starting, schema, files, size)


def read_ping_stream(spark: SparkSession, where: str, starting: str = "latest", per_trigger: int = PINGS_PER_TRIGGER, schema: StructType | str | None = None, files: int | None = None, size: int = BYTES_PER_TRIGGER) -> DataFrame:
    return _read_messages(spark, where, per_trigger, starting, schema, files, size)


def read_table_stream(spark: SparkSession, path: str, schema: StructType | str, files: int | None = None, size: int = BYTES_PER_TRIGGER) -> DataFrame:
    """What is appended to a table, as a stream."""
    return _bounded(spark.readStream.schema(schema), files, size).parquet(path)


def dedup_stream(rows: DataFrame, identity: Sequence[str], event_time: str, within: str) -> DataFrame:
    """A stream without the rows that repeat an identity no more than ``within`` after its first
    row, by event time.  Identities older than that leave the state; rows older than that are late
    and dropped (``LateRows`` keeps them)."""
    return rows.withWatermark(event_time, within).dropDuplicatesWithinWatermark(list(identity))


class Batch(NamedTuple):
    """What a query tells of a micro-batch."""

    query: str
    batch: int
    rows: int
    seconds: float
    rows_per_s: float
    state_rows: int
    dropped: int
    observed: dict[str, dict[str, Any]]


class Progress(StreamingQueryListener):
    """The newest ``keep`` micro-batches of all queries, as they end: rows, seconds, rows in state, rows
    dropped behind the watermark, and what ``observe`` counted."""

    def __init__(self, keep: int = 1_000):
        self.batches: deque[Batch] = deque(maxlen=keep)
        self.ended: set[str] = set()
        self.heard = 0

    def onQueryStarted(self, event) -> None:
        self.heard += 1

    def onQueryProgress(self, event) -> None:
        p = event.progress
        state = p.stateOperators
        seconds = p.durationMs.get("triggerExecution", 0) / 1000
        self.batches.append(Batch(p.name, p.batchId, p.numInputRows, seconds, p.numInputRows / seconds if seconds else 0.0, sum(s.numRowsTotal for s in state), sum(s.numRowsDroppedByWatermark for s in state), {k: v.asDict() for k, v in p.observedMetrics.items()}))
        self.heard += 1

    def onQueryIdle(self, event) -> None:
        self.heard += 1

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.id))
        self.heard += 1

    def of(self, query: str) -> list[Batch]:
        """The batches of a query that read rows."""
        return [b for b in list(self.batches) if b.query == query and b.rows]


@contextmanager
def progress_of(spark: SparkSession, quiet_s: float = 60.0) -> Iterator[Progress]:
    """Listens to all queries of the session; at the end everything that was told has arrived, however
    long that takes: only if nothing is heard for ``quiet_s`` does it raise.

    The listener works off events one by one, far slower than many small triggers bring them, and the
    engine drops what its queue cannot hold.  So this is for looking on: what a result
    depends on is better read from what the batches wrote.
    """
    listener = Progress()
    spark.streams.addListener(listener)
    try:
        yield listener
    finally:
        try:
            _heard_out(spark, listener, quiet_s)
        finally:
            spark.streams.removeListener(listener)


def _heard_out(spark: SparkSession, listener: Progress, quiet_s: float) -> None:
    """Waits until no event is under way to the listener."""
    heard, since = listener.heard, time.monotonic()
    while True:
        try:
            spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(500)
            return
        except Py4JJavaError as e:
            if "TimeoutException" not in str(e.java_exception):
                raise
            if listener.heard != heard:
                heard, since = listener.heard, time.monotonic()
            elif time.monotonic() - since > quiet_s:
                raise


def foreach_batch_sink(stream: DataFrame, write: Callable[[DataFrame, int], Any], checkpoint: str, name: str, once: bool = True, every: str = "10 seconds", mode: str = "append", hold: bool = True) -> StreamingQuery:
    """A named, checkpointed query that gives each micro-batch to ``write``.  once: works off
    what is there in bounded batches and ends; else runs on.  hold: a batch is kept while it is
    written; a ``write`` that reads it once needs no copy."""

    def held(batch: DataFrame, number: int) -> None:
        if not hold:
            write(batch, number)
            return
        batch.persist()
        try:
            write(batch, number)
        finally:
            batch.unpersist()

    writer = stream.writeStream.outputMode(mode).foreachBatch(held).option("checkpointLocation", checkpoint).queryName(name)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


class Snapshot(KeyedTable):
    """A stored table without keys: every merge rewrites it as a whole."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__(spark, path)


_TRIP_ROW = "rider_id long, trip_id string, t0 long, t1 long, ping_count long, avg_speed_kmph double, max_speed_kmph double, start_lat double, start_lon double, end_lat double, end_lon double"
_TripRow = Row(*[c.split()[0] for c in _TRIP_ROW.split(", ")])
_TRIP_SUMS = "trip_id string, t0 long, lat0 double, lon0 double, t1 long, lat1 double, lon1 double, n long, speeds long, total double, top double, ends_at long"
_RIDER_STATE = f"trips array<struct<{_TRIP_SUMS}>>, timer long"
#: Where state must lie for processors with timers.
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _trip_processor(wait_ms: int) -> StatefulProcessor:
    """What handles a rider's pings.  Built here, so that it travels to the workers whole and they need
    not have this package."""
    trip_row, held = _TripRow, _RIDER_STATE

    class TripProcessor(StatefulProcessor):
        """The open trips of a rider, one state for all: asking for state costs far more than a ping does,
        and most trips have few pings.  Of each trip: ends by (time, lat, lon), counts and speeds, and when
        it ends; a timer of event time stands at the first of those."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.rider = handle.getValueState("rider", held)

        def keep(self, trips, timer) -> None:
            """Stores the trips, with the timer where the first of them ends."""
            first = min(t[-1] for t in trips)
            if timer != first:
                if timer is not None:
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(first)
            self.rider.update((trips, first))

        def handleInputRows(self, key, rows, timerValues):
            s = self.rider.get()
            open_, timer = ({t[0]: tuple(t) for t in s[0]}, s[1]) if s else ({}, None)
            now, touched = timerValues.getCurrentWatermarkInMs(), {}
            for r in rows:
                at = r.t, r.lat, r.lon
                _, t0, lat0, lon0, t1, lat1, lon1, n, speeds, total, top, _ = open_.get(r.trip_id) or (None, *at, *at, 0, 0, 0.0, None, None)
                first, last = min((t0, lat0, lon0), at), max((t1, lat1, lon1), at)
                if r.speed_kmph is not None:
                    speeds, total, top = speeds + 1, total + r.speed_kmph, r.speed_kmph if top is None else max(top, r.speed_kmph)
                open_[r.trip_id] = touched[r.trip_id] = (r.trip_id, *first, *last, n + 1, speeds, total, top, max(last[0] // 1000 + wait_ms, now + 1))
            self.keep(list(open_.values()), timer)
            for trip_id, t0, lat0, lon0, t1, lat1, lon1, n, speeds, total, top, _ in touched.values():
                yield trip_row(*key, trip_id, t0, t1, n, total / speeds if speeds else None, top, lat0, lon0, lat1, lon1)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            s, now = self.rider.get(), max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
            left = [tuple(t) for t in s[0] if t[-1] > now] if s else []
            if left:
                # the timer that has just expired is gone already
                self.keep(left, None)
            else:
                self.rider.clear()
            return iter(())

        def close(self) -> None:
            pass

    return TripProcessor()


def trips_stream(pings: DataFrame, tolerance: str = "15 minutes") -> DataFrame:
    """Trips as pings arrive: every update of a trip gives its row anew (update mode), with the columns of ``trips``.

    A trip's state ends when the watermark has passed its last ping by the tolerance, by a timer, so
    the state stays bounded; it lies in RocksDB, beside the heap, the open trips of a rider together.  Pings behind the watermark are
    dropped here (``LateRows`` keeps them).  Pings without key, time or place belong to no trip.
    """
    pings.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS)
    wait_ms = int(pd.Timedelta(tolerance).total_seconds() * 1000)
    whole = pings.dropna(subset=["rider_id", "trip_id", "event_ts", "lat", "lon"]).withWatermark("event_ts", tolerance)
    keyed = whole.select("rider_id", "trip_id", F.unix_micros("event_ts").alias("t"), "lat", "lon", "speed_kmph", "event_ts").groupBy("rider_id")
    rows = keyed.transformWithState(_trip_processor(wait_ms), _TRIP_ROW, "update", "eventTime")
    ends = [F.col(c) for c in ("start_lat", "start_lon", "end_lat", "end_lon")]
    return rows.select(
        "rider_id", "trip_id", F.timestamp_micros("t0").alias("started_ts"), F.timestamp_micros("t1").alias("ended_ts"), ((F.col("t1") - F.col("t0")) / F.lit(1_000_000.0)).alias("duration_s"), "ping_count",
        "avg_speed_kmph", "max_speed_kmph", *ends, haversine_km(*ends).alias("straight_line_km"), F.to_date(F.timestamp_micros("t0")).alias("trip_date"),
    )


def split_late(batch: DataFrame, newest, tolerance: str = "15 minutes") -> tuple[DataFrame, DataFrame]:
    """(in time, late) parts of a micro-batch, given the newest event time of the batches before (None: all in time)."""
    if newest is None:
        return batch, batch.limit(0)
    limit = F.lit(newest) - F.expr(f"INTERVAL {tolerance}")
    return batch.where(F.col("event_ts") >= limit), batch.where(F.col("event_ts") < limit)


class LateRows:
    """Keeps what a stream with a watermark drops: a ``foreach_batch_sink`` writer of its own on the
    same source, which writes each micro-batch's late rows, and one row with its newest event time.

    A batch that runs again overwrites its own folders and looks at those before it only.
    """

    def __init__(self, spark: SparkSession, path: str, tolerance: str = "15 minutes"):
        self.spark, self.path, self.tolerance = spark, path.rstrip("/"), tolerance

    def newest(self, before: int):
        if not before:
            return None
        seen = self.spark.read.schema("newest timestamp").parquet(f"{self.path}/newest")  # batch comes from the folders
        return seen.where(F.col("batch") < before).agg(F.max("newest")).first()[0]

    def write(self, batch: DataFrame, number: int) -> None:
        late = split_late(batch, self.newest(number), self.tolerance)[1]
        late.write.mode("overwrite").parquet(f"{self.path}/rows/batch={number}")
        batch.agg(F.max("event_ts").alias("newest")).write.mode("overwrite").parquet(f"{self.path}/newest/batch={number}")

    def read(self, schema: StructType | str) -> DataFrame:
        """All rows kept so far, with the number of their batch."""
        return self.spark.read.schema(schema).parquet(f"{self.path}/rows")


class ChangeLog:
    """Keeps every change of a stream: a ``foreach_batch_sink`` writer that appends what ``parse``
    makes of each micro-batch.  No batch reads or rewrites what is there, so the work is that of the
    changes, and windows cut over the log (``history.scd2_versions``) do not depend on the order or the
    size of batches: a change may arrive behind later ones of its key.

    A batch that runs again overwrites its own folder.
    """

    def __init__(self, spark: SparkSession, path: str, parse: Callable[[DataFrame], DataFrame]):
        self.spark, self.path, self.parse = spark, path.rstrip("/"), parse

    def write(self, batch: DataFrame, number: int) -> None:
        self.parse(batch).write.mode("overwrite").parquet(f"{self.path}/batch={number}")

    def read(self, identity: Sequence[str]) -> DataFrame:
        """All changes so far; what was delivered twice, in whichever batches, is there once."""
        return self.spark.read.parquet(self.path).drop("batch").dropDuplicates(list(identity))

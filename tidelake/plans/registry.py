"""The registered queries over the tables, and the same results in DuckDB SQL.

A query starts from inputs that ``inputs`` derives from the tables and applies the operator it
is named after; its SQL starts from the same inputs and says the operator's result in SQL.
Results hold times without zone, and doubles where the operators have decimals.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.functions.geo import bearing_deg, haversine_km
from tidelake.functions.keys import attribute_hash, surrogate_key
from tidelake.operators import datatests, decode, expectations, history, reports, state, trips
from tidelake.plans import calendar, inputs, marts, spec
from tidelake.sources import keyed, payloads, tables
from tidelake.streaming import streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

#: Named queries over the inputs that several oracles share.
SHARED: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Times without zone, decimals as doubles."""
    out = []
    for c, t in df.dtypes:
        col = F.col(f"`{c}`")
        out.append(col.cast("timestamp_ntz").alias(c) if t == "timestamp" else col.cast("double").alias(c) if t.startswith("decimal") else col)
    return df.select(*out)


def query(name: str, sql: str | None = None, shared: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Registers a query under a name, with its SQL."""

    def register(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")  # the rule of all event times here
            return plain(f(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = inputs.with_inputs(sql, more={s: SHARED[s] for s in shared})
        return f

    return register


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return inputs.given(spark, sf_dir, name)


def _md5(*columns: str) -> str:
    """surrogate_key in DuckDB."""
    return "md5(concat_ws('||', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '<null>')" for c in columns) + "))"


def _hash(columns: tuple[str, ...]) -> str:
    """attribute_hash in DuckDB (its inputs hold no nulls)."""
    return "sha256(concat_ws(chr(1), " + ", ".join(f"CAST({c} AS VARCHAR)" for c in columns) + "))"


# --- keys and scalar functions ----------------------------------------------------------


@query("attribute_hash", f"SELECT menu_item_id, lsn, {_hash(('restaurant_id', 'name', 'price_inr', 'is_available'))} AS attr_hash FROM menu_changes")
def _(spark, sf):
    return given(spark, sf, "menu_changes").select("menu_item_id", "lsn", attribute_hash(["restaurant_id", "name", "price_inr", "is_available"]).alias("attr_hash"))


@query("surrogate_key", f"SELECT order_id, {_md5('order_id')} AS order_sk, {_md5('restaurant_id', 'rider_id', 'accepted_ts')} AS wide_sk FROM order_changes")
def _(spark, sf):
    return given(spark, sf, "order_changes").select("order_id", surrogate_key(["order_id"]).alias("order_sk"), surrogate_key(["restaurant_id", "rider_id", "accepted_ts"]).alias("wide_sk"))


_HAVERSINE = "2 * 6371.0 * asin(sqrt(least(1.0, greatest(0.0, pow(sin(radians({b} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({b})) * pow(sin(radians({d} - {c}) / 2), 2)))))"


@query("haversine_km", f"SELECT offset_no, round({_HAVERSINE.format(a='lat', b='13.0e0', c='lon', d='77.6e0')}, 6) AS km FROM pings")
def _(spark, sf):
    return given(spark, sf, "pings").select("offset_no", F.round(haversine_km(F.col("lat"), F.col("lon"), F.lit(13.0), F.lit(77.6)), 6).alias("km"))


_BEARING = (
    "(degrees(atan2(sin(radians({d} - {c})) * cos(radians({b})), cos(radians({a})) * sin(radians({b})) - sin(radians({a})) * cos(radians({b})) * cos(radians({d} - {c})))) + 360.0) % 360.0"
)


@query("bearing_deg", f"SELECT offset_no, round({_BEARING.format(a='lat', b='13.0e0', c='lon', d='77.6e0')}, 6) AS bearing FROM pings")
def _(spark, sf):
    return given(spark, sf, "pings").select("offset_no", F.round(bearing_deg(F.col("lat"), F.col("lon"), F.lit(13.0), F.lit(77.6)), 6).alias("bearing"))


# --- decode, split, flatten -------------------------------------------------------------


def decoded(spark: SparkSession, sf: str) -> DataFrame:
    raw = inputs.messages(given(spark, sf, "changes"))
    return decode.decode_envelope(decode.strip_wire_header(raw), inputs.ENVELOPE)


SHARED["kinds"] = """SELECT *, concat('cdc.', source_table) AS topic,
  CASE WHEN lsn % 97 = 0 THEN 'tombstone' WHEN lsn % 89 = 0 THEN 'undecodable' ELSE 'good' END AS kind FROM changes"""


@query("strip_wire_header", "SELECT topic, offset_no AS offset, CASE WHEN kind <> 'tombstone' THEN 7 END AS schema_id, CASE WHEN kind = 'undecodable' THEN '{broken' END AS broken FROM kinds", ("kinds",))
def _(spark, sf):
    df = decode.strip_wire_header(inputs.messages(given(spark, sf, "changes")))
    text = F.col("payload").cast("string")
    return df.select("topic", "offset", F.col("schema_id").cast("int").alias("schema_id"), F.when(text == "{broken", text).alias("broken"))


@query("decode_envelope", "SELECT topic, offset_no AS offset, CASE WHEN kind = 'good' THEN op END AS op, CASE WHEN kind = 'good' THEN lsn END AS lsn FROM kinds", ("kinds",))
def _(spark, sf):
    return decoded(spark, sf).select("topic", "offset", "envelope.op", "envelope.source.lsn")


@query("classify_batch", "SELECT topic, kind, count(*) AS n FROM kinds GROUP BY topic, kind", ("kinds",))
def _(spark, sf):
    # decoded once, to what tells the parts apart; each part then reads only that
    batch = tables.stored(decoded(spark, sf).select("topic", F.substring("value", 1, 1).alias("value"), "envelope.op"))
    parts = decode.classify_batch(batch, required="op")
    named = [df.withColumn("kind", F.lit(n)) for n, df in zip(("good", "tombstone", "undecodable"), parts)]
    return reduce(DataFrame.union, named).groupBy("topic", "kind").agg(F.count(F.lit(1)).alias("n"))


def _flat(good: DataFrame) -> DataFrame:
    """Good messages of several tables as bronze rows."""
    flat = decode.to_bronze_changes(good, "orders", ingest_ts=F.col("timestamp"))
    return flat.withColumn("source_table", F.substring("topic", 5, 20))


def bronze(spark: SparkSession, sf: str) -> DataFrame:
    return _flat(decode.classify_batch(decoded(spark, sf)).good)


@query(
    "to_bronze_changes",
    """SELECT source_table, pk, lsn, op, CAST(floor(epoch_us(event_ts) / 1000) AS BIGINT) AS event_ts_ms, op = 'd' AS has_before, op <> 'd' AS has_after, topic, part_no AS "partition",
       offset_no AS "offset", event_ts AS kafka_ts, CAST(event_ts AS DATE) AS ingest_date FROM kinds WHERE kind = 'good'""",
    ("kinds",),
)
def _(spark, sf):
    return bronze(spark, sf).select(
        "source_table", "pk", "lsn", "op", "event_ts_ms", F.col("before_json").isNotNull().alias("has_before"), F.col("after_json").isNotNull().alias("has_after"),
        "topic", "partition", "offset", "kafka_ts", "ingest_date",
    )


def pings(spark: SparkSession, sf: str) -> DataFrame:
    return given(spark, sf, "pings").withColumnsRenamed({"part_no": "partition", "offset_no": "offset"})


@query("to_bronze_pings", """SELECT rider_id, trip_id, lat, lon, speed_kmph, heading_deg, event_ts, part_no AS "partition", offset_no AS "offset", CAST(event_ts AS DATE) AS event_date FROM pings""")
def _(spark, sf):
    p = pings(spark, sf)
    body = F.struct("rider_id", "trip_id", "lat", "lon", "speed_kmph", "heading_deg", "accuracy_m", "event_ts").alias("ping")
    flat = decode.to_bronze_pings(p.select(body, "topic", "partition", "offset", F.col("event_ts").alias("timestamp")))
    return flat.select("rider_id", "trip_id", "lat", "lon", "speed_kmph", "heading_deg", "event_ts", "partition", "offset", "event_date")


_ORDER_FIELDS = "order_id, customer_id, restaurant_id, rider_id, status, placed_ts, accepted_ts, picked_up_ts, delivered_ts, promised_ts, cancel_reason"
_ORDER_MONEY = "subtotal_inr, delivery_fee_inr, discount_inr, total_inr"
_ORDER_SQL = _ORDER_FIELDS + ", " + ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in _ORDER_MONEY.split(", ")) + ", is_deleted, op, lsn"
_ORDER_COLUMNS = [c.strip() for c in f"{_ORDER_FIELDS}, {_ORDER_MONEY}, is_deleted, op, lsn".split(",")]


def change_log(spark: SparkSession, sf: str, name: str, entity: spec.EntitySpec, key: str | None = None) -> DataFrame:
    """An entity's change log, images as VARIANT, not stored: for what reads it once.  key: a field that also stands beside the image, as pk.

    Images are written whole, where they are: fields shredded into columns of their own cost more to write and to
    read than they save, as images are parsed whole."""
    rows, cores = inputs.given(spark, sf, name, deal=True), spark.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() < cores:
        # a small table is one file of one row group: without this it stays one task's to the end
        rows = rows.repartition(cores, "lsn")
    spark.conf.set("spark.sql.variant.writeShredding.enabled", "false")
    return inputs.as_bronze(rows, entity.fields, key)


def bronze_table(spark: SparkSession, sf: str, name: str, entity: spec.EntitySpec) -> DataFrame:
    """An entity's change log as a stored table."""
    return tables.stored(change_log(spark, sf, name, entity))


def order_log(spark: SparkSession, sf: str) -> DataFrame:
    return bronze_table(spark, sf, "order_changes", spec.ORDERS)


def order_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Order changes that went through the change log."""
    return decode.parse_changes(order_log(spark, sf), spec.ORDERS)


@query("parse_order_changes", f"SELECT {_ORDER_SQL} FROM order_changes")
def _(spark, sf):
    return order_rows(spark, sf).select(*_ORDER_COLUMNS)


DIMS = {
    "restaurant": (spec.RESTAURANTS, "restaurant_changes"),
    "rider": (spec.RIDERS, "rider_changes"),
    "menu": (spec.MENU_ITEMS, "menu_changes"),
}


def dim_rows(spark: SparkSession, sf: str, which: str, kept: bool = True) -> DataFrame:
    entity, name = DIMS[which]
    return decode.parse_dim_changes((bronze_table if kept else change_log)(spark, sf, name, entity), entity)


def _parsed_sql(which: str) -> str:
    entity, name = DIMS[which]
    return f"SELECT *, op = 'd' AS is_deleted, updated_at AS valid_from, {_hash((*entity.tracked, chr(40) + 'op = ' + chr(39) + 'd' + chr(39) + ')'))} AS attr_hash FROM {name}"


def _versions_sql(which: str) -> str:
    entity, _ = DIMS[which]
    return f"""SELECT * EXCLUDE (prior), lead(valid_from) OVER (PARTITION BY {entity.key} ORDER BY lsn) AS valid_to,
  lead(valid_from) OVER (PARTITION BY {entity.key} ORDER BY lsn) IS NULL AS is_current
  FROM (SELECT *, lag(attr_hash) OVER (PARTITION BY {entity.key} ORDER BY lsn) AS prior FROM parsed_{which}) AS seen WHERE prior IS NULL OR prior <> attr_hash"""


for _which in DIMS:
    SHARED[f"parsed_{_which}"] = _parsed_sql(_which)
    SHARED[f"versions_{_which}"] = _versions_sql(_which)


@query("parse_dim_changes", "SELECT menu_item_id, lsn, is_deleted, valid_from, attr_hash FROM parsed_menu", ("parsed_menu",))
def _(spark, sf):
    return dim_rows(spark, sf, "menu").select("menu_item_id", "lsn", "is_deleted", "valid_from", "attr_hash")


@query(
    "parse_wal_text",
    "SELECT source_table, CASE op WHEN 'd' THEN 'DELETE' ELSE 'UPDATE' END AS op, pk, CAST(offset_no AS VARCHAR) AS lsn FROM changes WHERE lsn % 10 <> 0 AND lsn % 11 <> 0",
)
def _(spark, sf):
    c = given(spark, sf, "changes")
    key = F.when(F.col("lsn") % 11 == 0, "other_id").when(F.col("source_table") == "orders", "order_id").otherwise("rider_id")
    op = F.when(F.col("op") == "d", "DELETE").otherwise("UPDATE")
    line = F.concat(F.lit("table public."), "source_table", F.lit(": "), op, F.lit(": "), key, F.lit("[bigint]:"), F.col("pk").cast("string"), F.lit(" status[text]:'x'"))
    lines = c.select(F.col("offset_no").cast("string").alias("lsn"), F.when(F.col("lsn") % 10 == 0, F.lit("COMMIT 7")).otherwise(line).alias("data"))
    return decode.parse_wal_text(lines)


# --- sources and sinks ------------------------------------------------------------------


@query("read_table", "SELECT event_id, user_id, event_type, value FROM events")
def _(spark, sf):
    return tables.read_table(spark, f"{sf}/events.parquet").select("event_id", "user_id", "event_type", "value")


def _written_days(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    path = tables.scratch_dir(spark)
    rows = pings(spark, sf).select("rider_id", "offset", "speed_kmph", F.to_date("event_ts").alias("event_date"))
    tables.append_partitioned(rows, path, "event_date")
    return path, rows


@query("append_partitioned", "SELECT CAST(event_ts AS DATE) AS event_date, count(*) * 2 AS n FROM pings GROUP BY 1")
def _(spark, sf):
    path, rows = _written_days(spark, sf)
    tables.append_partitioned(rows, path, "event_date")
    return spark.read.parquet(path).groupBy("event_date").agg(F.count(F.lit(1)).alias("n"))


@query("overwrite_days", "SELECT CAST(event_ts AS DATE) AS event_date, count(*) AS n, CAST(round(sum(CASE WHEN day(event_ts) = 5 THEN 0 ELSE speed_kmph END), 2) AS DOUBLE) AS speed FROM pings GROUP BY 1")
def _(spark, sf):
    path, rows = _written_days(spark, sf)
    tables.overwrite_days(rows.where(F.dayofmonth("event_date") == 5).withColumn("speed_kmph", F.lit(0.0)), path, "event_date")
    return spark.read.parquet(path).groupBy("event_date").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("speed_kmph"), 2).alias("speed"))


@query("delete_day", "SELECT CAST(event_ts AS DATE) AS event_date, count(*) AS n FROM pings WHERE CAST(event_ts AS DATE) <> DATE '2024-01-05' GROUP BY 1")
def _(spark, sf):
    path, _ = _written_days(spark, sf)
    tables.delete_day(spark, path, "event_date", dt.date(2024, 1, 5))
    return spark.read.parquet(path).groupBy("event_date").agg(F.count(F.lit(1)).alias("n"))


@query("overwrite_extract", "SELECT holiday_date, holiday_name, country_code FROM api_holidays")
def _(spark, sf):
    path, rows = tables.scratch_dir(spark), given(spark, sf, "api_holidays")
    tables.overwrite_extract(spark, [], payloads.HOLIDAYS, path)
    tables.overwrite_extract(spark, rows, payloads.HOLIDAYS, path)
    return spark.read.parquet(path)


@query("quarantine_append", "SELECT topic, offset_no AS offset, kind AS reason, source_table FROM kinds WHERE kind = 'undecodable'", ("kinds",))
def _(spark, sf):
    bad = decode.classify_batch(decoded(spark, sf)).undecodable.drop("envelope", "payload")
    path = tables.scratch_dir(spark)
    for t in ("orders", "riders"):
        tables.quarantine_append(bad.where(F.col("topic") == f"cdc.{t}"), path, "undecodable", t)
    return spark.read.parquet(path).select("topic", "offset", "reason", "source_table")


@query("register_sources", "SELECT n_name AS nation, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def _(spark, sf):
    tables.register_sources(spark, {"src_customer": f"{sf}/customer.parquet", "src_nation": f"{sf}/nation.parquet", "src_absent": f"{sf}/absent.parquet"})
    return spark.sql("SELECT n_name AS nation, count(*) AS customers FROM src_customer JOIN src_nation ON c_nationkey = n_nationkey GROUP BY n_name")


_SEED_SQL = ", ".join(f"(DATE '{d}', '{n}', '{c}')" for d, n, c in payloads.HOLIDAY_SEED)


@query("holiday_seed", f"SELECT s.holiday_date, s.holiday_name, s.country_code, (SELECT count(*) FROM orders WHERE month(o_orderdate) = month(s.holiday_date) AND day(o_orderdate) = day(s.holiday_date)) AS orders_on_day FROM (VALUES {_SEED_SQL}) AS s(holiday_date, holiday_name, country_code)")
def _(spark, sf):
    inputs.register(spark, sf)
    days = spark.table("orders").groupBy(F.month("o_orderdate").alias("m"), F.dayofmonth("o_orderdate").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    seed = payloads.holiday_seed(spark)
    joined = seed.join(days, (F.month("holiday_date") == F.col("m")) & (F.dayofmonth("holiday_date") == F.col("d")), "left")
    return joined.select("holiday_date", "holiday_name", "country_code", F.coalesce("n", F.lit(0)).alias("orders_on_day"))


@query("parse_weather_payload", "SELECT city, weather_date, precipitation_mm, temp_max_c, CAST(NULL AS DOUBLE) AS temp_min_c FROM weather")
def _(spark, sf):
    by_city = given(spark, sf, "weather").groupBy("city").agg(F.sort_array(F.collect_list(F.struct("weather_date", "precipitation_mm", "temp_max_c"))).alias("d"))
    daily = F.struct(
        F.transform("d.weather_date", lambda x: x.cast("string")).alias("time"), F.col("d.precipitation_mm").alias("precipitation_sum"), F.col("d.temp_max_c").alias("temperature_2m_max")
    )
    return payloads.parse_weather_payload(by_city.select("city", F.to_json(F.struct(daily.alias("daily")), {"ignoreNullFields": "false"}).alias("payload")))


@query("parse_holiday_payload", "SELECT holiday_date, CASE WHEN holiday_name = 'First' THEN 'First' ELSE 'other' END AS holiday_name, country_code FROM api_holidays")
def _(spark, sf):
    h = given(spark, sf, "api_holidays")
    local = F.when(F.col("holiday_name") == "First", F.col("holiday_name")).otherwise("")
    one = F.array(F.struct(F.col("holiday_date").cast("string").alias("date"), local.alias("localName"), F.lit("other").alias("name"), F.col("country_code").alias("countryCode")))
    return payloads.parse_holiday_payload(h.select(F.to_json(one).alias("payload")))


@query("maintain_layout", "SELECT 4 AS files, count(*) AS n, TRUE AS is_disjoint FROM pings")
def _(spark, sf):
    """A table of many small files rewritten into four, each with its own range of riders."""
    path, _ = _written_days(spark, sf)
    into = tables.scratch_dir(spark)
    tables.maintain_layout(spark, path, into, "rider_id", 4)
    files = spark.read.parquet(into).groupBy(F.input_file_name().alias("file")).agg(F.min("rider_id").alias("lo"), F.max("rider_id").alias("hi"), F.count(F.lit(1)).alias("n"))
    # one row for each file
    ranges = files.agg(F.count(F.lit(1)).cast("int").alias("files"), F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("r"))
    apart = F.forall(F.zip_with(F.slice("r", 1, F.size("r") - 1), F.slice("r", 2, F.size("r") - 1), lambda x, y: x["hi"] < y["lo"]), lambda ok: ok)
    return ranges.select("files", "n", apart.alias("is_disjoint"))


@query("file_count", "SELECT count(*) AS rows, 4 AS files, -1 AS absent FROM events")
def _(spark, sf):
    path = tables.scratch_dir(spark)
    spark.read.parquet(f"{sf}/events.parquet").repartition(4, "event_id").write.parquet(path)
    rows = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"))
    return rows.withColumn("files", F.lit(tables.file_count(spark, path))).withColumn("absent", F.lit(tables.file_count(spark, f"{path}/absent")))


@query("zorder_layout", "SELECT count(*) AS rows, 128 AS files, TRUE AS by_user_reads_few, TRUE AS by_time_reads_few FROM events")
def _(spark, sf):
    """Events in a Z-order of two lookup keys: the share of files that a lookup by either reads."""
    path = tables.scratch_dir(spark)
    spark.read.parquet(f"{sf}/events.parquet").write.parquet(f"{path}/a")
    _, files = tables.maintain_layout(spark, f"{path}/a", f"{path}/b", ["ts", "user_id"], 128)
    rows = spark.read.parquet(f"{path}/b")
    few = {k: F.lit(tables.share_read(rows, k) < 0.25) for k in ("user_id", "ts")}
    return rows.agg(F.count(F.lit(1)).alias("rows")).select("rows", F.lit(files).alias("files"), few["user_id"].alias("by_user_reads_few"), few["ts"].alias("by_time_reads_few"))


# --- de-duplication, latest state, merges -----------------------------------------------


@query("dedup_changes", "SELECT DISTINCT source_table, pk, lsn, op, status FROM changes")
def _(spark, sf):
    return state.dedup_changes(given(spark, sf, "changes")).select("source_table", "pk", "lsn", "op", "status")


@query("dedup_pings", "SELECT DISTINCT topic, part_no AS \"partition\", offset_no AS \"offset\", rider_id FROM pings")
def _(spark, sf):
    p = pings(spark, sf)
    return state.dedup_pings(p.unionAll(p.where("offset % 5 = 0"))).select("topic", "partition", "offset", "rider_id")


_LATEST = "SELECT {c} FROM (SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY lsn DESC) AS rn FROM {t}) AS ranked WHERE rn = 1"
SHARED["orders_now"] = _LATEST.format(c="* EXCLUDE (rn)", k="order_id", t="order_changes")


@query("latest_state", f"SELECT {_ORDER_SQL} FROM orders_now", ("orders_now",))
def _(spark, sf):
    return orders_now(spark, sf).select(*_ORDER_COLUMNS)


@query("state_as_of", _LATEST.format(c="order_id, status, is_deleted, lsn", k="order_id", t="(SELECT * FROM order_changes WHERE updated_at <= placed_ts + INTERVAL '15' MINUTE) AS upto"))
def _(spark, sf):
    """All orders, each as of a quarter of an hour after it was placed."""
    rows = order_rows(spark, sf)
    return state.state_as_of(rows, ["order_id"], F.col("placed_ts") + F.expr("INTERVAL 15 MINUTES"), "updated_at").select("order_id", "status", "is_deleted", "lsn")


@query("state_as_of_step", _LATEST.format(c="order_id, status, is_deleted, lsn", k="order_id", t="(SELECT * FROM order_changes WHERE lsn <= order_id * 8 + 1) AS upto"))
def _(spark, sf):
    """All orders, each as of a position inside its own history."""
    return state.state_as_of(order_rows(spark, sf), ["order_id"], F.col("order_id") * 8 + 1).select("order_id", "status", "is_deleted", "lsn")


@query("merge_insert_only", "SELECT DISTINCT source_table, pk, lsn, op FROM changes")
def _(spark, sf):
    rows = given(spark, sf, "changes").select("source_table", "pk", "lsn", "op")
    first = state.dedup_changes(rows.where("lsn % 3 = 0"))
    merged = state.merge_insert_only(first, rows, state.CHANGE_IDENTITY)
    return state.merge_insert_only(merged, rows.where("lsn % 2 = 0"), state.CHANGE_IDENTITY)


@query("merge_latest_guarded", f"SELECT {_ORDER_SQL} FROM orders_now", ("orders_now",))
def _(spark, sf):
    rows = order_rows(spark, sf)
    late = state.latest_state(rows.where("lsn % 8 >= 1"), ["order_id"])
    return state.merge_latest_guarded(late, rows.where("lsn % 8 <= 1"), ["order_id"]).select(*_ORDER_COLUMNS)


_TRIPS = f"""SELECT rider_id, trip_id, started_ts, ended_ts, CAST(epoch_us(ended_ts) - epoch_us(started_ts) AS DOUBLE) / 1000000 AS duration_s, ping_count, avg_speed_kmph, max_speed_kmph,
  start_lat, start_lon, end_lat, end_lon, {_HAVERSINE.format(a='start_lat', b='end_lat', c='start_lon', d='end_lon')} AS straight_line_km, CAST(started_ts AS DATE) AS trip_date
  FROM (SELECT rider_id, trip_id, min(event_ts) AS started_ts, max(event_ts) AS ended_ts, count(*) AS ping_count, avg(speed_kmph) AS avg_speed_kmph, max(speed_kmph) AS max_speed_kmph,
    arg_min(lat, event_ts) AS start_lat, arg_min(lon, event_ts) AS start_lon, arg_max(lat, event_ts) AS end_lat, arg_max(lon, event_ts) AS end_lon FROM pings GROUP BY rider_id, trip_id) AS ends"""
SHARED["trips_now"] = _TRIPS
_TRIP_SQL = """rider_id, trip_id, started_ts, ended_ts, round(duration_s, 6) AS duration_s, ping_count, round(avg_speed_kmph, 6) AS avg_speed_kmph, max_speed_kmph,
  start_lat, start_lon, end_lat, end_lon, round(straight_line_km, 6) AS straight_line_km, trip_date"""


def _rounded_trips(df: DataFrame) -> DataFrame:
    for c in ("duration_s", "avg_speed_kmph", "straight_line_km"):
        df = df.withColumn(c, F.round(c, 6))
    return df


def trip_rows(spark: SparkSession, sf: str) -> DataFrame:
    return trips.trips(pings(spark, sf))


@query("trips", f"SELECT {_TRIP_SQL} FROM trips_now", ("trips_now",))
def _(spark, sf):
    return _rounded_trips(trip_rows(spark, sf))


@query("merge_restate", f"SELECT {_TRIP_SQL} FROM trips_now", ("trips_now",))
def _(spark, sf):
    p = pings(spark, sf)
    old = trips.trips(p.where("offset % 2 = 0"))
    return _rounded_trips(state.merge_restate(old, trips.trips(p), trips.TRIP_KEY))


@query("late_pings", """SELECT part_no AS "partition", offset_no AS "offset", event_ts, newest_before FROM (
  SELECT *, max(sent_ts) OVER (PARTITION BY part_no ORDER BY offset_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest_before
  FROM (SELECT * REPLACE (CASE WHEN offset_no % 50 = 0 THEN event_ts - INTERVAL '6' HOUR ELSE event_ts END AS event_ts), CASE WHEN offset_no % 50 = 0 THEN event_ts - INTERVAL '6' HOUR ELSE event_ts END AS sent_ts FROM pings) AS sent) AS seen
  WHERE event_ts < newest_before - INTERVAL '15' MINUTE""")
def _(spark, sf):
    p = pings(spark, sf).withColumn("event_ts", F.when(F.col("offset") % 50 == 0, F.col("event_ts") - F.expr("INTERVAL 6 HOURS")).otherwise(F.col("event_ts")))
    return trips.late_pings(p, block=100).select("partition", "offset", "event_ts", "newest_before")


@query("trip_legs", f"""SELECT offset_no AS "offset", rider_id, trip_id, round({_HAVERSINE.format(a='la', b='lat', c='lo', d='lon')}, 6) AS leg_km, round({_BEARING.format(a='la', b='lat', c='lo', d='lon')}, 4) AS heading
  FROM (SELECT *, lag(lat) OVER w AS la, lag(lon) OVER w AS lo FROM pings WINDOW w AS (PARTITION BY rider_id, trip_id ORDER BY event_ts, lat, lon)) AS legs""")
def _(spark, sf):
    return trips.trip_legs(pings(spark, sf)).select("offset", "rider_id", "trip_id", F.round("leg_km", 6).alias("leg_km"), F.round("heading", 4).alias("heading"))


# --- history ----------------------------------------------------------------------------


def versions(spark: SparkSession, sf: str, which: str, kept: bool = True) -> DataFrame:
    """Hashes travel and sort as bytes: half as wide as their digits, in the same order.  kept: the log is stored."""
    return hashes_as_text(history.scd2_versions(hashes_as_bytes(dim_rows(spark, sf, which, kept)), DIMS[which][0].key))


def hashes_as_bytes(rows: DataFrame) -> DataFrame:
    return rows.withColumn("attr_hash", F.unhex("attr_hash"))


def hashes_as_text(rows: DataFrame) -> DataFrame:
    return rows.withColumn("attr_hash", F.lower(F.hex("attr_hash")))


_WINDOW = "lsn, valid_from, valid_to, is_current, is_deleted"
_WINDOW_COLUMNS = _WINDOW.split(", ")
for _which, (_entity, _) in DIMS.items():

    @query(f"scd2_versions_{_which}", f"SELECT {_entity.key}, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' if c in ('price_inr', 'commission_pct', 'rating', 'lat', 'lon') else c for c in _entity.tracked)}, {_WINDOW} FROM versions_{_which}", (f"parsed_{_which}", f"versions_{_which}"))
    def _(spark, sf, which=_which, entity=_entity):
        return versions(spark, sf, which).select(entity.key, *entity.tracked, *_WINDOW_COLUMNS)


_CUT = int(dt.datetime(1998, 6, 1, tzinfo=dt.UTC).timestamp()) * 1_000_000


@query("scd2_stage", """SELECT CASE WHEN n = 1 AND closes THEN menu_item_id END AS merge_key, menu_item_id, lsn FROM (SELECT *, row_number() OVER (PARTITION BY menu_item_id ORDER BY lsn) AS n FROM versions_menu) AS v,
  (VALUES (TRUE), (FALSE)) AS c(closes) WHERE n = 1 OR NOT closes""", ("parsed_menu", "versions_menu"))
def _(spark, sf):
    return history.scd2_stage(versions(spark, sf, "menu"), "menu_item_id").select("merge_key", "menu_item_id", "lsn")


for _which in ("menu", "restaurant"):

    @query(f"merge_scd2_{_which}", f"SELECT {DIMS[_which][0].key}, attr_hash, {_WINDOW} FROM versions_{_which}", (f"parsed_{_which}", f"versions_{_which}"))
    def _(spark, sf, which=_which):
        rows, key = hashes_as_bytes(dim_rows(spark, sf, which)), DIMS[which][0].key
        table = keyed.KeyedTable(spark, tables.scratch_dir(spark), [key])

        def merge(old: DataFrame | None, batch: DataFrame) -> DataFrame:
            if old is None:
                # dealt once, by bucket: neither the sequences nor the table shuffle again
                return history.scd2_versions(table.dealt(batch), ["bucket", key])
            new = history.scd2_versions(batch, key, old.where("is_current"))
            return history.merge_scd2(old, history.scd2_stage(new, key), key)

        table.merge(rows.where(F.col("lsn") <= _CUT), 0, merge)
        # the second batch brings part of the first again
        table.merge(rows.where(F.col("lsn") > _CUT - 86_400_000_000 * 30), 1, merge)
        return hashes_as_text(table.read()).select(key, "attr_hash", *_WINDOW_COLUMNS)


def _effective(which: str) -> str:
    key = DIMS[which][0].key
    return f"SELECT *, CASE WHEN row_number() OVER (PARTITION BY {key} ORDER BY valid_from) = 1 THEN TIMESTAMP '1900-01-01 00:00:00' ELSE valid_from END AS effective_from FROM versions_{which} WHERE NOT is_deleted"


for _which in DIMS:
    SHARED[f"live_{_which}"] = _effective(_which)


@query("scd2_effective_from", "SELECT restaurant_id, valid_from, effective_from, valid_to FROM live_restaurant", ("parsed_restaurant", "versions_restaurant", "live_restaurant"))
def _(spark, sf):
    live = versions(spark, sf, "restaurant").where("not is_deleted")
    return history.scd2_effective_from(live, "restaurant_id").select("restaurant_id", "valid_from", "effective_from", "valid_to")


@query(
    "scd2_as_of_join",
    """SELECT o.order_id, o.placed_ts, CAST(r.commission_pct AS DOUBLE) AS commission_pct, r.valid_from FROM orders_now AS o
    LEFT JOIN live_restaurant AS r ON o.restaurant_id = r.restaurant_id AND o.placed_ts >= r.effective_from AND (r.valid_to IS NULL OR o.placed_ts < r.valid_to)""",
    ("orders_now", "parsed_restaurant", "versions_restaurant", "live_restaurant"),
)
def _(spark, sf):
    facts = orders_now(spark, sf).select("order_id", "restaurant_id", "placed_ts")
    live = history.scd2_effective_from(versions(spark, sf, "restaurant").where("not is_deleted"), "restaurant_id")
    joined = history.scd2_as_of_join(facts, live, "restaurant_id", "placed_ts", {"commission_pct": "commission_pct", "valid_from": "valid_from"})
    return joined.drop("restaurant_id")


SHARED["broken_menu"] = "SELECT * REPLACE (CASE WHEN lsn % 10 = 0 THEN valid_to + INTERVAL '400' DAY ELSE valid_to END AS valid_to) FROM versions_menu"


def broken_menu(spark: SparkSession, sf: str) -> DataFrame:
    """Versions some of which end too late."""
    return versions(spark, sf, "menu").withColumn("valid_to", F.when(F.col("lsn") % 10 == 0, F.col("valid_to") + F.expr("INTERVAL 400 DAYS")).otherwise(F.col("valid_to")))


@query("scd2_overlaps", """SELECT menu_item_id, valid_from, valid_to, next_from FROM (SELECT *, lead(valid_from) OVER (PARTITION BY menu_item_id ORDER BY valid_from, lsn) AS next_from FROM broken_menu) AS n
  WHERE next_from IS NOT NULL AND (valid_to IS NULL OR valid_to > next_from)""", ("parsed_menu", "versions_menu", "broken_menu"))
def _(spark, sf):
    return history.scd2_overlaps(broken_menu(spark, sf), "menu_item_id").select("menu_item_id", "valid_from", "valid_to", "next_from")


@query("scd2_orphaned_windows", """SELECT menu_item_id, valid_from, valid_to FROM broken_menu AS b WHERE valid_to IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM broken_menu AS n WHERE n.menu_item_id = b.menu_item_id AND n.valid_from = b.valid_to)""", ("parsed_menu", "versions_menu", "broken_menu"))
def _(spark, sf):
    return history.scd2_orphaned_windows(broken_menu(spark, sf), "menu_item_id").select("menu_item_id", "valid_from", "valid_to")


# --- marts ------------------------------------------------------------------------------


def staged_orders(spark: SparkSession, sf: str) -> DataFrame:
    """The orders as they are, stored: facts read them several times."""
    return marts.stg_orders(tables.stored(orders_now(spark, sf)))


def entity_rows(spark: SparkSession, sf: str, name: str, entity: spec.EntitySpec) -> DataFrame:
    return decode.parse_changes(bronze_table(spark, sf, name, entity), entity)


def _mins(a: str, b: str) -> str:
    return f"(CAST(floor(epoch({b})) AS BIGINT) - CAST(floor(epoch({a})) AS BIGINT)) / 60.0"


SHARED["staged_orders"] = f"""SELECT *, {_mins('placed_ts', 'picked_up_ts')} AS prep_minutes, {_mins('picked_up_ts', 'delivered_ts')} AS transit_minutes,
  {_mins('placed_ts', 'delivered_ts')} AS total_minutes, {_mins('promised_ts', 'delivered_ts')} AS late_minutes, status = 'DELIVERED' AS is_delivered FROM orders_now"""


@query("stg_orders", """SELECT order_id, status, round(prep_minutes, 6) AS prep_minutes, round(transit_minutes, 6) AS transit_minutes, round(total_minutes, 6) AS total_minutes,
  round(late_minutes, 6) AS sla_breach_minutes, status = 'CANCELLED' AS is_cancelled, is_delivered, status IN ('DELIVERED', 'CANCELLED') AS is_terminal, is_deleted, lsn FROM staged_orders""", ("orders_now", "staged_orders"))
def _(spark, sf):
    m = [F.round(c, 6).alias(c) for c in ("prep_minutes", "transit_minutes", "total_minutes", "sla_breach_minutes")]
    return staged_orders(spark, sf).select("order_id", "status", *m, "is_cancelled", "is_delivered", "is_terminal", "is_deleted", "lsn")


SHARED["customers_now"] = _LATEST.format(c="* EXCLUDE (rn)", k="customer_id", t="customer_changes")
SHARED["items_now"] = _LATEST.format(c="* EXCLUDE (rn), qty * unit_price_inr AS line_total_inr", k="order_item_id", t="item_changes")


@query("stg_customers", "SELECT customer_id, name AS customer_name, city, signup_ts, tier, is_active, updated_at, is_deleted, lsn FROM customers_now", ("customers_now",))
def _(spark, sf):
    return marts.stg_customers(entity_rows(spark, sf, "customer_changes", spec.CUSTOMERS))


@query("stg_order_items", """SELECT order_item_id, order_id, menu_item_id, qty, CAST(unit_price_inr AS DOUBLE) AS unit_price_inr, CAST(line_total_inr AS DOUBLE) AS line_total_inr, is_deleted, lsn FROM items_now""", ("items_now",))
def _(spark, sf):
    return marts.stg_order_items(entity_rows(spark, sf, "item_changes", spec.ORDER_ITEMS))


@query("stg_restaurants", f"SELECT restaurant_id, name AS restaurant_name, city, cuisine, CAST(rating AS DOUBLE) AS rating, CAST(commission_pct AS DOUBLE) AS commission_pct, is_open, {_WINDOW} FROM versions_restaurant", ("parsed_restaurant", "versions_restaurant"))
def _(spark, sf):
    return marts.stg_restaurants(versions(spark, sf, "restaurant")).drop("lat", "lon")


@query("stg_riders", f"SELECT rider_id, name AS rider_name, city AS rider_city, vehicle_type, tier, shift_start, is_online, {_WINDOW} FROM versions_rider", ("parsed_rider", "versions_rider"))
def _(spark, sf):
    return marts.stg_riders(versions(spark, sf, "rider"))


@query("stg_menu_items", f"SELECT menu_item_id, restaurant_id, name AS menu_item_name, CAST(price_inr AS DOUBLE) AS menu_price_inr, is_available, {_WINDOW} FROM versions_menu", ("parsed_menu", "versions_menu"))
def _(spark, sf):
    return marts.stg_menu_items(versions(spark, sf, "menu"))


@query("stg_trips", "SELECT rider_id, trip_id, trip_date, started_ts, ended_ts, round(duration_s / 60.0, 6) AS duration_minutes, ping_count, max_speed_kmph FROM trips_now", ("trips_now",))
def _(spark, sf):
    return marts.stg_trips(trip_rows(spark, sf)).withColumn("duration_minutes", F.round("duration_minutes", 6)).drop("avg_speed_kmph", "straight_line_km")


def bounds(spark: SparkSession, sf: str, days: int) -> DataFrame:
    return calendar.date_bounds(given(spark, sf, "order_changes"), "placed_ts", days)


@query("date_bounds", "SELECT CAST(min(placed_ts) AS DATE) - 1 AS lo, CAST(max(placed_ts) AS DATE) + 1 AS hi FROM order_changes")
def _(spark, sf):
    return bounds(spark, sf, 1)


SHARED["holidays"] = f"SELECT holiday_date, max(holiday_name) AS holiday_name FROM (SELECT holiday_date, holiday_name FROM api_holidays UNION ALL SELECT * FROM (VALUES {', '.join(f'(DATE {chr(39)}{d}{chr(39)}, {chr(39)}{n}{chr(39)})' for d, n, _ in payloads.HOLIDAY_SEED)}) AS s(a, b)) AS every GROUP BY holiday_date"


def holidays(spark: SparkSession, sf: str) -> DataFrame:
    return calendar.holidays_dedup(given(spark, sf, "api_holidays"), payloads.holiday_seed(spark))


@query("holidays_dedup", "SELECT holiday_date, holiday_name FROM holidays", ("holidays",))
def _(spark, sf):
    return holidays(spark, sf)


SHARED["dates"] = f"""SELECT {_md5('date_day')} AS date_sk, date_day, year(date_day) AS year, quarter(date_day) AS quarter, month(date_day) AS month, strftime(date_day, '%B') AS month_name,
  day(date_day) AS day_of_month, weekofyear(date_day) AS week_of_year, dayofweek(date_day) + 1 AS day_of_week, strftime(date_day, '%A') AS day_name,
  dayofweek(date_day) IN (0, 6) AS is_weekend, holiday_date IS NOT NULL AS is_holiday, holiday_name,
  CASE WHEN holiday_date IS NOT NULL THEN 'HOLIDAY' WHEN dayofweek(date_day) IN (0, 6) THEN 'WEEKEND' ELSE 'WEEKDAY' END AS day_type
  FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL '1' DAY)) AS DATE) AS date_day FROM (SELECT CAST(min(placed_ts) AS DATE) - 7 AS lo, CAST(max(placed_ts) AS DATE) + 7 AS hi FROM order_changes) AS b) AS days
  LEFT JOIN holidays ON date_day = holiday_date"""


def dates(spark: SparkSession, sf: str) -> DataFrame:
    return calendar.dim_date(bounds(spark, sf, 7), holidays(spark, sf))


@query("dim_date", "SELECT * REPLACE (CAST(year AS INT) AS year, CAST(quarter AS INT) AS quarter, CAST(month AS INT) AS month, CAST(day_of_month AS INT) AS day_of_month, CAST(week_of_year AS INT) AS week_of_year, CAST(day_of_week AS INT) AS day_of_week) FROM dates", ("holidays", "dates"))
def _(spark, sf):
    return dates(spark, sf)


@query("dim_customer", f"SELECT {_md5('customer_id')} AS customer_sk, customer_id, name AS customer_name, city, tier, is_active, signup_ts, CAST(date_trunc('month', signup_ts) AS TIMESTAMP) AS signup_month, updated_at FROM customers_now WHERE NOT is_deleted", ("customers_now",))
def _(spark, sf):
    return customers(spark, sf)


def customers(spark: SparkSession, sf: str) -> DataFrame:
    return marts.dim_customer(marts.stg_customers(entity_rows(spark, sf, "customer_changes", spec.CUSTOMERS)))


def restaurants(spark: SparkSession, sf: str) -> DataFrame:
    return marts.dim_restaurant(marts.stg_restaurants(versions(spark, sf, "restaurant")))


def riders(spark: SparkSession, sf: str) -> DataFrame:
    return marts.dim_rider(marts.stg_riders(versions(spark, sf, "rider")))


def menu(spark: SparkSession, sf: str) -> DataFrame:
    return marts.dim_menu_item(marts.stg_menu_items(versions(spark, sf, "menu")))


def weather(spark: SparkSession, sf: str) -> DataFrame:
    return calendar.dim_weather(given(spark, sf, "weather"))


@query("dim_restaurant", f"SELECT {_md5('restaurant_id', 'valid_from')} AS restaurant_sk, restaurant_id, name AS restaurant_name, city, cuisine, CAST(commission_pct AS DOUBLE) AS commission_pct, valid_from, effective_from, valid_to, is_current FROM live_restaurant", ("parsed_restaurant", "versions_restaurant", "live_restaurant"))
def _(spark, sf):
    return restaurants(spark, sf).drop("lat", "lon", "rating", "is_open")


@query("dim_rider", f"SELECT {_md5('rider_id', 'valid_from')} AS rider_sk, rider_id, name AS rider_name, city AS rider_city, vehicle_type, tier, valid_from, effective_from, valid_to, is_current FROM live_rider", ("parsed_rider", "versions_rider", "live_rider"))
def _(spark, sf):
    return riders(spark, sf).drop("shift_start", "is_online")


@query("dim_menu_item", f"SELECT {_md5('menu_item_id', 'valid_from')} AS menu_item_sk, menu_item_id, restaurant_id, name AS menu_item_name, CAST(price_inr AS DOUBLE) AS menu_price_inr, is_available, valid_from, effective_from, valid_to, is_current FROM live_menu", ("parsed_menu", "versions_menu", "live_menu"))
def _(spark, sf):
    return menu(spark, sf)


SHARED["weather_dim"] = f"""SELECT {_md5('city', 'weather_date')} AS weather_sk, city, weather_date, precipitation_mm, temp_max_c, temp_min_c, coalesce(precipitation_mm, 0) >= 1.0 AS is_rainy,
  CASE WHEN precipitation_mm IS NULL THEN 'UNKNOWN' WHEN precipitation_mm >= 10 THEN 'HEAVY_RAIN' WHEN precipitation_mm >= 1 THEN 'RAIN' ELSE 'CLEAR' END AS weather_band FROM weather"""


@query("dim_weather", "SELECT * FROM weather_dim", ("weather_dim",))
def _(spark, sf):
    return weather(spark, sf)


@query("city_centroids", "SELECT city, avg(CAST(lat AS DOUBLE)) AS lat, round(avg(CAST(lon AS DOUBLE)), 6) AS lon FROM versions_restaurant WHERE is_current AND NOT is_deleted GROUP BY city", ("parsed_restaurant", "versions_restaurant"))
def _(spark, sf):
    return calendar.city_centroids(versions(spark, sf, "restaurant")).withColumn("lon", F.round(F.col("lon").cast("double"), 6))


_STAR = ("orders_now", "staged_orders", "holidays", "dates", "customers_now", "parsed_restaurant", "versions_restaurant", "live_restaurant", "parsed_rider", "versions_rider", "live_rider", "weather_dim", "deliveries")
SHARED["deliveries"] = f"""SELECT o.*, {_md5('o.order_id')} AS order_sk, d.date_sk, CASE WHEN c.customer_id IS NOT NULL THEN {_md5('c.customer_id')} END AS customer_sk,
  CASE WHEN r.restaurant_id IS NOT NULL THEN {_md5('r.restaurant_id', 'r.valid_from')} END AS restaurant_sk, CASE WHEN rd.rider_id IS NOT NULL THEN {_md5('rd.rider_id', 'rd.valid_from')} END AS rider_sk,
  w.weather_sk, r.city, r.cuisine, CASE WHEN is_delivered THEN late_minutes END AS sla_breach_minutes, CASE WHEN is_delivered THEN late_minutes > 0 END AS sla_breach_flag, subtotal_inr AS gross_revenue_inr,
  round(CAST(subtotal_inr * r.commission_pct * 0.01 AS DECIMAL(18,6)), 2) AS commission_inr, delivery_fee_inr AS rider_payout_inr,
  round(CAST(subtotal_inr * r.commission_pct * 0.01 - discount_inr AS DECIMAL(18,6)), 2) AS contribution_margin_inr, status = 'CANCELLED' AS cancelled_flag,
  d.day_type, d.is_weekend, d.is_holiday, w.weather_band, w.is_rainy
  FROM staged_orders AS o LEFT JOIN dates AS d ON CAST(o.placed_ts AS DATE) = d.date_day
  LEFT JOIN (SELECT * FROM customers_now WHERE NOT is_deleted) AS c ON o.customer_id = c.customer_id
  LEFT JOIN live_restaurant AS r ON o.restaurant_id = r.restaurant_id AND o.placed_ts >= r.effective_from AND (r.valid_to IS NULL OR o.placed_ts < r.valid_to)
  LEFT JOIN live_rider AS rd ON o.rider_id = rd.rider_id AND o.placed_ts >= rd.effective_from AND (rd.valid_to IS NULL OR o.placed_ts < rd.valid_to)
  LEFT JOIN weather_dim AS w ON r.city = w.city AND CAST(o.placed_ts AS DATE) = w.weather_date WHERE NOT o.is_deleted"""


def deliveries(spark: SparkSession, sf: str) -> DataFrame:
    return marts.fact_delivery(staged_orders(spark, sf), dates(spark, sf), customers(spark, sf), restaurants(spark, sf), riders(spark, sf), weather(spark, sf))


@query("fact_delivery", """SELECT order_sk, order_id, date_sk, customer_sk, restaurant_sk, rider_sk, weather_sk, city, cuisine, status, placed_ts, round(total_minutes, 6) AS total_minutes,
  round(sla_breach_minutes, 6) AS sla_breach_minutes, sla_breach_flag, CAST(gross_revenue_inr AS DOUBLE) AS gross_revenue_inr, CAST(commission_inr AS DOUBLE) AS commission_inr,
  CAST(rider_payout_inr AS DOUBLE) AS rider_payout_inr, CAST(contribution_margin_inr AS DOUBLE) AS contribution_margin_inr, cancelled_flag, is_delivered FROM deliveries""", _STAR)
def _(spark, sf):
    f = deliveries(spark, sf)
    return f.select(
        "order_sk", "order_id", "date_sk", "customer_sk", "restaurant_sk", "rider_sk", "weather_sk", "city", "cuisine", "status", "placed_ts", F.round("total_minutes", 6).alias("total_minutes"),
        F.round("sla_breach_minutes", 6).alias("sla_breach_minutes"), "sla_breach_flag", "gross_revenue_inr", "commission_inr", "rider_payout_inr", "contribution_margin_inr", "cancelled_flag", "is_delivered",
    )


_ITEM = ("orders_now", "items_now", "parsed_menu", "versions_menu", "live_menu", "order_lines")
SHARED["order_lines"] = f"""SELECT i.order_item_id, i.order_id, i.menu_item_id, o.restaurant_id, m.name AS menu_item_name, i.qty, i.unit_price_inr, i.line_total_inr, m.price_inr AS menu_price_inr,
  i.unit_price_inr - m.price_inr AS price_variance_inr, o.placed_ts, o.status AS order_status, CASE WHEN m.menu_item_id IS NOT NULL THEN {_md5('m.menu_item_id', 'm.valid_from')} END AS menu_item_sk
  FROM items_now AS i JOIN orders_now AS o ON i.order_id = o.order_id AND NOT o.is_deleted
  LEFT JOIN live_menu AS m ON i.menu_item_id = m.menu_item_id AND o.placed_ts >= m.effective_from AND (m.valid_to IS NULL OR o.placed_ts < m.valid_to) WHERE NOT i.is_deleted"""


def order_heads(spark: SparkSession, sf: str) -> DataFrame:
    """What the lines need of the orders as they are, stored."""
    heads = marts.stg_orders(orders_now(spark, sf, kept=False)).select("order_id", "restaurant_id", "status", "placed_ts", "subtotal_inr", "is_deleted")
    return tables.stored(heads)


def order_lines(spark: SparkSession, sf: str, heads: DataFrame) -> DataFrame:
    items = marts.stg_order_items(decode.parse_changes(change_log(spark, sf, "item_changes", spec.ORDER_ITEMS), spec.ORDER_ITEMS))
    live = marts.dim_menu_item(marts.stg_menu_items(versions(spark, sf, "menu", kept=False)))
    return marts.fact_order_item(tables.stored(items), heads, live)


@query("fact_order_item", """SELECT order_item_id, order_id, menu_item_sk, restaurant_id, menu_item_name, qty, CAST(line_total_inr AS DOUBLE) AS line_total_inr, CAST(menu_price_inr AS DOUBLE) AS menu_price_inr,
  CAST(price_variance_inr AS DOUBLE) AS price_variance_inr, placed_ts, order_status FROM order_lines""", _ITEM)
def _(spark, sf):
    return order_lines(spark, sf, order_heads(spark, sf)).select("order_item_id", "order_id", "menu_item_sk", "restaurant_id", "menu_item_name", "qty", "line_total_inr", "menu_price_inr", "price_variance_inr", "placed_ts", "order_status")


# --- aggregates -------------------------------------------------------------------------

SHARED["daily"] = """SELECT CAST(placed_ts AS DATE) AS order_date, city, restaurant_id, max(day_type) AS day_type, max(is_weekend) AS is_weekend, max(is_holiday) AS is_holiday, max(weather_band) AS weather_band,
  max(is_rainy) AS is_rainy, count(*) AS delivered_orders, count(*) FILTER (WHERE sla_breach_flag) AS breached_orders, round(100.0 * count(*) FILTER (WHERE sla_breach_flag) / count(*), 2) AS sla_breach_pct,
  round(avg(prep_minutes), 2) AS avg_prep_minutes, round(avg(transit_minutes), 2) AS avg_transit_minutes, round(avg(total_minutes), 2) AS avg_total_minutes,
  round(quantile_disc(total_minutes, 0.5), 2) AS p50_total_minutes, round(quantile_disc(total_minutes, 0.95), 2) AS p95_total_minutes, CAST(sum(gross_revenue_inr) AS DOUBLE) AS gross_revenue_inr,
  CAST(sum(commission_inr) AS DOUBLE) AS commission_inr, CAST(sum(contribution_margin_inr) AS DOUBLE) AS contribution_margin_inr FROM deliveries WHERE is_delivered GROUP BY 1, 2, 3"""


def daily(spark: SparkSession, sf: str) -> DataFrame:
    return marts.agg_sla_daily(deliveries(spark, sf), dates(spark, sf), weather(spark, sf))


@query("agg_sla_daily", "SELECT * FROM daily", (*_STAR, "daily"))
def _(spark, sf):
    return daily(spark, sf)


@query("agg_sla_daily_incremental", "SELECT order_date, city, restaurant_id, delivered_orders, gross_revenue_inr FROM daily WHERE order_date >= DATE '1999-07-01' - 3", (*_STAR, "daily"))
def _(spark, sf):
    out = marts.agg_sla_daily_incremental(deliveries(spark, sf), dates(spark, sf), weather(spark, sf), dt.date(1999, 7, 1))
    return out.select("order_date", "city", "restaurant_id", "delivered_orders", "gross_revenue_inr")


@query("sla_period", "SELECT city, count(*) AS delivered_orders, CAST(sum(gross_revenue_inr) AS DOUBLE) AS gross_revenue_inr, TRUE AS p50_is_near, TRUE AS p95_is_near FROM deliveries WHERE is_delivered GROUP BY city", _STAR)
def _(spark, sf):
    """All days of a city from the stored parts of its days, half of which were built by a second run;
    the quantiles' true ranks are counted over the facts."""
    base = tables.scratch_dir(spark)
    facts = tables.stored(deliveries(spark, sf).select("placed_ts", "city", "restaurant_id", "total_minutes", "is_delivered", "sla_breach_flag", "gross_revenue_inr", "commission_inr", "contribution_margin_inr"))
    odd = F.dayofmonth("placed_ts") % 2 == 1
    tables.append_partitioned(marts.sla_parts(facts.where(odd)), base, "order_date")
    tables.overwrite_days(marts.sla_parts(facts.where(~odd)), base, "order_date")
    whole = tables.stored(marts.sla_period(spark.read.parquet(base), ["city"]))
    near = []
    ranked = facts.where("is_delivered").join(whole.select(F.col("city").alias("c"), "p50_total_minutes", "p95_total_minutes"), F.col("city").eqNullSafe(F.col("c")))
    for p, q in (("p50", 0.5), ("p95", 0.95)):
        below, upto = (F.avg(x.cast("double")) for x in (F.col("total_minutes") < F.col(f"{p}_total_minutes"), F.col("total_minutes") <= F.col(f"{p}_total_minutes")))
        near.append(((below <= q + 0.02) & (upto >= q - 0.02)).alias(f"{p}_is_near"))
    ranks = ranked.groupBy("city").agg(*near).withColumnRenamed("city", "c")
    return whole.join(ranks, F.col("city").eqNullSafe(F.col("c"))).select("city", "delivered_orders", "gross_revenue_inr", "p50_is_near", "p95_is_near")


@query("sla_by_hour", "SELECT city, restaurant_id, CAST(hour(placed_ts) AS INT) AS hour_of_day, count(*) AS delivered_orders, round(100.0 * count(*) FILTER (WHERE sla_breach_flag) / count(*), 2) AS sla_breach_pct FROM deliveries WHERE is_delivered GROUP BY 1, 2, 3", _STAR)
def _(spark, sf):
    return marts.sla_by_hour(deliveries(spark, sf))


@query("unit_economics", """SELECT city, CASE WHEN prep_minutes >= transit_minutes THEN 'PREP' ELSE 'TRANSIT' END AS slower_part, count(*) AS orders, CAST(sum(contribution_margin_inr) AS DOUBLE) AS contribution_margin_inr
  FROM deliveries WHERE is_delivered GROUP BY 1, 2""", _STAR)
def _(spark, sf):
    return marts.unit_economics(deliveries(spark, sf)).drop("avg_margin_inr")


@query("weather_impact", "SELECT city, is_rainy, count(*) AS orders, round(quantile_disc(transit_minutes, 0.5), 2) AS median_transit_minutes FROM deliveries WHERE is_delivered AND weather_sk IS NOT NULL GROUP BY 1, 2", _STAR)
def _(spark, sf):
    return marts.weather_impact(deliveries(spark, sf), weather(spark, sf))


@query("cohort_retention", """SELECT CAST(date_trunc('month', c.signup_ts) AS TIMESTAMP) AS signup_month, CAST((year(placed_ts) - year(c.signup_ts)) * 12 + month(placed_ts) - month(c.signup_ts) AS INT) AS months_later,
  count(DISTINCT d.customer_id) AS customers FROM deliveries AS d JOIN customers_now AS c ON d.customer_id = c.customer_id AND NOT c.is_deleted GROUP BY 1, 2""", _STAR)
def _(spark, sf):
    return marts.cohort_retention(deliveries(spark, sf), customers(spark, sf))


@query("volume_delta", """SELECT order_date, orders, round(avg(orders) OVER w, 2) AS baseline, round((orders / round(avg(orders) OVER w, 2) - 1) * 100, 2) AS delta_pct
  FROM (SELECT CAST(placed_ts AS DATE) AS order_date, count(*) AS orders FROM staged_orders WHERE NOT is_deleted GROUP BY 1) AS d WINDOW w AS (ORDER BY order_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""", ("orders_now", "staged_orders"))
def _(spark, sf):
    return marts.volume_delta(staged_orders(spark, sf).where("not is_deleted"))


@query("agg_rider_utilisation", """SELECT rider_id, trip_date, count(*) AS trips, round((max(epoch_us(ended_ts)) - min(epoch_us(started_ts))) // 1000000 / 60.0, 2) AS span_minutes FROM trips_now GROUP BY rider_id, trip_date""", ("trips_now",))
def _(spark, sf):
    return marts.agg_rider_utilisation(trip_rows(spark, sf)).select("rider_id", "trip_date", "trips", "span_minutes")


@query("line_sum_per_order", "SELECT order_id, CAST(sum(line_total_inr) AS DOUBLE) AS line_sum_inr FROM items_now GROUP BY order_id", ("items_now",))
def _(spark, sf):
    return datatests.line_sum_per_order(marts.stg_order_items(entity_rows(spark, sf, "item_changes", spec.ORDER_ITEMS)))


# --- quality ----------------------------------------------------------------------------

#: order_suite in SQL.
_ORDER_RULES = {
    "order_id_present": "order_id IS NOT NULL",
    "status_is_known": "status IN ('PLACED', 'ACCEPTED', 'PICKED_UP', 'DELIVERED', 'CANCELLED')",
    "placed_ts_present": "placed_ts IS NOT NULL",
    "total_not_negative": "total_inr >= 0",
    "total_reconciles": "abs(total_inr - (subtotal_inr + delivery_fee_inr - discount_inr)) <= 0.01",
    "promised_after_placed": "promised_ts >= placed_ts",
    "delivered_after_placed": "delivered_ts IS NULL OR delivered_ts >= placed_ts",
    "rider_assigned_once_picked_up": "is_deleted OR status NOT IN ('PICKED_UP', 'DELIVERED') OR rider_id IS NOT NULL",
}


def _violations(rules: dict[str, str]) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN NOT coalesce({r}, FALSE) THEN '{n}' END" for n, r in sorted(rules.items())) + "], lambda x: x IS NOT NULL)"


def _joined(rules: dict[str, str]) -> str:
    return f"array_to_string({_violations(rules)}, ',')"


SHARED["judged_orders"] = f"SELECT *, {_violations(_ORDER_RULES)} AS violations FROM orders_now"
_JUDGED = ("orders_now", "judged_orders")


def orders_now(spark: SparkSession, sf: str, kept: bool = True) -> DataFrame:
    if kept:
        return decode.latest_changes(order_log(spark, sf), spec.ORDERS)
    return decode.latest_changes(change_log(spark, sf, "order_changes", spec.ORDERS, key="order_id"), spec.ORDERS, key="pk")


def _names(df: DataFrame) -> Column:
    return F.array_join("violations", ",").alias("violations")


@query("validate", "SELECT order_id, array_to_string(violations, ',') AS violations FROM judged_orders WHERE len(violations) > 0", _JUDGED)
def _(spark, sf):
    failed = expectations.validate(orders_now(spark, sf), expectations.order_suite()).failed
    return failed.select("order_id", _names(failed))


@query("order_suite", "SELECT order_id, array_to_string(violations, ',') AS violations FROM judged_orders", _JUDGED)
def _(spark, sf):
    rows = expectations.with_violations(orders_now(spark, sf), expectations.order_suite())
    return rows.select("order_id", _names(rows))


@query("violation_counts", "SELECT unnest(violations) AS violation, count(*) AS row_count FROM judged_orders GROUP BY 1", _JUDGED)
def _(spark, sf):
    return expectations.violation_counts(expectations.validate(orders_now(spark, sf), expectations.order_suite()).failed)


@query("run_gate", """SELECT 'fact_order_state' AS table_name, count(*) AS total_rows, count(*) FILTER (WHERE len(violations) = 0) AS passed_rows, count(*) FILTER (WHERE len(violations) > 0) AS quarantined_rows,
  CASE WHEN count(*) FILTER (WHERE len(violations) > 0) > 0 THEN 1 ELSE 0 END AS status FROM judged_orders""", _JUDGED)
def _(spark, sf):
    return expectations.run_gate(orders_now(spark, sf), expectations.order_suite(), "fact_order_state")


_SCD2_RULES = {
    "key_present": "menu_item_id IS NOT NULL",
    "valid_from_present": "valid_from IS NOT NULL",
    "window_is_forward": "valid_to IS NULL OR valid_to > valid_from",
    "current_is_open_ended": "NOT is_current OR valid_to IS NULL",
    "closed_is_not_current": "valid_to IS NULL OR NOT is_current",
}


@query("scd2_suite", f"SELECT menu_item_id, lsn, {_joined(_SCD2_RULES)} AS violations FROM (SELECT * REPLACE (CASE WHEN lsn % 7 = 0 THEN valid_from ELSE valid_to END AS valid_to) FROM versions_menu) AS v", ("parsed_menu", "versions_menu"))
def _(spark, sf):
    rows = versions(spark, sf, "menu").withColumn("valid_to", F.when(F.col("lsn") % 7 == 0, F.col("valid_from")).otherwise(F.col("valid_to")))
    rows = expectations.with_violations(rows, expectations.scd2_suite("menu_item_id"))
    return rows.select("menu_item_id", "lsn", _names(rows))


_TRIP_RULES = {
    "trip_id_present": "trip_id IS NOT NULL",
    "rider_id_present": "rider_id IS NOT NULL",
    "has_pings": "ping_count > 0",
    "duration_not_negative": "duration_s >= 0",
    "ends_after_it_starts": "ended_ts >= started_ts",
    "avg_speed_within_max": "round(avg_speed_kmph, 6) <= round(max_speed_kmph - 0.5, 6)",
    "distance_is_plausible": "straight_line_km < 500",
}


@query("trips_suite", f"SELECT rider_id, trip_id, {_joined(_TRIP_RULES)} AS violations FROM trips_now", ("trips_now",))
def _(spark, sf):
    rows = trip_rows(spark, sf).withColumns({"avg_speed_kmph": F.round("avg_speed_kmph", 6), "max_speed_kmph": F.round(F.col("max_speed_kmph") - 0.5, 6)})
    rows = expectations.with_violations(rows, expectations.trips_suite())
    return rows.select("rider_id", "trip_id", _names(rows))


_PING_RULES = {
    "rider_id_present": "rider_id IS NOT NULL",
    "event_ts_present": "event_ts IS NOT NULL",
    "lat_in_range": "lat * 6.9 BETWEEN -90 AND 90",
    "lon_in_range": "lon BETWEEN -180 AND 180",
    "speed_not_negative": "speed_kmph - 1 >= 0",
    "heading_in_range": "heading_deg >= 0 AND heading_deg < 360",
}


@query("ping_suite", f"""SELECT offset_no AS "offset", {_joined(_PING_RULES)} AS violations FROM pings""")
def _(spark, sf):
    rows = pings(spark, sf).withColumns({"lat": F.col("lat") * 6.9, "speed_kmph": F.col("speed_kmph") - 1})
    rows = expectations.with_violations(rows, expectations.ping_suite())
    return rows.select("offset", _names(rows))


_DEPTH = "(CASE status WHEN 'PLACED' THEN 1 WHEN 'ACCEPTED' THEN 2 WHEN 'PICKED_UP' THEN 3 WHEN 'DELIVERED' THEN 4 ELSE 0 END)"
_LIFE_RULES = {
    "accepted_ts_in_order": "accepted_ts IS NULL OR placed_ts IS NULL OR accepted_ts >= placed_ts",
    "picked_up_ts_in_order": "picked_up_ts IS NULL OR greatest(placed_ts, accepted_ts) IS NULL OR picked_up_ts >= greatest(placed_ts, accepted_ts)",
    "delivered_ts_in_order": "delivered_ts IS NULL OR greatest(placed_ts, accepted_ts, picked_up_ts) IS NULL OR delivered_ts >= greatest(placed_ts, accepted_ts, picked_up_ts)",
    "accepted_ts_once_earned": f"{_DEPTH} < 2 OR accepted_ts IS NOT NULL",
    "accepted_ts_not_before": f"status = 'CANCELLED' OR {_DEPTH} >= 2 OR accepted_ts IS NULL",
    "picked_up_ts_once_earned": f"{_DEPTH} < 3 OR picked_up_ts IS NOT NULL",
    "picked_up_ts_not_before": f"status = 'CANCELLED' OR {_DEPTH} >= 3 OR picked_up_ts IS NULL",
    "delivered_ts_once_earned": f"{_DEPTH} < 4 OR delivered_ts IS NOT NULL",
    "delivered_ts_not_before": f"status = 'CANCELLED' OR {_DEPTH} >= 4 OR delivered_ts IS NULL",
    "reason_exactly_if_cancelled": "(status = 'CANCELLED') = (cancel_reason IS NOT NULL)",
}


@query("lifecycle_suite", f"SELECT order_id, {_joined(_LIFE_RULES)} AS violations FROM (SELECT * REPLACE (CASE WHEN order_id % 10 = 0 THEN 'DELIVERED' WHEN order_id % 10 = 1 THEN 'CANCELLED' ELSE status END AS status) FROM orders_now) AS o", ("orders_now",))
def _(spark, sf):
    rows = orders_now(spark, sf).withColumn("status", F.when(F.col("order_id") % 10 == 0, "DELIVERED").when(F.col("order_id") % 10 == 1, "CANCELLED").otherwise(F.col("status")))
    rows = expectations.with_violations(rows, expectations.lifecycle_suite())
    return rows.select("order_id", _names(rows))


@query("transition_check", """SELECT order_id, lsn, before AS from_status, status FROM (SELECT *, lag(status) OVER (PARTITION BY order_id ORDER BY lsn) AS before
  FROM (SELECT * REPLACE (CASE WHEN order_id % 10 = 0 AND lsn % 8 = 1 THEN 'DELIVERED' ELSE status END AS status) FROM order_changes) AS c) AS l WHERE before <> status AND concat(before, '>', status) NOT IN
  ('PLACED>ACCEPTED', 'PLACED>CANCELLED', 'ACCEPTED>PICKED_UP', 'ACCEPTED>CANCELLED', 'PICKED_UP>DELIVERED', 'PICKED_UP>CANCELLED')""")
def _(spark, sf):
    skip = (F.col("order_id") % 10 == 0) & (F.col("lsn") % 8 == 1)
    rows = order_rows(spark, sf).withColumn("status", F.when(skip, "DELIVERED").otherwise(F.col("status")))
    return expectations.transition_check(rows).select("order_id", "lsn", "from_status", "status")


for _table, _input, _broken, _entity in (
    ("customers", "customer_changes", "tier", spec.CUSTOMERS), ("restaurants", "restaurant_changes", None, spec.RESTAURANTS), ("menu_items", "menu_changes", None, spec.MENU_ITEMS),
    ("riders", "rider_changes", None, spec.RIDERS), ("orders", "order_changes", None, spec.ORDERS), ("order_items", "item_changes", None, spec.ORDER_ITEMS),
    ("payments", "payments", None, spec.PAYMENTS),
):
    _swap = f"(SELECT * REPLACE (CASE WHEN {_entity.key} % 7 = 0 THEN 'x' ELSE tier END AS tier) FROM {_input}) AS t" if _broken else _input

    @query(f"domain_suite_{_table}", f"SELECT {_entity.key}, lsn, {_joined(expectations.DOMAINS[_table])} AS violations FROM {_swap}")
    def _(spark, sf, table=_table, name=_input, broken=_broken, entity=_entity):
        rows = given(spark, sf, name)
        if broken:
            rows = rows.withColumn(broken, F.when(F.col(entity.key) % 7 == 0, "x").otherwise(F.col(broken)))
        rows = expectations.with_violations(rows, expectations.domain_suite(table))
        return rows.select(entity.key, "lsn", _names(rows))


@query("test_not_null", "SELECT order_id, status FROM orders_now WHERE rider_id IS NULL", ("orders_now",))
def _(spark, sf):
    return datatests.test_not_null(orders_now(spark, sf), "rider_id").select("order_id", "status")


@query("test_unique", "SELECT pk, count(*) AS n FROM changes GROUP BY pk HAVING count(*) > 1")
def _(spark, sf):
    return datatests.test_unique(given(spark, sf, "changes"), "pk")


@query("having_duplicates", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def _(spark, sf):
    return datatests.having_duplicates(spark.read.parquet(f"{sf}/lineitem.parquet"), ["l_orderkey", "l_linenumber"])


@query("test_accepted_values", "SELECT status, count(*) AS n FROM changes WHERE status NOT IN ('view', 'click') GROUP BY status")
def _(spark, sf):
    return datatests.test_accepted_values(given(spark, sf, "changes"), "status", ["view", "click"])


@query("test_relationships", "SELECT order_id, restaurant_id FROM orders_now AS o WHERE restaurant_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM live_restaurant AS r WHERE r.restaurant_id = o.restaurant_id AND r.is_open AND r.restaurant_id % 7 <> 0)", ("orders_now", "parsed_restaurant", "versions_restaurant", "live_restaurant"))
def _(spark, sf):
    return datatests.test_relationships(orders_now(spark, sf), "restaurant_id", restaurants(spark, sf).where("is_open and restaurant_id % 7 <> 0"), "restaurant_id").select("order_id", "restaurant_id")


@query("assert_delivery_timeline", "SELECT order_id FROM (SELECT * REPLACE (CASE WHEN order_id % 9 = 0 THEN picked_up_ts - INTERVAL '1' DAY ELSE delivered_ts END AS delivered_ts) FROM orders_now) AS o WHERE accepted_ts < placed_ts OR picked_up_ts < accepted_ts OR delivered_ts < picked_up_ts", ("orders_now",))
def _(spark, sf):
    rows = orders_now(spark, sf).withColumn("delivered_ts", F.when(F.col("order_id") % 9 == 0, F.col("picked_up_ts") - F.expr("INTERVAL 1 DAY")).otherwise(F.col("delivered_ts")))
    return datatests.assert_delivery_timeline(rows).select("order_id")


@query("assert_line_totals", """SELECT d.order_id, CAST(d.gross_revenue_inr AS DOUBLE) AS gross_revenue_inr, CAST(l.s AS DOUBLE) AS line_sum_inr, CAST(d.gross_revenue_inr - l.s AS DOUBLE) AS difference_inr
  FROM (SELECT order_id, subtotal_inr AS gross_revenue_inr FROM staged_orders WHERE NOT is_deleted) AS d JOIN (SELECT order_id, sum(line_total_inr) AS s FROM order_lines GROUP BY order_id) AS l ON d.order_id = l.order_id WHERE abs(d.gross_revenue_inr - l.s) > 1.00""",
  ("orders_now", "staged_orders", *_ITEM[1:]))
def _(spark, sf):
    heads = order_heads(spark, sf)
    orders = heads.where("not is_deleted").select("order_id", F.col("subtotal_inr").alias("gross_revenue_inr"))
    return datatests.assert_line_totals(orders, order_lines(spark, sf, heads))


@query("assert_one_version", "SELECT order_id, 2 AS n FROM deliveries WHERE order_id % 13 = 0", _STAR)
def _(spark, sf):
    """Facts of which some came twice, as a join over overlapping windows would give them."""
    facts = deliveries(spark, sf).withColumn("copy", F.explode(F.when(F.col("order_id") % 13 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    return datatests.assert_one_version(facts.drop("copy"))


@query("assert_pct_bounds", """SELECT order_date, city, restaurant_id FROM (SELECT * REPLACE (CASE WHEN restaurant_id % 10 = 0 THEN sla_breach_pct + 101 ELSE sla_breach_pct END AS sla_breach_pct,
  CASE WHEN restaurant_id % 10 = 1 THEN delivered_orders + 1 ELSE breached_orders END AS breached_orders) FROM daily) AS d WHERE sla_breach_pct NOT BETWEEN 0 AND 100 OR breached_orders > delivered_orders""", (*_STAR, "daily"))
def _(spark, sf):
    """Aggregates of which some have an impossible share or too many breaches."""
    last = F.col("restaurant_id") % 10
    rows = daily(spark, sf).withColumns({"sla_breach_pct": F.when(last == 0, F.col("sla_breach_pct") + 101).otherwise(F.col("sla_breach_pct")), "breached_orders": F.when(last == 1, F.col("delivered_orders") + 1).otherwise(F.col("breached_orders"))})
    return datatests.assert_pct_bounds(rows).select("order_date", "city", "restaurant_id")


@query("freshness", "SELECT max(event_ts) AS newest, round((epoch(TIMESTAMP '2024-02-01 00:00:00') - floor(epoch(max(event_ts)))) // 1 / 3600.0, 2) AS hours_old, 'stale' AS status FROM changes")
def _(spark, sf):
    out = reports.freshness(given(spark, sf, "changes"), "event_ts", F.lit(dt.datetime(2024, 2, 1)), 1.0)
    return out.withColumn("hours_old", F.round("hours_old", 2))


@query("global_freshness", "SELECT max(event_ts) AS newest FROM changes")
def _(spark, sf):
    return reports.freshness(given(spark, sf, "changes"), "event_ts").select("newest")


@query("coverage", """SELECT n_name AS city, coalesce(n, 0) AS n, coalesce(n, 0) >= 2000 AS is_covered FROM nation LEFT JOIN
  (SELECT city, count(*) FILTER (WHERE city <> 'NATION_3') AS n FROM weather WHERE precipitation_mm IS NOT NULL GROUP BY city) AS w ON n_name = city""")
def _(spark, sf):
    expected = spark.read.parquet(f"{sf}/nation.parquet").select(F.col("n_name").alias("city"))
    return reports.coverage(given(spark, sf, "weather").where("city <> 'NATION_3'"), "city", expected, "precipitation_mm", 2000)


@query("content_checksum", "SELECT count(*) AS row_count, TRUE AS is_free_of_order, TRUE AS tells_a_change FROM order_changes")
def _(spark, sf):
    """The checksum of a table, of the same rows dealt anew, and of rows one of which is changed."""
    path = tables.scratch_dir(spark)
    given(spark, sf, "order_changes").write.parquet(path)
    rows = spark.read.parquet(path)
    newest = rows.agg(F.max("lsn")).first()[0]
    touched = rows.withColumn("status", F.when(F.col("lsn") == newest, "LOST").otherwise(F.col("status")))
    one, two, three = (reports.content_checksum(x) for x in (rows, rows.repartition(7, "lsn").select(*reversed(rows.columns)), touched))
    sums = reduce(DataFrame.union, [x.withColumn("which", F.lit(n)) for n, x in enumerate((one, two, three))])
    sums = sums.groupBy().pivot("which", [0, 1, 2]).agg(F.first("row_count").alias("n"), F.first("content_hash").alias("h"))
    return sums.select(F.col("0_n").alias("row_count"), ((F.col("0_n") == F.col("1_n")) & (F.col("0_h") == F.col("1_h"))).alias("is_free_of_order"), (F.col("0_h") != F.col("2_h")).alias("tells_a_change"))


_DAY = dt.date(1999, 7, 1)


@query("prove_backfill", f"SELECT count(*) AS before_rows, 0 AS deleted_rows, count(*) AS after_rows, TRUE AS is_equal FROM daily WHERE order_date = DATE '{_DAY}'", (*_STAR, "daily"))
def _(spark, sf):
    """A day of the aggregate deleted and rebuilt from the facts, which are stored once."""
    path = tables.scratch_dir(spark)
    deliveries(spark, sf).write.parquet(path)
    facts, d, w = spark.read.parquet(path), dates(spark, sf), weather(spark, sf)
    proof = reports.prove_backfill(marts.agg_sla_daily(facts, d, w), lambda x: marts.agg_sla_daily_incremental(facts, d, w, x, backfill=x), "order_date", _DAY)
    return proof.select("before_rows", "deleted_rows", "after_rows", "is_equal")


@query("reconcile_counts", """SELECT count(*) AS messages, count(*) FILTER (WHERE kind = 'tombstone') AS tombstones, count(*) FILTER (WHERE kind = 'undecodable') AS quarantined,
  (SELECT count(*) FROM (SELECT DISTINCT source_table, pk, lsn FROM kinds WHERE kind = 'good') AS i) AS landed, (SELECT count(*) FROM (SELECT DISTINCT source_table, pk, lsn FROM kinds WHERE kind = 'good') AS i) AS identities,
  count(*) FILTER (WHERE kind = 'good') - (SELECT count(*) FROM (SELECT DISTINCT source_table, pk, lsn FROM kinds WHERE kind = 'good') AS i) AS redelivered, TRUE AS is_consistent FROM kinds""", ("kinds",))
def _(spark, sf):
    """Messages are counted as they land: decoded once."""
    batch, told = reports.observed_kinds(decoded(spark, sf), decode.kind_of("envelope.op"))
    landed = tables.stored(state.dedup_changes(_flat(decode.classify_batch(batch).good)).select(*state.CHANGE_IDENTITY))
    return reports.reconcile_counts(told, landed, state.CHANGE_IDENTITY)


@query("null_rate_check", """SELECT day, column_name, null_rate FROM (SELECT CAST(placed_ts AS DATE) AS day, 'rider_id' AS column_name, avg(CASE WHEN rider_id IS NULL THEN 1.0 ELSE 0.0 END) AS null_rate FROM orders_now GROUP BY 1
  UNION ALL SELECT CAST(placed_ts AS DATE), 'delivered_ts', avg(CASE WHEN delivered_ts IS NULL THEN 1.0 ELSE 0.0 END) FROM orders_now GROUP BY 1) AS r WHERE null_rate > 0.7""", ("orders_now",))
def _(spark, sf):
    return reports.null_rate_check(orders_now(spark, sf), F.to_date("placed_ts"), ["rider_id", "delivered_ts"], 0.7)


@query("late_reconciliation", f"SELECT {_ORDER_SQL} FROM orders_now", ("orders_now",))
def _(spark, sf):
    """A stored table of orders that gets one step of each order's changes late."""
    rows = decode.with_key(order_log(spark, sf), spec.ORDERS)
    table = keyed.KeyedTable(spark, tables.scratch_dir(spark), ["order_id"])
    merge = lambda old, new: decode.latest_changes(new, spec.ORDERS) if old is None else state.merge_latest_guarded(old, decode.parse_changes(new, spec.ORDERS), ["order_id"])
    table.merge(rows.where("lsn % 8 <> 2"), 0, merge)
    table.merge(rows.where("lsn % 8 = 2"), 1, merge)
    return table.read().select(*_ORDER_COLUMNS)


# --- streams ----------------------------------------------------------------------------


def fed(parts: list[DataFrame], folder: str, run: Callable[[], object]) -> None:
    """Appends one part after the other to a folder, each as its partitions are, and runs the
    stream after each: it goes on from its checkpoint and takes what is new, up to
    ``BYTES_PER_TRIGGER`` in a batch."""
    for part in parts:
        part.write.mode("append").parquet(folder)
        run()


@query("foreach_batch_sink", "SELECT DISTINCT source_table, pk, lsn, op FROM kinds WHERE kind = 'good'", ("kinds",))
def _(spark, sf):
    """Messages decoded and merged batch by batch; the last batch brings a fifth of all again."""
    base = tables.scratch_dir(spark)
    raw = inputs.messages(given(spark, sf, "changes"))
    table = keyed.KeyedTable(spark, f"{base}/bronze", state.CHANGE_IDENTITY)

    def prepare(batch: DataFrame) -> DataFrame:
        good = decode.classify_batch(decode.decode_envelope(decode.strip_wire_header(batch), inputs.ENVELOPE)).good
        return state.dedup_changes(_flat(good))

    merge = lambda old, new: new if old is None else state.merge_insert_only(old, new, state.CHANGE_IDENTITY)

    def run():
        stream = streams.read_change_stream(spark, f"{base}/in", schema=raw.schema)
        streams.foreach_batch_sink(stream, table.merging(merge, prepare), f"{base}/ck", f"bronze_{abs(hash(base))}").awaitTermination()

    third = F.pmod(F.xxhash64("topic", "offset"), F.lit(3))
    fed([*(raw.where(third == i) for i in range(3)), raw.where("offset % 5 = 0")], f"{base}/in", run)
    return table.read().select("source_table", "pk", "lsn", "op")


@query("read_table_stream", f"SELECT menu_item_id, attr_hash, {_WINDOW} FROM versions_menu", ("parsed_menu", "versions_menu"))
def _(spark, sf):
    """A stored change log read as a stream into a dimension.  A trigger takes as many files as its
    bytes allow, in no order of the log; so the sink keeps every change, and windows are cut over all."""
    base = tables.scratch_dir(spark)
    rows = inputs.as_bronze(given(spark, sf, "menu_changes"), spec.MENU_ITEMS.fields)
    log = streams.ChangeLog(spark, f"{base}/dim", lambda batch: decode.parse_dim_changes(batch, spec.MENU_ITEMS))

    def run():
        stream = streams.read_table_stream(spark, f"{base}/log", rows.schema)
        streams.foreach_batch_sink(stream, log.write, f"{base}/ck", f"dim_{abs(hash(base))}").awaitTermination()

    fed([rows.where(F.col("lsn") <= _CUT), rows.where(F.col("lsn") > _CUT)], f"{base}/log", run)
    return history.scd2_versions(log.read(["menu_item_id", "lsn", "attr_hash"]), "menu_item_id").select("menu_item_id", "attr_hash", *_WINDOW_COLUMNS)


_DAY_TRIPS = "(SELECT * REPLACE (concat(trip_id, '-', CAST(CAST(event_ts AS DATE) AS VARCHAR)) AS trip_id) FROM pings) AS p"


def _day_trips(spark: SparkSession, sf: str) -> DataFrame:
    """Pings with a trip for each day."""
    p = pings(spark, sf).withColumn("trip_id", F.concat("trip_id", F.lit("-"), F.to_date("event_ts").cast("string")))
    return p.select("rider_id", "trip_id", "lat", "lon", "speed_kmph", "event_ts", "offset")


def _thirds(p: DataFrame) -> list[DataFrame]:
    return [p.where(F.dayofmonth("arrived").between(*days)).drop("arrived") for days in ((1, 10), (11, 20), (21, 31))]


@query("trips_stream", f"""SELECT rider_id, trip_id, started_ts, ended_ts, ping_count, max_speed_kmph, round({_HAVERSINE.format(a='start_lat', b='end_lat', c='start_lon', d='end_lon')}, 6) AS straight_line_km, CAST(started_ts AS DATE) AS trip_date
  FROM (SELECT rider_id, trip_id, min(event_ts) AS started_ts, max(event_ts) AS ended_ts, count(*) AS ping_count, max(speed_kmph) AS max_speed_kmph, arg_min(lat, event_ts) AS start_lat, arg_min(lon, event_ts) AS start_lon,
    arg_max(lat, event_ts) AS end_lat, arg_max(lon, event_ts) AS end_lon FROM {_DAY_TRIPS} GROUP BY 1, 2) AS ends""")
def _(spark, sf):
    """Pings of a day's trips as a stream in time order; the last update of each trip."""
    base = tables.scratch_dir(spark)
    p = _day_trips(spark, sf).drop("offset").withColumn("arrived", F.col("event_ts"))
    table = keyed.KeyedTable(spark, f"{base}/trips", trips.TRIP_KEY)
    merge = lambda old, batch: batch if old is None else state.merge_restate(old, batch, trips.TRIP_KEY)

    def run():
        stream = streams.trips_stream(streams.read_ping_stream(spark, f"{base}/pings", schema=p.drop("arrived").schema), "2 days")
        streams.foreach_batch_sink(stream, table.merging(merge), f"{base}/ck", f"trips_{abs(hash(base))}", mode="update").awaitTermination()

    fed(_thirds(p), f"{base}/pings", run)
    return table.read().select("rider_id", "trip_id", "started_ts", "ended_ts", "ping_count", "max_speed_kmph", F.round("straight_line_km", 6).alias("straight_line_km"), "trip_date")


@query("late_pings_stream", """SELECT offset_no AS "offset", event_ts FROM (SELECT offset_no, CASE WHEN offset_no % 50 = 0 THEN event_ts - INTERVAL '9' DAY ELSE event_ts END AS event_ts, least(CAST(day(event_ts) - 1 AS BIGINT) // 10, 2) AS part FROM pings) AS p
  JOIN (SELECT part + 1 AS after, max(max(event_ts)) OVER (ORDER BY part) AS newest FROM (SELECT CASE WHEN offset_no % 50 = 0 THEN event_ts - INTERVAL '9' DAY ELSE event_ts END AS event_ts, least(CAST(day(event_ts) - 1 AS BIGINT) // 10, 2) AS part FROM pings) AS q GROUP BY part) AS n
  ON part = after WHERE event_ts < newest - INTERVAL '2' DAY""")
def _(spark, sf):
    """What a stream of pings would drop behind its watermark, kept batch by batch."""
    base = tables.scratch_dir(spark)
    p = pings(spark, sf).select("offset", F.col("event_ts").alias("arrived"), F.when(F.col("offset") % 50 == 0, F.col("event_ts") - F.expr("INTERVAL 9 DAYS")).otherwise(F.col("event_ts")).alias("event_ts"))
    keeper = streams.LateRows(spark, f"{base}/late", "2 days")

    def run():
        stream = streams.read_ping_stream(spark, f"{base}/pings", schema=p.drop("arrived").schema)
        streams.foreach_batch_sink(stream, keeper.write, f"{base}/ck", f"late_{abs(hash(base))}").awaitTermination()

    fed(_thirds(p), f"{base}/pings", run)
    return keeper.read(p.drop("arrived").schema).select("offset", "event_ts")


def _drained(spark: SparkSession, base: str, stream: DataFrame, name: str) -> DataFrame:
    """All a stream brings until it has nothing left, batch by batch appended to a table."""
    append = lambda batch, number: batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(f"{base}/out")
    streams.foreach_batch_sink(stream, append, f"{base}/ck", f"{name}_{abs(hash(base))}").awaitTermination()
    return spark.read.parquet(f"{base}/out")


@query("read_change_stream", "SELECT topic, count(*) AS messages, count(*) FILTER (WHERE kind = 'tombstone') AS tombstones, 3 AS batches FROM kinds GROUP BY topic", ("kinds",))
def _(spark, sf):
    """Three parts of the log, a batch each."""
    base = tables.scratch_dir(spark)
    raw = inputs.messages(given(spark, sf, "changes"))
    got = []

    def run():
        got[:] = [_drained(spark, base, streams.read_change_stream(spark, f"{base}/in", schema=raw.schema), "changes")]

    fed([raw.where(F.pmod(F.xxhash64("topic", "offset"), F.lit(3)) == i) for i in range(3)], f"{base}/in", run)
    return got[0].groupBy("topic").agg(F.count(F.lit(1)).alias("messages"), F.count_if(F.col("value").isNull()).alias("tombstones"), F.count_distinct("batch").cast("int").alias("batches"))


@query("read_ping_stream", "SELECT rider_id, count(*) AS pings FROM pings GROUP BY rider_id")
def _(spark, sf):
    base = tables.scratch_dir(spark)
    p = pings(spark, sf).drop("accuracy_m")
    p.write.parquet(f"{base}/in")
    got = _drained(spark, base, streams.read_ping_stream(spark, f"{base}/in", schema=p.schema, files=2), "pings")
    return got.groupBy("rider_id").agg(F.count(F.lit(1)).alias("pings"))


@query("bounded_triggers", "SELECT count(*) AS messages, TRUE AS is_bounded, TRUE AS is_split FROM kinds", ("kinds",))
def _(spark, sf):
    """A log landed in files of at most as many changes as a trigger may take, a file in a trigger.  It lies
    in lanes, each of which is a query of its own: triggers are small, so most of one's time is waiting.
    What a trigger took is counted in what its batch wrote, as a listener lags behind so many."""
    base = tables.scratch_dir(spark)
    raw = inputs.messages(given(spark, sf, "changes"))
    lanes = streams.land_in_lanes(raw, f"{base}/in", ["topic", "offset"])

    def start(lane: str):
        stream = streams.read_change_stream(spark, f"{base}/in/{lane}", schema=raw.schema, files=1)
        return streams.foreach_batch_sink(stream, lambda batch, n: batch.write.mode("overwrite").parquet(f"{base}/out/{lane}/batch={n}"), f"{base}/ck/{lane}", f"bounded_{lane}_{abs(hash(base))}", hold=False)

    for running in [start(lane) for lane in lanes]:
        running.awaitTermination()
    taken = spark.read.parquet(f"{base}/out").groupBy("lane", "batch").agg(F.count(F.lit(1)).alias("n"))
    bounded, split = F.max("n") <= streams.CHANGES_PER_TRIGGER, F.count(F.lit(1)) * streams.CHANGES_PER_TRIGGER >= F.sum("n")
    return taken.agg(F.sum("n").alias("messages"), bounded.alias("is_bounded"), split.alias("is_split"))


@query("dedup_changes_stream", "SELECT DISTINCT source_table, pk, lsn, op FROM changes")
def _(spark, sf):
    """Changes in time order, a part of each delivered again with the next part; the state keeps
    the identities of 40 days."""
    base = tables.scratch_dir(spark)
    c = given(spark, sf, "changes").select("source_table", "pk", "lsn", "op", "event_ts").withColumn("arrived", F.col("event_ts"))
    one, two, three = _thirds(c)
    again = lambda part: part.where("lsn % 5 = 0")

    def run():
        stream = streams.dedup_stream(streams.read_change_stream(spark, f"{base}/in", schema=c.drop("arrived").schema), state.CHANGE_IDENTITY, "event_ts", "40 days")
        streams.foreach_batch_sink(stream, lambda batch, n: batch.write.mode("overwrite").parquet(f"{base}/out/batch={n}"), f"{base}/ck", f"dedup_{abs(hash(base))}").awaitTermination()

    fed([one, two.unionAll(again(one)), three.unionAll(again(two)), again(three)], f"{base}/in", run)
    return spark.read.parquet(f"{base}/out").select("source_table", "pk", "lsn", "op")


@query("late_report", """SELECT count(*) AS sent, count(*) FILTER (WHERE event_ts <= newest - INTERVAL '2' DAY) AS kept, count(*) FILTER (WHERE event_ts <= newest - INTERVAL '2' DAY) AS dropped, TRUE AS is_consistent
  FROM (SELECT CASE WHEN offset_no % 50 = 0 THEN event_ts - INTERVAL '9' DAY ELSE event_ts END AS event_ts, least(CAST(day(event_ts) - 1 AS BIGINT) // 10, 2) AS part FROM pings) AS p
  LEFT JOIN (SELECT part + 1 AS after, max(max(event_ts)) OVER (ORDER BY part) AS newest FROM (SELECT CASE WHEN offset_no % 50 = 0 THEN event_ts - INTERVAL '9' DAY ELSE event_ts END AS event_ts, least(CAST(day(event_ts) - 1 AS BIGINT) // 10, 2) AS part FROM pings) AS q GROUP BY part) AS n
  ON part = after""")
def _(spark, sf):
    """Late pings that are kept against what the engine drops: of the stream that de-duplicates pings,
    rows that come in and go out are observed, and the engine tells what it dropped."""
    base = tables.scratch_dir(spark)
    p = pings(spark, sf).select("topic", "partition", "offset", F.col("event_ts").alias("arrived"), F.when(F.col("offset") % 50 == 0, F.col("event_ts") - F.expr("INTERVAL 9 DAYS")).otherwise(F.col("event_ts")).alias("event_ts"))
    schema, name = p.drop("arrived").schema, f"dropped_{abs(hash(base))}"
    keeper = streams.LateRows(spark, f"{base}/late", "2 days")

    def run():
        read = lambda: streams.read_ping_stream(spark, f"{base}/pings", schema=schema)
        streams.foreach_batch_sink(read(), keeper.write, f"{base}/late_ck", f"late_{abs(hash(base))}").awaitTermination()
        once = streams.dedup_stream(read().observe("sent", F.count(F.lit(1)).alias("n")), state.PING_IDENTITY, "event_ts", "2 days").observe("passed", F.count(F.lit(1)).alias("n"))
        streams.foreach_batch_sink(once, lambda batch, n: batch.write.mode("overwrite").parquet(f"{base}/out/batch={n}"), f"{base}/ck", name).awaitTermination()

    with streams.progress_of(spark) as told:
        fed(_thirds(p), f"{base}/pings", run)
    sent, passed, dropped = (sum(f(b) for b in told.batches if b.query == name) for f in (lambda b: b.observed["sent"]["n"], lambda b: b.observed["passed"]["n"], lambda b: b.dropped))
    kept = keeper.read(schema).agg(F.count(F.lit(1)).alias("kept"))
    return kept.select(F.lit(sent).cast("long").alias("sent"), "kept", F.lit(dropped).cast("long").alias("dropped"), F.lit(sent == passed + dropped).alias("is_consistent"))


@query("continuous_run", "SELECT DISTINCT source_table, pk, lsn, op FROM changes")
def _(spark, sf):
    """A query that stays up: fed while it runs, stopped in between, started again from its
    checkpoint; changes are merged into a stored table as they come."""
    base = tables.scratch_dir(spark)
    c = given(spark, sf, "changes").select("source_table", "pk", "lsn", "op")
    table = keyed.KeyedTable(spark, f"{base}/table", state.CHANGE_IDENTITY)
    merge = lambda old, new: state.dedup_changes(new) if old is None else state.merge_insert_only(old, new, state.CHANGE_IDENTITY)
    part = lambda i: c.where(F.pmod(F.xxhash64("lsn"), F.lit(3)) == i)

    def start(n: int):
        stream = streams.read_change_stream(spark, f"{base}/in", schema=c.schema)
        return streams.foreach_batch_sink(stream, table.merging(merge), f"{base}/ck", f"running_{n}_{abs(hash(base))}", once=False, every="1 second")

    streams.land(part(0), f"{base}/in", 1_000_000)
    query = start(1)
    try:
        streams.land(part(1), f"{base}/in", 1_000_000)
        query.processAllAvailable()
    finally:
        query.stop()
    streams.land(part(2), f"{base}/in", 1_000_000)
    query = start(2)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return table.read().select("source_table", "pk", "lsn", "op")


@query("scd2_specs", "SELECT 'restaurant' AS which, count(*) AS versions, count(DISTINCT restaurant_id) AS keys FROM versions_restaurant UNION ALL SELECT 'rider', count(*), count(DISTINCT rider_id) FROM versions_rider UNION ALL SELECT 'menu', count(*), count(DISTINCT menu_item_id) FROM versions_menu",
       tuple(f"{a}_{w}" for w in DIMS for a in ("parsed", "versions")))
def _(spark, sf):
    each = [versions(spark, sf, w).agg(F.lit(w).alias("which"), F.count(F.lit(1)).alias("versions"), F.count_distinct(e.key).alias("keys")) for w, (e, _) in DIMS.items()]
    return reduce(DataFrame.union, each).select("which", "versions", "keys")


FLAGSHIP = QUERIES["agg_sla_daily"]

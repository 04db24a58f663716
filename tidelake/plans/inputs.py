"""The delivery marketplace's inputs, derived from the tables at hand.

Each input is one SQL text that Spark and DuckDB both run: the queries start from it in
Spark, their checks in DuckDB.  Sizes follow the tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

_CHANGE = """
SELECT CASE WHEN user_id % 2 = 0 THEN 'orders' ELSE 'riders' END AS source_table, user_id AS pk, event_id AS lsn,
       CASE WHEN event_type = 'error' THEN 'd' ELSE 'u' END AS op, event_type AS status, value AS amount, ts AS event_ts,
       CAST(user_id % 3 AS INT) AS part_no, event_id * 2 + {copy} AS offset_no
FROM events"""

_LINE_TIME = "l_shipdate + (l_orderkey % 1440) * INTERVAL '1' MINUTE + (l_partkey % 60) * INTERVAL '1' SECOND"

_SQL = {
    # changes of two tables, one in seven delivered twice
    "changes": _CHANGE.format(copy=0) + "\nUNION ALL" + _CHANGE.format(copy=1) + " WHERE event_id % 7 = 0",
    "pings": """
SELECT user_id AS rider_id, concat('t', {k}) AS trip_id, CAST(event_id % 1000 AS DOUBLE) / 10000 + 12.9e0 AS lat,
       CAST(event_id % 777 AS DOUBLE) / 10000 + 77.5e0 AS lon, value AS speed_kmph, CAST(event_id % 365 AS DOUBLE) AS heading_deg,
       5.0e0 AS accuracy_m, ts AS event_ts, 'pings' AS topic, CAST(user_id % 3 AS INT) AS part_no, event_id AS offset_no
FROM events""",
    "order_base": """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_custkey % 100 AS restaurant_id,
       CASE WHEN o_orderkey % 41 <> 0 THEN o_orderkey % 100 END AS some_rider,
       CASE o_orderstatus WHEN 'F' THEN 4 WHEN 'P' THEN 3 ELSE 1 + o_orderkey % 2 END AS depth,
       o_orderstatus = 'O' AND o_orderkey % 11 = 0 AS cancelled,
       o_orderdate + (o_orderkey % 1440) * INTERVAL '1' MINUTE AS placed,
       60 + o_orderkey % 300 AS accept_s, 480 + o_orderkey % 900 AS prep_s, 300 + o_custkey % 2400 AS transit_s, 1500 + (o_orderkey % 7) * 300 AS promise_s,
       CAST(CAST(floor(o_totalprice) AS DECIMAL(12,0)) * 0.01 AS DECIMAL(10,2)) AS subtotal,
       CAST(o_orderkey % 60 AS DECIMAL(10,2)) AS fee, CAST(o_custkey % 25 AS DECIMAL(10,2)) AS discount
FROM orders""",
    "order_changes": """
SELECT order_id, customer_id, restaurant_id, CASE WHEN n >= 2 THEN some_rider END AS rider_id,
       CASE WHEN cancelled AND n = depth - 1 THEN 'CANCELLED' WHEN n = 0 THEN 'PLACED' WHEN n = 1 THEN 'ACCEPTED' WHEN n = 2 THEN 'PICKED_UP' ELSE 'DELIVERED' END AS status,
       placed AS placed_ts,
       CASE WHEN n >= 1 THEN placed + accept_s * INTERVAL '1' SECOND END AS accepted_ts,
       CASE WHEN n >= 2 THEN placed + (accept_s + prep_s) * INTERVAL '1' SECOND END AS picked_up_ts,
       CASE WHEN n >= 3 THEN placed + (accept_s + prep_s + transit_s) * INTERVAL '1' SECOND END AS delivered_ts,
       placed + promise_s * INTERVAL '1' SECOND AS promised_ts,
       CASE WHEN cancelled AND n = depth - 1 THEN 'CUSTOMER_CANCELLED' END AS cancel_reason,
       subtotal AS subtotal_inr, fee AS delivery_fee_inr, discount AS discount_inr,
       CAST(subtotal + fee - discount + CASE WHEN order_id % 500 = 0 THEN 1 ELSE 0 END AS DECIMAL(10,2)) AS total_inr,
       step >= depth AS is_deleted, CASE WHEN step >= depth THEN 'd' WHEN step = 0 THEN 'c' ELSE 'u' END AS op, order_id * 8 + step AS lsn,
       placed + (step * 600) * INTERVAL '1' SECOND AS updated_at
FROM (SELECT *, CASE WHEN step >= depth THEN depth - 1 ELSE step END AS n
      FROM (SELECT *, {each: depth - 1 + CASE WHEN order_id % 97 = 0 THEN 1 ELSE 0 END} AS step FROM order_base) AS stepped) AS reached""",
    "restaurant_changes": f"""
SELECT l_suppkey AS restaurant_id, s_name AS name, n_name AS city, CAST(s_nationkey + 10 AS DECIMAL(9,6)) AS lat, CAST(l_suppkey % 90 AS DECIMAL(9,6)) AS lon,
       CASE l_suppkey % 3 WHEN 0 THEN 'THAI' WHEN 1 THEN 'INDIAN' ELSE 'CAFE' END AS cuisine,
       CAST(CAST(floor(l_tax * 100 + 0.5) AS DECIMAL(3,0)) * 0.5 AS DECIMAL(2,1)) AS rating, CAST(floor(l_discount * 100 + 0.5) AS DECIMAL(5,2)) AS commission_pct,
       l_returnflag <> 'R' AS is_open, {_LINE_TIME} AS updated_at, CASE WHEN l_orderkey % 101 = 0 THEN 'd' ELSE 'u' END AS op,
       {{epoch: {_LINE_TIME}}} * 1000000 + (l_orderkey % 1000) * 1000 + l_partkey % 1000 AS lsn
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE l_linenumber = 1""",
    "rider_changes": f"""
SELECT l_partkey % 100 AS rider_id, concat('Rider ', l_partkey % 100) AS name, concat('NATION_', l_partkey % 25) AS city,
       CASE WHEN l_linestatus = 'O' THEN 'SCOOTER' ELSE 'BIKE' END AS vehicle_type, CASE l_returnflag WHEN 'A' THEN 'GOLD' WHEN 'N' THEN 'SILVER' ELSE 'BRONZE' END AS tier,
       '09:00' AS shift_start, l_quantity > 25 AS is_online, {_LINE_TIME} AS updated_at, 'u' AS op,
       {{epoch: {_LINE_TIME}}} * 1000000 + (l_orderkey % 1000) * 1000 + l_partkey % 1000 AS lsn
FROM lineitem WHERE l_linenumber = 2""",
    "menu_changes": f"""
SELECT l_partkey AS menu_item_id, l_partkey % 100 AS restaurant_id, p_name AS name, CAST(floor(l_extendedprice / l_quantity / 100) AS DECIMAL(10,2)) AS price_inr,
       l_discount < 0.09 AS is_available, {_LINE_TIME} AS updated_at, CASE WHEN l_orderkey % 211 = 0 THEN 'd' ELSE 'u' END AS op,
       {{epoch: {_LINE_TIME}}} * 1000000 + (l_orderkey % 1000) * 1000 + l_suppkey % 1000 AS lsn
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linenumber >= 3""",
    "item_changes": """
SELECT ((l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey) * 10000 + l_suppkey AS order_item_id, l_orderkey AS order_id, l_partkey AS menu_item_id,
       CAST(l_quantity AS INT) AS qty, CAST(floor(l_extendedprice / l_quantity / 100) AS DECIMAL(10,2)) AS unit_price_inr, l_shipdate AS updated_at,
       step = 1 AS is_deleted, CASE WHEN step = 1 THEN 'd' ELSE 'c' END AS op, l_orderkey * 2 + step AS lsn
FROM (SELECT *, {each: CASE WHEN l_orderkey % 89 = 0 THEN 1 ELSE 0 END} AS step FROM lineitem) AS stepped""",
    "customer_changes": """
SELECT c_custkey AS customer_id, c_name AS name, concat('+91-', c_custkey) AS phone, n_name AS city,
       TIMESTAMP '1994-01-01 00:00:00' + (c_custkey % 700) * INTERVAL '1' DAY AS signup_ts,
       CASE WHEN step = 0 OR c_mktsegment = 'BUILDING' THEN 'STANDARD' WHEN c_mktsegment = 'MACHINERY' THEN 'PRO' ELSE 'PLUS' END AS tier, c_acctbal > 0 AS is_active,
       TIMESTAMP '1994-01-01 00:00:00' + (c_custkey % 700 + step * 30) * INTERVAL '1' DAY AS updated_at,
       step = 2 AS is_deleted, CASE WHEN step = 2 THEN 'd' WHEN step = 0 THEN 'c' ELSE 'u' END AS op, c_custkey * 4 + step AS lsn
FROM (SELECT *, {each: CASE WHEN c_custkey % 53 = 0 THEN 2 ELSE 1 END} AS step FROM customer) AS stepped JOIN nation ON c_nationkey = n_nationkey""",
    "payments": """
SELECT o_orderkey AS payment_id, o_orderkey AS order_id, CASE o_orderkey % 6 WHEN 0 THEN 'UPI' WHEN 1 THEN 'CARD' WHEN 2 THEN 'NETBANKING' WHEN 3 THEN 'COD' WHEN 4 THEN 'WALLET' ELSE 'CHEQUE' END AS method,
       CASE o_orderstatus WHEN 'F' THEN 'CAPTURED' WHEN 'P' THEN 'AUTHORISED' ELSE 'PENDING' END AS status,
       CAST(floor(o_totalprice / 100) - CASE WHEN o_orderkey % 50 = 0 THEN 10000 ELSE 0 END AS DECIMAL(10,2)) AS amount_inr, o_orderkey AS lsn
FROM orders""",
    "weather": """
SELECT n_name AS city, CAST(o_orderdate AS DATE) AS weather_date,
       CASE WHEN (n_nationkey + {epoch: o_orderdate} / 86400) % 23 = 0 THEN NULL ELSE CAST(CAST(floor(n_nationkey * 3 + {epoch: o_orderdate} / 86400 * 7) AS BIGINT) % 25 AS DOUBLE) * 0.5e0 END AS precipitation_mm,
       30.5e0 AS temp_max_c, CAST(n_nationkey AS DOUBLE) AS temp_min_c
FROM (SELECT DISTINCT o_orderdate FROM orders) AS days CROSS JOIN nation""",
    "api_holidays": """
SELECT DISTINCT CAST(o_orderdate AS DATE) AS holiday_date, CASE WHEN day(o_orderdate) = 1 THEN 'First' ELSE 'Fifteenth' END AS holiday_name, 'IN' AS country_code
FROM orders WHERE day(o_orderdate) IN (1, 15) AND month(o_orderdate) % 3 = 0""",
}


def _dialect(text: str, spark: bool) -> str:
    """Fills in what the two engines write differently."""
    text = text.replace("{k}", "get_json_object(props, '$.k')" if spark else "json_extract_string(props, '$.k')")
    text = re.sub(r"\{each: (.*?)\}", r"explode(sequence(0, CAST(\1 AS INT)))" if spark else r"unnest(range(0, CAST(\1 AS INT) + 1))", text)
    return re.sub(r"\{epoch: (.*?)\}", r"unix_seconds(CAST(\1 AS TIMESTAMP))" if spark else r"CAST(epoch(\1) AS BIGINT)", text)


def _needed(text: str) -> list[str]:
    """Inputs a text refers to, each after those it needs itself."""
    out: list[str] = []
    for name in _SQL:
        if text != _SQL[name] and re.search(rf"\b{name}\b", text):
            out += [n for n in [*_needed(_SQL[name]), name] if n not in out]
    return out


def with_inputs(text: str, spark: bool = False, more: dict[str, str] | None = None) -> str:
    """A query over inputs (and ``more``, named queries over them) with all it needs before it."""
    more = more or {}
    everything = " ".join([text, *more.values()])
    parts = [f"{n} AS ({_dialect(_SQL[n], spark)})" for n in _needed(everything)] + [f"{n} AS ({t})" for n, t in more.items()]
    return f"WITH {', '.join(parts)}\n{text}" if parts else text


#: Tables that inputs many times as wide are derived from, and what their rows are dealt by.
_DEALT_BY = {"customer": ("c_custkey",), "orders": ("o_orderkey",), "lineitem": ("l_orderkey", "l_partkey")}


def register(spark: SparkSession, sf_dir: str, deal: bool = False) -> None:
    """Names the tables for SQL.  deal: a table that comes as fewer splits than there are cores is
    dealt over all of them first, as what is derived from a split stays one task's, and is many times wider."""
    cores = spark.sparkContext.defaultParallelism
    for t in TABLES:
        rows = spark.read.parquet(f"{sf_dir}/{t}.parquet")
        if deal and t in _DEALT_BY and rows.rdd.getNumPartitions() < cores:
            rows = rows.repartition(cores, *_DEALT_BY[t])
        rows.createOrReplaceTempView(t)


def given(spark: SparkSession, sf_dir: str, name: str, deal: bool = False) -> DataFrame:
    """An input in Spark, times as timestamps."""
    register(spark, sf_dir, deal)
    df = spark.sql(with_inputs(f"SELECT * FROM {name}", spark=True))
    return df.select(*[F.col(c).cast("timestamp").alias(c) if t == "timestamp_ntz" else F.col(c) for c, t in df.dtypes])


def iso(ts) -> F.Column:
    """A timestamp as the sources write it."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def payload(df: DataFrame, fields: list[str]) -> F.Column:
    """A row image as a struct: only the entity's fields, times as texts."""
    types = dict(df.dtypes)
    return F.struct(*[(iso(F.col(c)) if types[c] == "timestamp" else F.col(c)).alias(c) for c in fields if c in types])


def as_bronze(df: DataFrame, fields: list[str], key: str | None = None) -> DataFrame:
    """Typed change rows as the change log's rows: op, lsn, event_ts_ms, images as VARIANT; and, if ``key`` is given, that as pk."""
    row = F.to_variant_object(payload(df, fields))
    gone = F.col("op") == "d"
    pk = [F.col(key).alias("pk")] if key else []
    return df.select(*pk, "op", "lsn", F.unix_millis("updated_at").alias("event_ts_ms"), F.when(gone, row).alias("before"), F.when(~gone, row).alias("after"))


#: Shape of the envelopes that ``messages`` writes for ``changes``.
ENVELOPE = (
    "before struct<order_id: bigint, status: string, amount: double>, after struct<order_id: bigint, status: string, amount: double>,"
    " source struct<lsn: bigint>, op string, ts_ms bigint"
)


def messages(changes: DataFrame) -> DataFrame:
    """``changes`` as raw messages: a 5-byte header and the envelope as JSON; one in 97 a
    tombstone, one in 89 garbage."""
    image = F.struct(F.col("pk").alias("order_id"), "status", "amount")
    gone = F.col("op") == "d"
    envelope = F.struct(
        F.when(gone, image).alias("before"), F.when(~gone, image).alias("after"), F.struct("lsn").alias("source"), "op", F.unix_millis("event_ts").alias("ts_ms")
    )
    header = F.unhex(F.lit("0000000007"))
    value = F.concat(header, F.to_json(envelope).cast("binary"))
    broken = F.concat(header, F.lit("{broken").cast("binary"))
    return changes.select(
        F.concat(F.lit("cdc."), F.col("source_table")).alias("topic"), F.col("part_no").alias("partition"), F.col("offset_no").alias("offset"), F.col("event_ts").alias("timestamp"),
        F.when(F.col("lsn") % 97 == 0, F.lit(None).cast("binary")).when(F.col("lsn") % 89 == 0, broken).otherwise(value).alias("value"),
    )

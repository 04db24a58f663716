"""Trips from position pings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.functions.geo import bearing_deg, haversine_km

TRIP_KEY = ("rider_id", "trip_id")


def trips(pings: DataFrame) -> DataFrame:
    """One row for each rider and trip: ends by event time, counts, speeds, straight distance."""
    ends = pings.groupBy(*TRIP_KEY).agg(
        F.min("event_ts").alias("started_ts"),
        F.max("event_ts").alias("ended_ts"),
        F.count(F.lit(1)).alias("ping_count"),
        F.avg("speed_kmph").alias("avg_speed_kmph"),
        F.max("speed_kmph").alias("max_speed_kmph"),
        F.min_by(F.struct("lat", "lon"), F.struct("event_ts", "lat", "lon")).alias("first"),
        F.max_by(F.struct("lat", "lon"), F.struct("event_ts", "lat", "lon")).alias("last"),
    )
    return ends.select(
        *TRIP_KEY, "started_ts", "ended_ts",
        seconds_between(F.col("started_ts"), F.col("ended_ts")).alias("duration_s"),
        "ping_count", "avg_speed_kmph", "max_speed_kmph",
        F.col("first.lat").alias("start_lat"), F.col("first.lon").alias("start_lon"),
        F.col("last.lat").alias("end_lat"), F.col("last.lon").alias("end_lon"),
        haversine_km(F.col("first.lat"), F.col("first.lon"), F.col("last.lat"), F.col("last.lon")).alias("straight_line_km"),
        F.to_date("started_ts").alias("trip_date"),
    )


def seconds_between(a: Column, b: Column) -> Column:
    """Seconds from a to b, fractions included."""
    return F.timestamp_diff("MICROSECOND", a, b) / F.lit(1_000_000.0)


def late_pings(pings: DataFrame, tolerance: str = "15 minutes", order: str = "offset", block: int = 1_000_000) -> DataFrame:
    """Pings that arrived after a ping of their partition that was more than the tolerance newer.

    The newest time so far runs inside blocks of offsets; what the blocks before have seen
    comes from one row for each block, so no partition of the log is one task's work.
    """
    log = ["topic", "partition"]
    keyed = pings.withColumn("__block", F.floor(F.col(order) / block))
    earlier = Window.partitionBy(*log).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    tops = keyed.groupBy(*log, "__block").agg(F.max("event_ts").alias("__top")).withColumn("__earlier", F.max("__top").over(earlier)).drop("__top")
    own = Window.partitionBy(*log, "__block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    newest = F.greatest(F.max("event_ts").over(own), F.col("__earlier"))
    seen = keyed.join(tops, [*log, "__block"]).withColumn("newest_before", newest).drop("__block", "__earlier")
    return seen.where(F.col("event_ts") < F.col("newest_before") - F.expr(f"INTERVAL {tolerance}"))


def trip_legs(pings: DataFrame) -> DataFrame:
    """Each ping with distance and bearing from the ping before it in its trip."""
    order = Window.partitionBy(*TRIP_KEY).orderBy("event_ts", "lat", "lon")
    lat, lon = F.lag("lat").over(order), F.lag("lon").over(order)
    return pings.withColumn("leg_km", haversine_km(lat, lon, F.col("lat"), F.col("lon"))).withColumn("heading", bearing_deg(lat, lon, F.col("lat"), F.col("lon")))

"""Checks of whole tables: freshness, coverage, checksums, reconciliation."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidelake.sources.tables import without_day


def freshness(rows: DataFrame, column: str, now: Column | None = None, limit_hours: float = 24.0) -> DataFrame:
    """One row: newest, hours_old, status: fresh, stale (older than the limit) or error (no row has a time)."""
    if column not in rows.columns:
        raise ValueError(f"there is no column {column}")
    newest = rows.agg(F.max(column).alias("newest"))
    hours = F.timestamp_diff("SECOND", F.col("newest"), F.current_timestamp() if now is None else now) / F.lit(3600.0)
    status = F.when(F.col("newest").isNull(), "error").when(F.col("hours_old") > limit_hours, "stale").otherwise("fresh")
    return newest.withColumn("hours_old", hours).withColumn("status", status)


def coverage(rows: DataFrame, group: str, expected: DataFrame, value: str, min_rows: int) -> DataFrame:
    """(group, n, is_covered) for every expected group in one job; an absent one counts 0."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    out = expected.select(group).distinct().join(counts, group, "left")
    return out.select(group, F.coalesce("n", F.lit(0)).alias("n"), (F.coalesce("n", F.lit(0)) >= min_rows).alias("is_covered"))


def content_checksum(rows: DataFrame) -> DataFrame:
    """(row_count, content_hash): the sum of the rows' CRC-32, so the order does not matter.
    No rows: 0 and 0."""
    whole = F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"})
    return rows.agg(F.count(F.lit(1)).alias("row_count"), F.coalesce(F.sum(F.crc32(whole.cast("binary"))), F.lit(0)).alias("content_hash"))


def day_checksum(rows: DataFrame, day_column: str, day: dt.date) -> DataFrame:
    return content_checksum(rows.where(F.col(day_column) == F.lit(day)))


def prove_backfill(table: DataFrame, rebuild: Callable[[dt.date], DataFrame], day_column: str, day: dt.date) -> DataFrame:
    """One row: checksums of a day before, after deleting and after rebuilding it, and whether
    the rebuilt day equals the old one."""
    without = without_day(table, day_column, day)
    rebuilt = without.unionByName(rebuild(day).where(F.col(day_column) == F.lit(day)))
    parts = [day_checksum(x, day_column, day).select(F.col("row_count").alias(f"{n}_rows"), F.col("content_hash").alias(f"{n}_hash")) for n, x in (("before", table), ("deleted", without), ("after", rebuilt))]
    row = parts[0].join(parts[1]).join(parts[2])  # one row each
    return row.withColumn("is_equal", (F.col("before_rows") == F.col("after_rows")) & (F.col("before_hash") == F.col("after_hash")))


def observed_kinds(batch: DataFrame, kind: Column, name: str = "kinds") -> tuple[DataFrame, Observation]:
    """A batch whose messages are counted by kind as it is read for something else."""
    told = Observation(name)
    counts = [F.count_if(kind == k).alias(c) for k, c in (("tombstone", "tombstones"), ("undecodable", "quarantined"))]
    return batch.observe(told, F.count(F.lit(1)).alias("messages"), *counts), told


def reconcile_counts(sent: DataFrame | Observation, landed: DataFrame, identity: Sequence[str]) -> DataFrame:
    """One row: messages by kind, rows landed, different identities, and whether they add up.
    sent: what ``observed_kinds`` has counted (the batch is read already), or rows with a column kind."""
    if isinstance(sent, Observation):
        names = ("messages", "tombstones", "quarantined")
        sent = landed.sparkSession.createDataFrame([tuple(sent.get[n] for n in names)], ", ".join(f"{n} long" for n in names))
    else:
        sent = sent.agg(
            F.count(F.lit(1)).alias("messages"), F.count_if(F.col("kind") == "tombstone").alias("tombstones"), F.count_if(F.col("kind") == "undecodable").alias("quarantined")
        )
    got = landed.agg(F.count(F.lit(1)).alias("landed"), F.count_distinct(*identity).alias("identities"))
    adds = F.col("messages") >= F.col("landed") + F.col("tombstones") + F.col("quarantined")
    return sent.join(got).withColumn("redelivered", F.col("messages") - F.col("landed") - F.col("tombstones") - F.col("quarantined")).withColumn("is_consistent", adds & (F.col("landed") == F.col("identities")))


def null_rate_check(rows: DataFrame, day: Column, columns: Sequence[str], limit: float) -> DataFrame:
    """(day, column_name, null_rate) where more than ``limit`` of a day's values are null."""
    rates = rows.groupBy(day.alias("day")).agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rate")) for c in columns])).alias("x")
    return rates.select("day", each).select("day", "x.*").where(F.col("null_rate") > limit)

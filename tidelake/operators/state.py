"""De-duplication, latest state and merges, all as DataFrame to DataFrame functions.

A merge returns the new content of its target.  Merges join on the target's key only and
never gather a key's rows, so they shuffle each side once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHANGE_IDENTITY = ("source_table", "pk", "lsn")
PING_IDENTITY = ("topic", "partition", "offset")


def dedup_changes(changes: DataFrame, identity: Sequence[str] = CHANGE_IDENTITY) -> DataFrame:
    """One row for each change; the same log position of another key is another change."""
    return changes.dropDuplicates(list(identity))


def dedup_pings(pings: DataFrame, identity: Sequence[str] = PING_IDENTITY) -> DataFrame:
    return pings.dropDuplicates(list(identity))


def latest_state(changes: DataFrame, keys: Sequence[str], order: str = "lsn") -> DataFrame:
    """The newest change of each key by log position; a delete may be the newest."""
    newest = Window.partitionBy(*keys).orderBy(F.desc(order))
    ranked = changes.dropna(subset=list(keys)).withColumn("__n", F.row_number().over(newest))
    return ranked.where("__n = 1").drop("__n")


def state_as_of(changes: DataFrame, keys: Sequence[str], upto: Column, order: str = "lsn") -> DataFrame:
    """Latest state as it was when the log had reached ``upto``."""
    return latest_state(changes.where(F.col(order) <= upto), keys, order)


def merge_insert_only(target: DataFrame, source: DataFrame, identity: Sequence[str]) -> DataFrame:
    """Target and those source rows whose identity it lacks: a replay adds nothing."""
    return target.unionByName(new_rows(target, source, identity))


def new_rows(target: DataFrame, source: DataFrame, identity: Sequence[str]) -> DataFrame:
    """What ``merge_insert_only`` appends."""
    return source.dropDuplicates(list(identity)).join(target.select(*identity), list(identity), "left_anti")


def merge_latest_guarded(target: DataFrame, source: DataFrame, keys: Sequence[str], order: str = "lsn") -> DataFrame:
    """Upsert that never moves a key back: the source wins only with a later log position."""
    columns = target.columns
    new = latest_state(source, keys, order).select(*keys, F.struct(*columns).alias("__s"))
    both = target.select(*keys, F.struct(*columns).alias("__t")).join(new, list(keys), "full_outer")
    later = F.col("__t").isNull() | (F.col(f"__s.{order}") > F.col(f"__t.{order}"))
    return both.select(F.when(later, F.col("__s")).otherwise(F.col("__t")).alias("r")).select("r.*")


def merge_restate(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert that replaces: running it again gives the same."""
    return target.join(source.select(*keys), list(keys), "left_anti").unionByName(source)

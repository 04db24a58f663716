"""Slowly changing dimensions of type 2: half-open validity windows from a change log."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from tidelake.sources.tables import stored

#: Where the first window of a key is opened back to (fixed value).
BEGINNING = "1900-01-01"


def timeline(changes: DataFrame, key: str | list[str], open_rows: DataFrame | None = None) -> DataFrame:
    """Each key's open row, if it has one, followed by the versions that its changes make.

    Both stand in one sequence by log position, the open row behind a change at its own
    position.  What stands before an open row is known already and goes; so does a change
    that repeats the attributes before it.  What is left is chained: each row's window ends
    where the next begins, which also closes the open row.  ``stored`` tells the open row.

    key: what rows of one sequence share, beside the key itself also what it determines, such as the
    ``bucket`` that rows are dealt by already: then nothing is shuffled.
    """
    # attr_hash: changes that share a position have one order, whichever came first
    order = Window.partitionBy(key).orderBy("lsn", "attr_hash")
    same = F.coalesce(F.lag("attr_hash").over(order) == F.col("attr_hash"), F.lit(False))
    if open_rows is None:
        # nothing is known already, so no row has to know of an open one
        rows = changes.withColumn("__same", same).where("not __same").withColumn("stored", F.lit(False))
    else:
        rows = changes.withColumn("stored", F.lit(False)).unionByName(open_rows.withColumn("stored", F.lit(True)), allowMissingColumns=True)
        order = Window.partitionBy(key).orderBy("lsn", "stored", "attr_hash")
        same = F.coalesce(F.lag("attr_hash").over(order) == F.col("attr_hash"), F.lit(False))
        upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rows = rows.withColumns({"__any": F.max("stored").over(Window.partitionBy(key)), "__seen": F.max("stored").over(upto), "__same": same})
        rows = rows.where(F.col("stored") | (F.col("__seen") == F.col("__any")) & ~F.col("__same"))
    end = F.lead("valid_from").over(order)
    return rows.drop("__any", "__seen", "__same").withColumns({"valid_to": end, "is_current": end.isNull()})


def scd2_versions(changes: DataFrame, key: str | list[str], open_rows: DataFrame | None = None) -> DataFrame:
    """New versions from parsed changes (key, lsn, valid_from, attr_hash, ...), given the open
    row of each key so far: (key, lsn, valid_from, attr_hash) at least."""
    return timeline(changes, key, open_rows).where("not stored").drop("stored")


def scd2_stage(versions: DataFrame, key: str) -> DataFrame:
    """Input of a MERGE that can only touch a row once: every version is there to be inserted
    (merge_key null), each key's first also to close the open row (merge_key = key)."""
    first = F.col("lsn") == F.min("lsn").over(Window.partitionBy(key))
    nothing = F.lit(None).cast(versions.schema[key].dataType)
    parts = F.when(first, F.array(F.col(key), nothing)).otherwise(F.array(nothing))
    return versions.withColumn("__parts", parts).select(*versions.columns, F.explode("__parts").alias("merge_key"))


def merge_scd2(target: DataFrame, staged: DataFrame, key: str) -> DataFrame:
    """Target with the open rows of staged keys closed where their successor begins, and all
    staged versions added.  Only open rows are shuffled; closed ones pass by."""
    ends = staged.where("merge_key is not null").select(F.col("merge_key").alias(key), F.col("valid_from").alias("__end"))
    is_open = F.coalesce("is_current", F.lit(False))
    held = target.where(is_open).join(ends, key, "left").withColumns({"valid_to": F.coalesce("__end", "valid_to"), "is_current": F.col("__end").isNull()})
    parts = (target.where(~is_open), held, staged.where("merge_key is null"))
    return reduce(DataFrame.unionByName, [x.select(*target.columns) for x in parts])


def apply_changes(target: DataFrame | None, changes: DataFrame, key: str) -> DataFrame:
    """One batch of parsed changes applied to a dimension (none yet: None): closed rows stay,
    open ones go through the timeline with the changes.  Batches must come in log order: a change
    before a key's open row is taken for a delivery of what is known already (``ChangeLog`` takes any order)."""
    if target is None:
        return scd2_versions(changes, key)
    is_open = F.coalesce("is_current", F.lit(False))
    return target.where(~is_open).unionByName(timeline(changes, key, target.where(is_open)).select(*target.columns))


def scd2_effective_from(versions: DataFrame, key: str) -> DataFrame:
    """Adds effective_from: the key's first window is opened back, so that facts older than
    the first captured version still find it."""
    first = F.row_number().over(Window.partitionBy(key).orderBy("valid_from")) == 1
    begin = F.lit(BEGINNING).cast(versions.schema["valid_from"].dataType)
    return versions.withColumn("effective_from", F.when(first, begin).otherwise(F.col("valid_from")))


def in_force(at: Column, effective_from: Column, valid_to: Column) -> Column:
    """Whether a window holds at a time: its begin counts, its end does not."""
    return (at >= effective_from) & (valid_to.isNull() | (at < valid_to))


def scd2_as_of_join(facts: DataFrame, versions: DataFrame, key: str, at: str, columns: dict[str, str], fact_key: str | None = None, row_key: Sequence[str] = ()) -> DataFrame:
    """Facts with ``columns`` (version column: output name) of the version in force at ``at``;
    null where there is none.  The windows of a key must not overlap.

    Only key and time of the facts, and ``row_key`` if the facts have one that no two rows share
    (else each different key and time once), go into a sequence with the versions, dealt in ranges
    of (key, time): a key of any size is as many tasks as its rows take, and no pair of a fact and
    a version is formed.  In a range a fact's version is the last before it; what the ranges before
    have to add is one row for each range (``_carried``).  Facts without key or time find nothing
    and pass by.  The answers meet the facts by ``row_key``, by which these may be dealt already.
    """
    found = F.struct(F.col("valid_to").alias("to"), *[F.col(c).alias(n) for c, n in columns.items()])
    # of versions that begin together the one that lasts is the last
    last = F.coalesce(F.col("valid_to"), F.lit("9999-12-31").cast(versions.schema["valid_to"].dataType))
    side = versions.where(F.col(key).isNotNull()).select(F.col(key).alias("__k"), F.col("effective_from").alias("__t"), F.lit(0).alias("__kind"), last.alias("__end"), found.alias("__v"))
    asked = facts.select(F.col(fact_key or key).alias("__k"), F.col(at).alias("__t"), *row_key).where("__k is not null and __t is not null")
    asked = (asked if row_key else asked.distinct()).withColumn("__kind", F.lit(1))
    told = _last_before(asked.unionByName(side, allowMissingColumns=True), row_key)
    holds = F.col("__v.to").isNull() | (F.col("__t") < F.col("__v.to"))
    told = told.select(*(row_key or [F.col("__k"), F.col("__t")]), *[F.when(holds, F.col("__v").getField(n)).alias(n) for n in columns.values()])
    if row_key:
        return facts.join(told, list(row_key), "left").select(*facts.columns, *columns.values())
    return facts.join(told, (F.col(fact_key or key) == F.col("__k")) & (F.col(at) == F.col("__t")), "left").select(*facts.columns, *columns.values())


def scd2_as_of_dealt(facts: DataFrame, versions: DataFrame, key: str, at: str, columns: dict[str, str], counted: DataFrame | None = None, fact_key: str | None = None, most: int | None = None) -> DataFrame:
    """As ``scd2_as_of_join``, for facts of many keys: they travel whole, once, beside the versions, and
    nothing is written or joined again.

    Facts and versions are dealt by key and each fact takes the last version before it.  A key of more than
    ``most`` facts is cut by time into parts, each of which begins with the version the parts before leave; so it
    is as many tasks as its rows take.  Facts without key or time find nothing and lie wherever their hash falls.
    counted: a table of at least the facts' keys (``fact_key``), in which rows of a key are counted; the facts themselves if there is none.
    """
    fact_key, most = fact_key or key, most or RANGE_ROWS
    kinds = dict(facts.dtypes)
    found = F.struct(F.col("valid_to").alias("to"), *[F.col(c).alias(n) for c, n in columns.items()])
    # of versions that begin together the one that lasts is the last
    last = F.coalesce(F.col("valid_to"), F.lit("9999-12-31").cast(versions.schema["valid_to"].dataType))
    side = versions.where(F.col(key).isNotNull() & F.col("effective_from").isNotNull()).select(F.col(key).cast(kinds[fact_key]).alias(fact_key), F.col("effective_from").cast(kinds[at]).alias(at), last.alias("__end"), found.alias("__v"))
    nowhere = F.col(fact_key).isNull() | F.col(at).isNull()
    apart = -1 - F.pmod(F.xxhash64(*facts.columns), F.lit(1 << 20))

    large = (facts if counted is None else counted).where(F.col(fact_key).isNotNull()).groupBy(fact_key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).collect()
    if large:
        # few: so many rows stand behind each of them
        parts = -(-max(r.n for r in large) // most)
        keys = F.broadcast(facts.sparkSession.createDataFrame([(r[0],) for r in large], StructType([StructField(fact_key, facts.schema[fact_key].dataType)])))
        share = [i / parts for i in range(1, parts)]
        times = facts.where(~nowhere).select(fact_key, _as_micros(at).alias("__m")).join(keys, fact_key).groupBy(fact_key).agg(F.array_sort(F.array_distinct(F.percentile_approx("__m", share, 10_000))).alias("__cuts"))
        cuts = F.broadcast(stored(times))
        side = stored(side)
        place = F.when(nowhere, apart).otherwise(F.coalesce(F.size(F.filter("__cuts", lambda c: c <= _as_micros(at))), F.lit(0)).cast("long"))
        facts_in = facts.join(cuts, fact_key, "left").withColumn("__part", place).drop("__cuts")
        side = side.join(cuts, fact_key, "left").withColumn("__part", F.coalesce(F.size(F.filter("__cuts", lambda c: c <= _as_micros(at))), F.lit(0)).cast("long"))
        # each part of a key begins with the last version of the parts before: a row for each
        ends = side.where("__cuts is not null").groupBy(fact_key, "__cuts", "__part").agg(F.max_by(F.struct("__end", "__v"), F.struct(at, "__end")).alias("x"))
        ends = ends.groupBy(fact_key, "__cuts").agg(F.array_sort(F.collect_list(F.struct("__part", "x")), lambda x, y: (x["__part"] - y["__part"]).cast("int")).alias("e"))
        begin = F.transform(F.sequence(F.lit(1), F.size("__cuts")), lambda p: F.struct(p.cast("long").alias("__part"), F.try_element_at(F.filter("e", lambda y: y["__part"] < p), F.lit(-1))["x"].alias("x")))
        begun = ends.where(F.size("__cuts") > 0).select(fact_key, F.explode(begin).alias("b")).where("b.x is not null")
        begun = begun.select(fact_key, F.lit(None).cast(kinds[at]).alias(at), F.col("b.x.__end").alias("__end"), F.col("b.x.__v").alias("__v"), F.col("b.__part").alias("__part"))
        side = side.drop("__cuts").unionByName(begun)
    else:
        facts_in = facts.withColumn("__part", F.when(nowhere, apart).otherwise(F.lit(0)).cast("long"))
        side = side.withColumn("__part", F.lit(0).cast("long"))

    line = facts_in.withColumn("__kind", F.lit(1)).unionByName(side.withColumn("__kind", F.lit(0)), allowMissingColumns=True)
    upto = Window.partitionBy(fact_key, "__part").orderBy(F.asc_nulls_first(at), "__kind", "__end").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    told = line.withColumn("__v", F.last("__v", ignorenulls=True).over(upto)).where("__kind = 1")
    holds = F.col("__v.to").isNull() | (F.col(at) < F.col("__v.to"))
    return told.select(*facts.columns, *[F.when(holds, F.col("__v").getField(n)).alias(n) for n in columns.values()])


def _as_micros(at: str) -> Column:
    return F.unix_micros(F.col(at).cast("timestamp"))


#: Rows of a range of the sequence of facts and versions: so many meet in a task on average.
RANGE_ROWS = 500_000


def _last_before(rows: DataFrame, row_key: Sequence[str], range_rows: int = RANGE_ROWS) -> DataFrame:
    """The facts (__kind 1) of a sequence with the last __v before each, null where there is none.

    The sequence is written once, as cutting ranges reads it twice.  Every range is read once, in
    order, and written: its facts, and at its end a row with the range's first and last key and the
    version the last key has there (__kind 2).
    """
    rows = stored(rows)
    spark = rows.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // range_rows))
    order = ["__k", "__t", "__kind", "__end"]
    rows = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select(*order[:3], *row_key, "__v").withColumn("__range", F.spark_partition_id())
    kinds = {f.name: f.dataType for f in rows.schema}
    out = StructType([*rows.schema.fields, StructField("__first", kinds["__k"]), StructField("__open", BooleanType())])
    told = stored(rows.mapInArrow(_carry_on(), out))
    facts = told.where("__kind = 1").select(*order[:2], *row_key, "__v", "__range", "__open")

    # each range's first key takes what the ranges before have for that key: two rows for each range
    ends = told.where("__kind = 2")
    ends = ends.select(F.explode(F.array(*[F.struct(F.col(c).alias("__k"), "__range", F.lit(side).alias("side"), v.alias("__v")) for c, side, v in (("__first", 0, F.lit(None).cast(kinds["__v"])), ("__k", 1, F.col("__v")))])).alias("e")).select("e.*")
    before = Window.partitionBy("__k").orderBy("__range", "side").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("__carried", F.last("__v", ignorenulls=True).over(before)).where("side = 0").select("__range", "__carried")
    joined = facts.join(carried, "__range")
    return joined.withColumn("__v", F.when(F.col("__open"), F.col("__carried")).otherwise(F.col("__v"))).drop("__range", "__open", "__carried")


def _carry_on() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A scan that gives each fact of a sorted range the last version of its key before it; __open:
    there is none in this range, and its key is the range's first.  Built here, so that it travels to
    the workers whole and they need not have this package."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = held = None
        for b in batches:
            if not len(b):
                continue
            names = b.schema.names
            key, version = b.column("__k"), b.column("__v")
            if first is None:
                first, last, held = key.slice(0, 1), key.slice(0, 1), pa.nulls(1, version.type)
            at = np.arange(len(b))
            new = np.append(last[0] != key[0], pc.not_equal(key.slice(1), key.slice(0, len(b) - 1)).to_numpy(zero_copy_only=False))
            begin = np.maximum.accumulate(np.where(new, at, -1))
            latest = np.maximum.accumulate(np.where(b.column("__kind").to_numpy() == 0, at, -1))
            # place 0 of the pool is what the batch before has left, for the key it ended with
            take = np.where(latest >= np.maximum(begin, 0), latest + 1, np.where(begin < 0, 0, -1))
            pool = pa.concat_arrays([held, version])
            given = pool.take(pa.array(take, mask=take < 0))
            open_ = pc.and_(pc.is_null(given), pc.equal(key, first[0]))
            whole = pa.RecordBatch.from_arrays([*[given if n == "__v" else b.column(n) for n in names], key, open_], names=[*names, "__first", "__open"])
            yield whole.filter(pc.equal(b.column("__kind"), 1))
            last, held = key.slice(len(b) - 1), given.slice(len(b) - 1)
        if first is not None:
            one = {"__k": last, "__kind": pa.array([2], pa.int32()), "__v": held, "__range": b.column("__range").slice(0, 1), "__first": first, "__open": pa.array([False])}
            yield pa.RecordBatch.from_arrays([one.get(f.name, pa.nulls(1, f.type)) for f in whole.schema], names=whole.schema.names)

    return scan


def scd2_overlaps(versions: DataFrame, key: str) -> DataFrame:
    """Windows that reach into the next one of their key."""
    following = F.lead("valid_from").over(Window.partitionBy(key).orderBy("valid_from", "lsn"))
    rows = versions.withColumn("next_from", following)
    return rows.where(F.col("next_from").isNotNull() & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("next_from"))))


def scd2_orphaned_windows(versions: DataFrame, key: str) -> DataFrame:
    """Closed windows at whose end no other window of the key begins.

    Begins and ends meet by key and time in one sequence, so the versions are made once, and no
    table of all begins is built beside them: a join would broadcast it wherever its size is
    estimated too low, as it is behind row images.
    """
    row = F.struct(*versions.columns)
    ends = F.array(F.struct(F.col("valid_from").alias("at"), F.lit(None).cast(versions.schema).alias("row")), F.struct(F.col("valid_to").alias("at"), row.alias("row")))
    line = versions.select(F.col(key).alias("__k"), F.explode(ends).alias("e")).select("__k", F.col("e.at").alias("__at"), F.col("e.row").alias("__row"))
    # a row of the table has a time; what has none begins and ends nowhere
    met = line.where("__at is not null").withColumn("__begun", F.max(F.col("__row").isNull()).over(Window.partitionBy("__k", "__at")))
    # null keys meet nothing
    return met.where("__row is not null and (not __begun or __k is null)").select("__row.*")

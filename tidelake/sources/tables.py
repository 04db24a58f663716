"""Reading and writing tables: plain Parquet folders, partitioned by day where they grow."""

from __future__ import annotations

import atexit
import datetime as dt
import shutil
import tempfile
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def has_source(spark: SparkSession, name: str) -> bool:
    """Whether a data source such as ``kafka`` or ``delta`` is on the class path."""
    classes = {"kafka": "org.apache.spark.sql.kafka010.KafkaSourceProvider", "delta": "io.delta.sql.DeltaSparkSessionExtension", "avro": "org.apache.spark.sql.avro.AvroFileFormat"}
    try:
        spark._jvm.java.lang.Class.forName(classes[name], False, spark._jvm.java.lang.Thread.currentThread().getContextClassLoader())
        return True
    except Exception:
        return False


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def append_partitioned(rows: DataFrame, path: str, day: str) -> None:
    """Appends rows to a table partitioned by a day column; rows of a day are written together."""
    rows.repartition(day).write.partitionBy(day).mode("append").parquet(path)


def overwrite_extract(spark: SparkSession, rows: Sequence[tuple] | DataFrame, schema: StructType | str, path: str) -> None:
    """Replaces an extract, schema included.  No rows: an empty table that still has its types."""
    df = rows if isinstance(rows, DataFrame) else spark.createDataFrame(list(rows), schema)
    df.write.mode("overwrite").parquet(path)


def overwrite_days(rows: DataFrame, path: str, day: str) -> None:
    """Replaces only the days that ``rows`` have."""
    rows.repartition(day).write.partitionBy(day).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def without_day(rows: DataFrame, column: str, day: dt.date) -> DataFrame:
    return rows.where(F.col(column).isNull() | (F.col(column) != F.lit(day)))


def delete_day(spark: SparkSession, path: str, column: str, day: dt.date) -> None:
    """Removes one day of a table partitioned by it; the other days' files are not touched."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={day.isoformat()}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def quarantined(rows: DataFrame, reason: str, source_table: str, at=None) -> DataFrame:
    """Rejected rows with when, why and from where."""
    return rows.withColumn("quarantined_at", F.current_timestamp() if at is None else at).withColumn("reason", F.lit(reason)).withColumn("source_table", F.lit(source_table))


def quarantine_append(rows: DataFrame, path: str, reason: str, source_table: str) -> None:
    quarantined(rows, reason, source_table).write.mode("append").parquet(path)


def register_sources(spark: SparkSession, paths: Mapping[str, str]) -> list[str]:
    """Names tables for SQL; those whose folder is not there yet are left out."""
    out = []
    for name, path in paths.items():
        try:
            spark.read.parquet(path).createOrReplaceTempView(name)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            continue
        out.append(name)
    return out


def file_count(spark: SparkSession, path: str) -> int:
    """Files behind a table; -1 if there is none."""
    try:
        return len(spark.read.parquet(path).inputFiles())
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return -1


#: Bits of a key's rank in a Z-order, and bytes of a file that a layout aims at.
RANK_BITS, FILE_BYTES = 6, 256 << 20


def _as_number(rows: DataFrame, key: str) -> Column:
    """A number that orders as the key does: of texts and binaries the first six bytes count."""
    kind, c = dict(rows.dtypes)[key], F.col(key)
    if kind in ("string", "binary"):
        return F.conv(F.rpad(F.hex(F.substring(c.cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double")
    return F.unix_micros(c.cast("timestamp")).cast("double") if kind in ("date", "timestamp", "timestamp_ntz") else c.cast("double")


def z_value(rows: DataFrame, keys: Sequence[str], bits: int = RANK_BITS) -> Column:
    """The interleaved bits of the keys' ranks; a rank is the number of the key's 2^bits quantiles up
    to a value (null: 0), so that each range of a key has about as many rows, however it is spread."""
    share = [i / 2**bits for i in range(1, 2**bits)]
    cuts = rows.agg(*[F.percentile_approx(_as_number(rows, k), share, 10_000).alias(f"c{i}") for i, k in enumerate(keys)]).first()

    def rank(key: str, cut: list | None) -> Column:
        number = _as_number(rows, key)
        return F.coalesce(F.size(F.filter(F.lit(sorted(set(cut or []))).cast("array<double>"), lambda c: c <= number)), F.lit(0))

    ranks = [rank(k, cut) for k, cut in zip(keys, cuts)]
    parts = [F.shiftleft(F.shiftright(r, b).bitwiseAND(F.lit(1)).cast("long"), b * len(keys) + j) for j, r in enumerate(ranks) for b in range(bits)]
    return reduce(lambda x, y: x.bitwiseOR(y), parts)


def clustered(rows: DataFrame, keys: str | Sequence[str], files: int) -> DataFrame:
    """Rows in ranges of a key, or of the Z-order of several, each range one file: a lookup by any
    of the keys reads few of them."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if len(keys) == 1:
        return rows.repartitionByRange(files, *keys).sortWithinPartitions(*keys)
    z = rows.withColumn("__z", z_value(rows, keys))
    return z.repartitionByRange(files, "__z", *keys).sortWithinPartitions("__z", *keys).drop("__z")


def files_of(spark: SparkSession, path: str, size: int = FILE_BYTES) -> int:
    """The number of files of about ``size`` bytes that a table comes to."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    held = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    return max(1, -(-held // size))


def share_read(rows: DataFrame, key: str) -> float:
    """The share of a stored table's files that a lookup of one value of ``key`` reads, on average
    over the different values: files whose least and greatest value do not rule it out."""
    ends = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min(key).alias("low"), F.max(key).alias("high"))
    events = F.explode(F.array(F.struct(F.col("low").alias("at"), F.lit(0).alias("kind"), F.lit(1).alias("step")), F.struct(F.col("high").alias("at"), F.lit(2).alias("kind"), F.lit(-1).alias("step"))))
    asked = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("at")).distinct().select("at", F.lit(1).alias("kind"), F.lit(0).alias("step"))
    # files open at each value: two rows for each file, which values meet in order; one row for each value of the key
    line = ends.select(events.alias("e")).select("e.*").unionByName(asked)
    ranges = line.repartitionByRange("at", "kind").sortWithinPartitions("at", "kind").withColumn("part", F.spark_partition_id())
    ranges = stored(ranges)
    own = Window.partitionBy("part").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    sums = ranges.groupBy("part").agg(F.sum("step").alias("s")).withColumn("base", F.coalesce(F.sum("s").over(before), F.lit(0))).select("part", "base")
    found = ranges.withColumn("open", F.sum("step").over(own)).where("kind = 1").join(sums, "part").agg(F.avg(F.col("open") + F.col("base"))).first()[0]
    return (found or 0.0) / max(1, ends.count())


#: Hours that old files are kept at least before a table format may remove them.
LEAST_RETENTION_HOURS = 168


def maintain_layout(spark: SparkSession, path: str, into: str, keys: str | Sequence[str], files: int | None = None, dry_run: bool = False, retention_hours: float = LEAST_RETENTION_HOURS) -> tuple[int, int]:
    """Rewrites a table clustered by its lookup keys into a new folder, to which the caller then
    points its readers, in ``files`` files or as many as its bytes ask for.  Returns file counts
    before and after (dry run: before and before)."""
    if retention_hours < LEAST_RETENTION_HOURS:
        raise ValueError(f"files younger than {LEAST_RETENTION_HOURS} hours may still be read")
    before = file_count(spark, path)
    if dry_run or before < 0:
        return before, before
    clustered(spark.read.parquet(path), keys, files or files_of(spark, path)).write.mode("errorifexists").parquet(into)
    return before, file_count(spark, into)


def scratch_dir(spark: SparkSession) -> str:
    """A new path in the folder the session names in spark.checkpoint.dir; a temporary one on a single machine without."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="spark-scratch-", dir="/tmp")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    return f"{base.rstrip('/')}/core-{uuid.uuid4().hex}"


def stored(rows: DataFrame) -> DataFrame:
    """Rows as a table in the shared folder: computed once, however often and by whomever they are read."""
    path = scratch_dir(rows.sparkSession)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)

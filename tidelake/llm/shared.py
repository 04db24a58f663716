"""Small helpers that several operators of this subpackage use."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What counts as a word wherever a contract says so (fixed value).
WORD = r"[^\x20\x09-\x0D]+"
#: The characters that separate words (fixed value).
BLANKS = " \t\n\x0b\x0c\r"


def shared_dir(spark: SparkSession) -> str:
    """A new path in the folder that driver and executors share.

    The folder is the one the session names in ``spark.checkpoint.dir``.  Where
    none is named (tests on one machine) a temporary folder takes its place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="spark-scratch-", dir="/tmp")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(f"file://{base}")
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, safe against lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables that are needed only until a result made of them is written.  As a context
    manager it removes them at its end."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def written(self, df: DataFrame) -> DataFrame:
        path = shared_dir(self.spark)
        self.paths.append(path)
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        while self.paths:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop())
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.drop()


def new_name(docs: DataFrame, wish: str) -> str:
    """A name that no column of ``docs`` has."""
    taken = {c.lower() for c in docs.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def text_in(doc: str, text: str) -> Column:
    """The text in a struct column (null: empty)."""
    return F.coalesce(F.col(doc).getField(text).cast("string"), F.lit(""))


def numbered(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` as (rid, doc, text): a row number that stays the same for every later read,
    all columns of the row in one struct (so no name of theirs can clash) and the text (null:
    empty).  The first two are written; the text is taken from the row when it is read."""
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    return written(rows).withColumn("text", text_in("doc", text))


def word_array(text: Column) -> Column:
    """The words of a text as an array, in order; empty for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words of a text (null: 0)."""
    return F.size(word_array(text)).cast("long")


def connected_components(edges: DataFrame) -> DataFrame:
    """Connected components of an undirected graph.

    ``edges``: (a long, b long), neither null.  Returns (node, root) for every node but
    the smallest of its component, which is the root.  Alternates
    the large-star and small-star steps: every step is one grouped minimum and one join, no
    neighbourhood is ever gathered in one row.  Each round ends in a written table, so the
    lineage stays short.  Ends when a round changes nothing.
    """
    held = Scratch(edges.sparkSession)
    edges = held.written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    state = _fingerprint(edges)
    while state[0]:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = (
            both.where("b > a").join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        large = large.where("a <> b").distinct()
        # every edge now points from a larger to a smaller node
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
        small = large.join(least, F.col("a") == F.col("n")).select("a", "b", "m")
        small = (
            small.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .where("a <> b")
            .distinct()
        )
        new = Scratch(edges.sparkSession)
        edges = new.written(small)
        before, state = state, _fingerprint(edges)
        held.drop()
        held = new
        if before == state:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _fingerprint(edges: DataFrame) -> tuple:
    """Number of edges and an order-free sum over them."""
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s"),
    ).first()
    return row["n"], row["s"]

"""Stored tables whose merges rewrite only what a batch touches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Buckets of a table unless told otherwise; a bucket should come to a few hundred MB.
BUCKETS = 16


class KeyedTable:
    """A table dealt into buckets by the hash of its key: ``<path>/bucket=<b>/version=<n>``.

    A merge reads the buckets that its batch has keys of, and writes these alone, under the batch's
    number; a bucket's newest version that was committed is its content.  Then the versions that
    were replaced before are removed, so at most one older copy of a bucket stays, from which a
    batch that runs again after a failure starts anew: its merge is applied once.  What an
    unfinished batch has left behind is not read, and is overwritten when the batch runs again.

    keys: what rows meet by in a merge.  Without keys the table is one bucket.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = (), buckets: int = BUCKETS):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets if keys else 1

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int") if self.keys else F.lit(0)

    def dealt(self, rows: DataFrame) -> DataFrame:
        """Rows by their ``bucket``, a bucket in one task: what a merge groups by bucket and key is not shuffled again."""
        return rows.withColumn("bucket", self.bucket()).repartition("bucket")

    # --- files ---

    def _listed(self, folder: str, prefix: str) -> list[int]:
        """Numbers of the entries ``<prefix><number>`` of a folder."""
        where = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in files.listStatus(where)] if files.exists(where) else []
        return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix))

    def _remove(self, folder: str) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)

    def _commit(self, number: int) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_commits/batch-{number}")
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(where, True).close()

    def batches(self) -> list[int]:
        """Numbers of the batches that were committed."""
        return self._listed(f"{self.path}/_commits", "batch-")

    def versions(self, before: int | None = None, only: Sequence[int] | None = None) -> dict[int, int]:
        """The version of each bucket that counts, of batches before ``before``."""
        done, out = set(self.batches()), {}
        for b in self._listed(self.path, "bucket="):
            if only is None or b in only:
                own = [v for v in self._listed(f"{self.path}/bucket={b}", "version=") if v in done and (before is None or v < before)]
                if own:
                    out[b] = own[-1]
        return out

    # --- rows ---

    def read(self, before: int | None = None, only: Sequence[int] | None = None) -> DataFrame | None:
        """The table, or of ``only`` some buckets; None if there is nothing yet."""
        paths = [f"{self.path}/bucket={b}/version={v}" for b, v in self.versions(before, only).items()]
        return self.spark.read.parquet(*paths) if paths else None

    def merge(self, batch: DataFrame, number: int, merge: Callable[[DataFrame | None, DataFrame], DataFrame]) -> list[int]:
        """merge(rows of the touched buckets or None, batch) becomes those buckets' content.
        Gives the touched buckets; a row for each of them comes to the driver.

        Rows that ``merge`` gives with a column ``bucket`` are dealt by it already (``dealt``) and are not shuffled again."""
        touched = sorted(r[0] for r in batch.select(self.bucket().alias("b")).distinct().collect())
        if touched:
            rows = merge(self.read(number, touched), batch)
            # dynamic: only versions of this number are replaced, those that the batch left behind when it failed
            dealt = (rows if "bucket" in rows.columns else self.dealt(rows)).withColumn("version", F.lit(number))
            dealt.write.partitionBy("bucket", "version").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.path)
        self._commit(number)
        for b, kept in self.versions(number, touched).items():
            for v in self._listed(f"{self.path}/bucket={b}", "version="):
                if v < kept:
                    self._remove(f"{self.path}/bucket={b}/version={v}")
        return touched

    def merging(self, merge: Callable[[DataFrame | None, DataFrame], DataFrame], prepare: Callable[[DataFrame], DataFrame] | None = None) -> Callable[[DataFrame, int], None]:
        """A ``foreach_batch_sink`` writer.  prepare: what makes rows with the table's keys of a
        micro-batch; its result is kept while it is merged."""

        def write(batch: DataFrame, number: int) -> None:
            if prepare is None:
                self.merge(batch, number, merge)
                return
            rows = prepare(batch).persist()
            try:
                self.merge(rows, number, merge)
            finally:
                rows.unpersist()

        return write

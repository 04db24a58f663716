"""Merkle fixity audit of WARC replicas.

A replica is a table of records (archive, offset, record_id, block).  Each record is hashed
with its place; the records that begin in one range of an archive's bytes make a leaf, and
each ``FANOUT`` neighbouring nodes a node of the next level, up to one root for an archive.
Two replicas are compared root by root; only below nodes that differ are the next level's
nodes compared, and only in leaves that differ the records.  Hashing a record does not need
its neighbours, and no node has more than a range's records or ``FANOUT`` children.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.llm.shared import written

#: Bytes of an archive to a leaf, and children to a node.
RANGE = 65_536
FANOUT = 16
#: Records of an archive that ``warc_records`` makes.
ARCHIVE_RECORDS = 1_000


def warc_records(pages: DataFrame, id_col: str = "page_id", url: str = "url", body: str = "html", per_archive: int = ARCHIVE_RECORDS) -> DataFrame:
    """``pages`` as WARC response records: (archive, offset, record_id, block binary).

    Records lie one after the other in archives of at most ``per_archive``; null urls and
    bodies are empty ones, a null id stays null.  Rows that repeat are records each.
    """
    rows = written(pages.select(F.monotonically_increasing_id().alias("rid"), F.col(f"`{id_col}`").alias("record_id"), F.coalesce(F.col(f"`{url}`"), F.lit("")).alias("url"), F.coalesce(F.col(f"`{body}`"), F.lit("")).alias("body")))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.col("url"),
        F.lit("\r\nWARC-Record-ID: <urn:record:"), F.coalesce(F.col("record_id").cast("string"), F.lit("")),
        F.lit(">\r\nContent-Length: "), F.octet_length("body").cast("string"), F.lit("\r\n\r\n"),
    )
    blocks = rows.select("rid", "record_id", F.concat(head, F.col("body"), F.lit("\r\n\r\n")).cast("binary").alias("block"))
    sizes = blocks.select("rid", F.floor(F.col("rid") / per_archive).alias("archive"), F.octet_length("block").cast("long").alias("length"))
    before = Window.partitionBy("archive").orderBy("rid").rowsBetween(Window.unboundedPreceding, -1)
    places = sizes.select("rid", "archive", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"))
    return blocks.join(places, "rid").select("archive", "offset", "record_id", "block")


def leaves(records: DataFrame) -> DataFrame:
    """(archive, offset, record_id, length, digest) of each record; the digest covers its place.

    A null block has length and digest of an empty one.  Records without archive or offset
    have no place and are left out.  Records at one place are one leaf entry with all their
    digests, in order.
    """
    block = F.coalesce(F.col("block"), F.lit(b""))
    one = records.where("archive is not null and offset is not null").select(
        "archive", "offset", "record_id", F.octet_length(block).cast("long").alias("length"), F.sha2(block, 256).alias("sha")
    )
    return one.groupBy("archive", "offset").agg(
        F.min("record_id").alias("record_id"), F.sum("length").alias("length"), F.sha2(F.concat_ws(",", F.col("offset").cast("string"), F.sort_array(F.collect_list("sha"))).cast("binary"), 256).alias("digest")
    )


def _combined(place: str, digest: str) -> Column:
    """One digest from those of the children, in the order of their places."""
    parts = F.sort_array(F.collect_list(F.struct(F.col(place), F.col(digest))))
    return F.sha2(F.array_join(F.transform(parts, lambda x: F.concat_ws(":", x[place].cast("string"), x[digest])), ",").cast("binary"), 256)


def tree(found: DataFrame, levels: int, span: int = RANGE, fanout: int = FANOUT) -> list[DataFrame]:
    """(archive, node, digest) of each level, leaves first, from ``leaves``."""
    level = written(found.withColumn("node", F.floor(F.col("offset") / span)).groupBy("archive", "node").agg(_combined("offset", "digest").alias("digest")))
    out = [level]
    for _ in range(levels - 1):
        level = written(level.groupBy("archive", F.floor(F.col("node") / fanout).alias("up")).agg(_combined("node", "digest").alias("digest")).withColumnRenamed("up", "node"))
        out.append(level)
    return out


def levels_for(last: int | None, span: int = RANGE, fanout: int = FANOUT) -> int:
    """Levels after which an archive whose last record begins at ``last`` has one node."""
    nodes, levels = (last or 0) // span, 1
    while nodes:
        nodes, levels = nodes // fanout, levels + 1
    return levels


def audit(first: DataFrame, second: DataFrame, span: int = RANGE, fanout: int = FANOUT) -> DataFrame:
    """Where two replicas differ: (archive, offset, record_id, kind, length, other_length).

    kind: ``changed`` (another content at the same place, as long), ``resized`` (another
    length), ``missing`` (only in the first), ``extra`` (only in the second).  Equal replicas
    and empty ones give no rows.
    """
    one, two = written(leaves(first)), written(leaves(second))
    last = one.select("offset").union(two.select("offset")).agg(F.max("offset").alias("last")).first()["last"]
    levels = levels_for(last, span, fanout)
    trees = list(zip(tree(one, levels, span, fanout), tree(two, levels, span, fanout)))
    wrong = None
    for a, b in reversed(trees):
        if wrong is not None:
            above = wrong.select("archive", F.col("node").alias("up"))
            a, b = (x.withColumn("up", F.floor(F.col("node") / fanout)).join(above, ["archive", "up"], "left_semi").drop("up") for x in (a, b))
        both = a.join(b.withColumnRenamed("digest", "other"), ["archive", "node"], "full_outer")
        wrong = written(both.where(~F.col("digest").eqNullSafe(F.col("other"))).select("archive", "node"))
    a, b = (x.withColumn("node", F.floor(F.col("offset") / span)).join(wrong, ["archive", "node"], "left_semi").drop("node") for x in (one, two))
    b = b.select("archive", "offset", F.col("record_id").alias("other_id"), F.col("length").alias("other_length"), F.col("digest").alias("other"))
    pairs = a.join(b, ["archive", "offset"], "full_outer").where(~F.col("digest").eqNullSafe(F.col("other")))
    kind = F.when(F.col("other").isNull(), "missing").when(F.col("digest").isNull(), "extra").when(F.col("length") != F.col("other_length"), "resized").otherwise("changed")
    return pairs.select("archive", "offset", F.coalesce("record_id", "other_id").alias("record_id"), kind.alias("kind"), "length", "other_length")

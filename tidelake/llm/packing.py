"""Packing of documents into length buckets with little padding.

Documents longer than ``longest`` tokens are cut into chunks of that length, so every length
is in 1..longest and the global histogram has at most that many rows, whatever the input.
Dynamic programming over it chooses the ``buckets`` upper bounds for which the padding is
least.  A bucket's batches each hold as many chunks as fit the token budget at the bucket's
bound.  A chunk's batch follows from its place in the bucket's order (by length); places are
counted in shards of bounded size and shifted by the shards before, so no bucket is ever
sorted in one task.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.llm.shared import word_count, written

LONGEST = 2_048
BUCKETS = 16
BUDGET = 32_768
#: Chunks of a shard on average, at most; what is broadcast is a row for each length.
SHARD_ROWS = 20_000


def bounds(histogram: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets that cover all lengths with the least padding.

    cost(i, j): padding if lengths i+1..j share a bucket, = length_j * count - tokens.
    Ties go to the smaller bound.
    """
    lengths = sorted(n for n, c in histogram.items() if c > 0)
    if not lengths:
        return []
    n = len(lengths)
    at = np.array(lengths, dtype=np.float64)
    rows = np.concatenate(([0.0], np.cumsum([float(histogram[x]) for x in lengths])))
    tokens = np.concatenate(([0.0], np.cumsum([float(histogram[x]) * x for x in lengths])))
    best = np.full(n + 1, np.inf)
    best[0] = 0
    choices = []
    for _ in range(min(buckets, n)):
        new, choice = np.full(n + 1, np.inf), np.zeros(n + 1, dtype=np.int64)
        new[0] = 0
        for j in range(1, n + 1):
            cost = best[:j] + at[j - 1] * (rows[j] - rows[:j]) - (tokens[j] - tokens[:j])
            choice[j] = int(np.argmin(cost))
            new[j] = cost[choice[j]]
        best = new
        choices.append(choice)
    out, j = [], n
    for choice in reversed(choices):
        if j == 0:
            break
        out.append(lengths[j - 1])
        j = int(choice[j])
    return out[::-1]


def packed(
    docs: DataFrame,
    length: Column | None = None,
    id_col: str = "doc_id",
    text: str = "text",
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    budget: int = BUDGET,
) -> DataFrame:
    """One row for each chunk: (doc_id, chunk, start, n_tokens, bucket, batch, slot, padding).

    length: tokens of a row, by default the words of its text.  chunk counts a document's
    chunks from 0; its tokens are start..start+n_tokens-1.  bucket: the bound its batch is
    padded to; batch counts the bucket's batches from 0, slot the places in it.  Equal lengths
    go by hash of the row, then by id and chunk.  Documents
    without tokens (null and empty texts) take one chunk of length 0 in bucket 0.  Rows that
    repeat are packed each.  No rows: no rows.
    """
    if budget < longest:
        raise ValueError("the budget must hold a chunk of the longest length")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), *([] if length is None else [length.alias("length")]))
    sizes = rows.select("doc_id", F.monotonically_increasing_id().alias("rid"), F.coalesce((word_count(F.col("text")) if length is None else F.col("length")).cast("long"), F.lit(0)).alias("size"))
    parts = F.greatest(F.ceil(F.col("size") / longest), F.lit(1)).cast("long")
    chunks = (
        written(sizes)
        .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
        .withColumn("start", F.col("chunk") * longest)
        .withColumn("n_tokens", F.least(F.col("size") - F.col("start"), F.lit(longest)))
    )
    counts = written(chunks.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")))  # at most longest + 1 rows
    cut = bounds({r["n_tokens"]: r["n"] for r in counts.collect() if r["n_tokens"] > 0}, buckets)
    bucket = F.lit(0)
    for b in reversed(cut):
        bucket = F.when(F.col("n_tokens") <= b, F.lit(b)).otherwise(bucket)
    bucket = F.when(F.col("n_tokens") == 0, F.lit(0)).otherwise(bucket)
    # shards of a bucket: its lengths, and inside a frequent length a hash; the plan is as large for any histogram
    plan = counts.select("n_tokens", bucket.cast("long").alias("bucket"), F.ceil(F.col("n") / SHARD_ROWS).cast("long").alias("shards"))
    chunks = chunks.join(F.broadcast(plan), "n_tokens").withColumn("shard", F.pmod(F.xxhash64("rid", "chunk"), F.col("shards"))).drop("shards")
    own = Window.partitionBy("n_tokens", "shard").orderBy("doc_id", "chunk", "rid")
    placed = chunks.withColumn("place", F.row_number().over(own) - 1)
    sizes_of = chunks.groupBy("bucket", "n_tokens", "shard").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("bucket").orderBy(F.desc("n_tokens"), "shard").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes_of.select("n_tokens", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    placed = placed.join(shift, ["n_tokens", "shard"]).withColumn("place", F.col("place") + F.col("shift"))
    each = F.when(F.col("bucket") == 0, F.lit(budget)).otherwise(F.floor(F.lit(budget) / F.col("bucket")))
    return placed.select(
        "doc_id",
        "chunk",
        "start",
        "n_tokens",
        "bucket",
        F.floor(F.col("place") / each).cast("long").alias("batch"),
        F.pmod(F.col("place"), each).cast("long").alias("slot"),
        (F.col("bucket") - F.col("n_tokens")).alias("padding"),
    )

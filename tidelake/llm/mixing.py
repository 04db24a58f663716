"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, the number of times the mix takes it.  Among all rates that give
each source its target of tokens, those nearest to 1 in relative entropy (weighted by tokens)
are exponentially tilted: rate = exp(sum of multipliers of the constraints the document is
in).  The multipliers minimise the convex dual; Newton's method finds them, with gradient and
Hessian summed by Spark over all documents in every iteration.  The constraints here are the
sources, each document being in one, so the Hessian is diagonal and a source's multiplier
can be stepped on its own: the multipliers stay a table, a row for each source.

Rates are then rounded into whole copies.  Documents of a source stand in order of size, in
shards of bounded length; copies are the steps of the rounded-down running sum of the rates,
all in integers, so that each document gets its rate rounded up or down, the tokens stay
near the target, and every rerun gives the same copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.llm.shared import numbered, word_count, written

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
#: Rates are kept in units of one millionth.
UNIT = 1_000_000
#: Documents of a source that one ordered shard holds on average.
SHARD_ROWS = 50_000
#: Newton's method ends when all constraints hold to this relative accuracy.
ACCURACY = 1e-9
ITERATIONS = 60


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, source_rows, target) for each source of ``sizes`` (source, size).

    Sources in code point order, null last, weigh ``weights``, repeating.  They share the sum
    of all sizes; no target exceeds ``repeats`` times its source's size, and what the capped
    ones leave goes to the others by weight.  The level at which that settles is found in one
    pass: capped are those with the least room for their weight.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    ranked = sources.withColumn("nth", F.row_number().over(Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("nth") % len(weights) + 1).cast("int"))
    room = ranked.withColumn("weight", weight.cast("double")).withColumn("cap", F.col("source_size") * F.lit(float(repeats)))
    room = room.withColumn("ratio", F.col("cap") / F.col("weight"))
    by_room = Window.orderBy("ratio", "nth")
    so_far = by_room.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(so_far), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(so_far), F.lit(0.0))
    )
    # from the first source on whose cap lies above the level, all get the level
    leveled = room.withColumn("level", level).withColumn("fits", F.when(F.col("level") <= F.col("ratio"), F.col("level")))
    leveled = leveled.withColumn("settled", F.first("fits", ignorenulls=True).over(by_room.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return leveled.select(
        "source", "source_size", "source_rows", F.coalesce(F.least("cap", F.col("settled") * F.col("weight")), F.lit(0.0)).alias("target")
    )


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def multipliers(sizes: DataFrame, goals: DataFrame, accuracy: float = ACCURACY, iterations: int = ITERATIONS) -> DataFrame:
    """``goals`` with lambda, the multiplier of each source's constraint (null where the
    source has no tokens).  Each iteration sums gradient and Hessian over ``sizes``.  Raises if
    they have not settled at the end."""
    state = goals.withColumn("lambda", F.when((F.col("source_size") > 0) & (F.col("target") > 0), F.lit(0.0)))
    for _ in range(iterations):
        tilted = F.col("size") * F.exp("lambda")
        state_of = state.select(F.col("source").alias("s"), "lambda")
        sums = (
            sizes.join(state_of, same(F.col("source"), F.col("s")))
            .groupBy("source")
            .agg(F.sum(tilted).alias("hessian"))
            .withColumnRenamed("source", "s")
        )
        step = (F.col("hessian") - F.col("target")) / F.col("hessian")
        # the dual of one constraint is steepest above its minimum; a bounded step down keeps exp() in range
        state = (
            state.join(sums, same(F.col("source"), F.col("s")), "left")
            .withColumn("off", F.abs(F.col("hessian") / F.col("target") - 1))
            .withColumn("lambda", F.col("lambda") - F.least(F.greatest(step, F.lit(-2.0)), F.lit(2.0)))
            .drop("s", "hessian")
        )
        state = written(state)
        off = state.agg(F.max("off").alias("off")).first()["off"]
        state = state.drop("off")
        if off is None or off < accuracy:
            return state
    raise RuntimeError(f"the multipliers are still off by {off:g} after {iterations} iterations")


def shard_of(key: Column, rows: Column, shard_rows: int = SHARD_ROWS) -> Column:
    """Which shard of its source a document is in: seven hexadecimal digits of the MD5 of
    its id, modulo the number of shards."""
    digits = F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 7), 16, 10).cast("long")
    return F.pmod(digits, F.ceil(rows / shard_rows).cast("long"))


def copies(
    docs: DataFrame,
    size: Column | None = None,
    source: str = "source",
    id_col: str = "doc_id",
    text: str = "text",
    weights: tuple[int, ...] = WEIGHTS,
    repeats: int = MAX_REPEATS,
) -> DataFrame:
    """(rid, doc_id, source, size, source_size, target, copies) for each row of ``docs``.

    size: tokens of a row, by default the words of its text (null: 0).  A null source is a
    source of its own.  Rows without tokens are taken at their source's rate as well; those
    of a source without any tokens not at all.  Rows that repeat are rows of their own.
    """
    return copies_of(numbered(docs, text), word_count(F.col("text")) if size is None else size, source, id_col, weights, repeats)


def copies_of(rows: DataFrame, size: Column, source: str, id_col: str, weights: tuple[int, ...], repeats: int) -> DataFrame:
    """``copies`` of numbered rows."""
    sizes = written(
        rows.select("rid", F.col("doc").getField(id_col).alias("doc_id"), F.col("doc").getField(source).alias("source"), size.cast("long").alias("size"))
    )
    goals = written(targets(sizes, weights, repeats))
    tilts = multipliers(sizes, goals).withColumnRenamed("source", "s")
    rate = F.coalesce(F.round(F.exp("lambda") * UNIT).cast("long"), F.lit(0))
    rated = sizes.join(tilts, same(F.col("source"), F.col("s"))).drop("s").withColumn("rate", rate)
    rated = rated.withColumn("shard", shard_of(F.col("doc_id"), F.col("source_rows")))
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    order = Window.partitionBy("source", "shard").orderBy(F.desc("size"), key, "rid").rowsBetween(Window.unboundedPreceding, 0)
    run = F.sum("rate").over(order)
    return (
        rated.withColumn("run", run + F.lit(UNIT // 2))
        .withColumn("copies", (F.floor(F.col("run") / UNIT) - F.floor((F.col("run") - F.col("rate")) / UNIT)).cast("long"))
        .select("rid", "doc_id", "source", "size", "source_size", "target", "copies")
    )


def mixed(docs: DataFrame, source: str = "source", id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with each row as often as the mix takes it; the columns stay."""
    rows = numbered(docs, text)
    taken = copies_of(rows, word_count(F.col("text")), source, id_col, WEIGHTS, MAX_REPEATS).where("copies > 0").select("rid", "copies")
    each = rows.join(taken, "rid").select("doc", F.explode(F.expr("sequence(1L, copies)")).alias("copy"))
    return each.select("doc.*")

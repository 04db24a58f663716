"""Quality rules: a decision list of threshold conjunctions learned from labelled statistics.

All of it is DataFrame expressions.  Sequential covering: a rule grows by the threshold that
gains most (FOIL's gain), on rows that no rule before it covers; it is pruned back to the
prefix that does best on rows set aside; it stands if it is precise there.  If it is not, rules
grow from the best conditions of every statistic in either direction, and the list ends only
when none of them gives a rule that stands.  Each step is one grouped count over the distinct
binned statistics of the labelled rows, whose result has a row for each rule in question,
statistic and bin, and the list that comes out is one ordered conditional expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.llm.shared import BLANKS, written

#: Characters that count as symbols (fixed value).
SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
#: Percent of words in repeated windows from which on a text fails.
MOST_REPEATED = 30

#: Statistics that rules are made of.
STATISTICS = (
    "n_words", "word_length", "symbol_share", "upper_share", "digit_share", "mark_share", "line_words",
    "dup_line_share", "repeat_share", "distinct_share",
)
BINS = 48
CONDITIONS = 4
#: Share of bad rows that a rule needs among those it covers, in growing and on the rows set aside.
PRECISION = 0.97
LEAST_ROWS = 4


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def statistics(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Counts and shares of whole texts, with the columns ``keep`` of docs.

    Counts (long): n_words, word_chars (code points in words), n_symbols, n_lines (lines with
    a word), n_dup_lines (of those, equal to an earlier one), n_repeat_words (words in windows
    of eight words found twice or more in the text).  The further shares are doubles; what
    would divide by zero is 0.  Null and empty texts have zeros everywhere.  Windows are told
    apart by 64-bit hashes within a text.
    """
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], whole.alias("__text"))
    rows = rows.withColumn("__words", F.filter(F.split("__text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    rows = rows.withColumn("__n", F.size("__words"))
    hashes = F.expr(f"if(__n < {WINDOW + 1}, array(), transform(sequence(1, __n - {WINDOW - 1}), i -> xxhash64(slice(__words, i, {WINDOW}))))")
    rows = rows.withColumn("__windows", hashes.cast("array<bigint>"))
    rows = rows.withColumn("__lines", F.filter(F.split("__text", "\n"), lambda x: F.trim(F.translate(x, BLANKS, "")) != ""))
    # windows in order of hash; those with an equal neighbour, by place; the words they cover
    rows = rows.withColumn(
        "__sorted",
        F.when(F.size(F.array_distinct("__windows")) < F.size("__windows"), F.sort_array(F.expr("transform(__windows, (h, i) -> struct(h, i))"))),
    )
    rows = rows.withColumn(
        "__at",
        F.expr(
            "sort_array(filter(transform(__sorted, (x, j) -> if((j > 0 and get(__sorted, j - 1).h = x.h)"
            " or get(__sorted, j + 1).h = x.h, x.i, null)), p -> p is not null))"
        ),
    )
    rows = rows.withColumn(
        "n_repeat_words",
        F.coalesce(F.expr(f"aggregate(transform(__at, (p, j) -> least({WINDOW}, coalesce(get(__at, j + 1) - p, {WINDOW}))), 0L, (a, b) -> a + b)"), F.lit(0)).cast("long"),
    )
    chars = F.length("__text")
    rows = rows.select(
        *keep,
        F.col("__n").cast("long").alias("n_words"),
        F.length(_without(F.col("__text"), BLANKS)).cast("long").alias("word_chars"),
        (chars - F.length(_without(F.col("__text"), SYMBOLS))).cast("long").alias("n_symbols"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        (chars - F.length(F.regexp_replace("__text", r"\p{Lu}+", ""))).cast("long").alias("__upper"),
        (chars - F.length(_without(F.col("__text"), "0123456789"))).cast("long").alias("__digits"),
        (chars - F.length(_without(F.col("__text"), "!?"))).cast("long").alias("__marks"),
        F.size(F.array_distinct("__words")).cast("long").alias("__distinct"),
    )

    def share(of: str, by: str) -> Column:
        return F.when(F.col(by) > 0, F.col(of) / F.col(by)).otherwise(0.0)

    return rows.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
        share("word_chars", "n_words").alias("word_length"),
        share("n_symbols", "word_chars").alias("symbol_share"),
        share("__upper", "word_chars").alias("upper_share"),
        share("__digits", "word_chars").alias("digit_share"),
        share("__marks", "word_chars").alias("mark_share"),
        share("n_words", "n_lines").alias("line_words"),
        share("n_dup_lines", "n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("__distinct", "n_words").alias("distinct_share"),
    )


def base_failed() -> Column:
    """Too few words, or too many in repeated windows."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    """``statistic > threshold`` or ``statistic <= threshold``."""

    statistic: str
    above: bool
    threshold: float

    def column(self) -> Column:
        c = F.col(self.statistic)
        return c > self.threshold if self.above else c <= self.threshold

    def __str__(self) -> str:
        return f"{self.statistic} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass
class DecisionList:
    """Ordered rules; a row is bad from the first one on that holds, good if none does."""

    rules: list[list[Condition]] = field(default_factory=list)

    def nth(self) -> Column:
        """Number of the first rule that holds, from 1; null if none does."""
        out = None
        for i, rule in enumerate(self.rules, 1):
            holds = reduce(lambda a, b: a & b, [c.column() for c in rule])
            out = F.when(holds, i) if out is None else out.when(holds, i)
        return F.lit(None).cast("int") if out is None else out

    def good(self) -> Column:
        return self.nth().isNull()

    def __str__(self) -> str:
        return "\n".join([*("IF " + " AND ".join(map(str, r)) + " THEN bad" for r in self.rules), "ELSE good"])


def learn(rows: DataFrame, statistics: tuple[str, ...] = STATISTICS, label: str = "label", key: str = "doc_id") -> DecisionList:
    """A decision list for the rows whose ``label`` is 0.

    Rows with a null label are left out; null statistics count as 0.  A third of the rows, by
    hash of ``key``, is set aside for pruning.  Without rows of both labels the list is empty.
    """
    narrow = rows.where(F.col(label).isin(0, 1)).select(
        (F.col(label) == 0).alias("bad"),
        (F.pmod(F.xxhash64(F.lit("prune"), F.col(key)), F.lit(3)) == 0).alias("aside"),
        *[F.coalesce(F.col(s).cast("double"), F.lit(0.0)).alias(s) for s in statistics],
    )
    narrow = written(narrow)
    wanted = F.array(*[F.lit(i / BINS) for i in range(1, BINS)])
    cuts = narrow.groupBy("bad").agg(*[F.percentile_approx(s, wanted, F.lit(10_000)).alias(s) for s in statistics]).collect()
    if len(cuts) < 2:
        return DecisionList()
    thresholds = {s: sorted({float(v) for r in cuts for v in r[s]}) for s in statistics}
    # rows alike in every bin are alike to every rule: one row stands for them, with their number
    bins = [f"__{s}" for s in statistics]
    binned = narrow.select("bad", "aside", *statistics, *[_bin(s, thresholds[s]).alias(b) for s, b in zip(statistics, bins)])
    binned = written(binned.groupBy("bad", "aside", *bins).agg(F.count(F.lit(1)).alias("rows"), *[F.min(s).alias(s) for s in statistics]))
    found = DecisionList()
    left = binned
    while rule := _next(left, statistics, thresholds):
        found.rules.append(rule)
        left = binned.where(found.good())
    return found


def _next(rows: DataFrame, statistics: tuple[str, ...], thresholds: dict[str, list[float]]) -> list[Condition] | None:
    """The first rule, by the gain of its leading condition, that stands on the rows set aside.

    The rule from the best condition of all is tried alone; if it fails, rules grow side by
    side from the best conditions of each statistic and direction.
    """
    growing, aside = rows.where("not aside"), rows.where("aside")
    best: dict[tuple[str, bool], tuple[float, Condition]] = {}
    for gain, c in _gains(_counts(growing, [[]], statistics)[0], statistics, thresholds):
        if gain > best.get((c.statistic, c.above), (0.0,))[0]:
            best[c.statistic, c.above] = gain, c
    leads = [c for _, c in sorted(best.values(), key=lambda x: -x[0])]
    for some in (leads[:1], leads[1:]):
        for rule in _pruned(aside, _grown(growing, some, statistics, thresholds)) if some else []:
            if rule:
                return rule
    return None


def _bin(statistic: str, thresholds: list[float]) -> Column:
    """How many thresholds lie below the value."""
    return F.size(F.filter(F.array(*[F.lit(t) for t in thresholds]), lambda t: t < F.col(statistic)))


def _holding(rules: list[list[Condition]]) -> Column:
    """The numbers, from 0, of all rules that hold; a row for each."""
    return F.explode(F.array_compact(F.array(*[F.when(reduce(lambda a, b: a & b, [c.column() for c in r], F.lit(True)), i) for i, r in enumerate(rules)])))


def _bad_and_good() -> list[Column]:
    return [F.sum(F.when(F.col("bad") == F.lit(y), F.col("rows")).otherwise(0)).alias(n) for y, n in ((True, "b"), (False, "g"))]


def _counts(rows: DataFrame, rules: list[list[Condition]], statistics: tuple[str, ...]) -> list[dict[str, dict[int, tuple[int, int]]]]:
    """Of the rows that each rule covers, bad and good ones by statistic and bin."""
    each = F.explode(F.array(*[F.struct(F.lit(s).alias("s"), F.col(f"__{s}").alias("bin")) for s in statistics])).alias("x")
    covered = rows.select("*", _holding(rules).alias("rule")).select("rule", "bad", "rows", each)
    sums = covered.groupBy("rule", "x.s", "x.bin").agg(*_bad_and_good())
    out: list[dict[str, dict[int, tuple[int, int]]]] = [{s: {} for s in statistics} for _ in rules]
    for r in sums.collect():  # a row for each rule, statistic and bin
        out[r["rule"]][r["s"]][r["bin"]] = (r["b"], r["g"])
    return out


def _total(counts: dict[str, dict[int, tuple[int, int]]], statistics: tuple[str, ...]) -> tuple[int, int]:
    found = counts[statistics[0]].values()
    return sum(b for b, _ in found), sum(g for _, g in found)


def _gains(counts: dict[str, dict[int, tuple[int, int]]], statistics: tuple[str, ...], thresholds: dict[str, list[float]]) -> list[tuple[float, Condition]]:
    """All conditions that gain something, with their gains; none where too few bad rows are left."""
    bad, good = _total(counts, statistics)
    if bad < LEAST_ROWS:
        return []
    base = math.log2(bad / (bad + good))
    out = []
    for s in statistics:
        b = g = 0
        for i, t in enumerate(thresholds[s]):
            x, y = counts[s].get(i, (0, 0))
            b, g = b + x, g + y
            for above, p, n in ((True, bad - b, good - g), (False, b, g)):
                if p >= LEAST_ROWS and p + n < bad + good:
                    gain = p * (math.log2(p / (p + n)) - base)
                    if gain > 1e-9:
                        out.append((gain, Condition(s, above, t)))
    return out


def _grown(rows: DataFrame, leads: list[Condition], statistics: tuple[str, ...], thresholds: dict[str, list[float]]) -> list[list[Condition]]:
    """A rule from each leading condition; all grow by one condition in a step."""
    rules = [[c] for c in leads]
    growing = list(range(len(rules)))
    for _ in range(CONDITIONS - 1):
        still = []
        for i, counts in zip(growing, _counts(rows, [rules[i] for i in growing], statistics)):
            bad, good = _total(counts, statistics)
            if bad >= PRECISION * (bad + good):
                continue
            found = _gains(counts, statistics, thresholds)
            if found:
                best = max(found, key=lambda x: x[0])[1]
                rules[i] = [c for c in rules[i] if (c.statistic, c.above) != (best.statistic, best.above)] + [best]
                still.append(i)
        growing = still
        if not growing:
            break
    return rules


def _pruned(rows: DataFrame, rules: list[list[Condition]]) -> list[list[Condition] | None]:
    """Of each rule, the prefix that tells best on rows set aside; None if none is precise there."""
    prefixes = [r[: k + 1] for r in rules for k in range(len(r))]
    sums = rows.select("bad", "rows", _holding(prefixes).alias("rule")).groupBy("rule").agg(*_bad_and_good())
    counts = {r["rule"]: (r["b"], r["g"]) for r in sums.collect()}
    out, at = [], 0
    for rule in rules:
        best = None
        for i in range(len(rule)):
            b, g = counts.get(at + i, (0, 0))
            if b >= LEAST_ROWS / 2 and b >= PRECISION * (b + g):
                value = (b - g) / (b + g) * math.sqrt(b)
                if best is None or value > best[0]:
                    best = (value, i + 1)
        out.append(rule[: best[1]] if best else None)
        at += len(rule)
    return out


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality") -> tuple[DataFrame, DecisionList]:
    """Statistics of every row with base_failed, rule (the first rule that holds) and kept;
    and the list learned from the labelled rows.  Rows that repeat stay; labels with a null
    id or label teach nothing."""
    stats = written(statistics(docs, text, (id_col,)))
    known = labels.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{label}`").alias("label")).where("__id is not null and label in (0, 1)").distinct()
    found = learn(stats.join(known, F.col(id_col) == F.col("__id")), key=id_col)
    out = stats.withColumn("base_failed", base_failed()).withColumn("rule", found.nth())
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()), found




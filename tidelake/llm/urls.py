"""URL filter over a sorted array of 64-bit digests.

The list's entries are strings host + path.  An entry fits a url if its host is the url's or
a parent domain of it and the url's path begins with its path.  So a url asks for a bounded
number of strings: each of its host's suffixes with each of its path's beginnings that has
the length of some entry's path.  Entries and questions meet by the leading bits of their
xxhash64: each bucket's digests are sorted into a memory-mapped array, all its questions are
answered by one vectorised binary search, and the full strings stored beside the digests are
compared, so digests that collide do no harm.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.llm.shared import written

#: Entries or questions of a bucket, on average, at most.
BUCKET_ROWS = 200_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(_after(url), r"^[^/?#]*", 0)
    return F.translate(F.when(F.contains(url, F.lit("://")), rest).otherwise(""), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.when(F.contains(url, F.lit("://")), F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def _after(url: Column) -> Column:
    return F.substr(url, F.instr(url, "://") + 3)


class DigestArray:
    """Sorted 64-bit digests in a memory-mapped file, with the strings they stand for."""

    def __init__(self, digests: np.ndarray, strings: np.ndarray, folder: str):
        order = np.argsort(digests, kind="stable")
        path = os.path.join(folder, "digests")
        digests[order].astype("<u8").tofile(path)
        self.keys = np.memmap(path, dtype="<u8", mode="r") if len(digests) else np.zeros(0, dtype="<u8")
        self.order = order
        self.strings = strings[order]

    def find(self, digests: np.ndarray, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(question, entry) for every question whose string is an entry's."""
        left, right = np.searchsorted(self.keys, digests, "left"), np.searchsorted(self.keys, digests, "right")
        asked, entry = [], []
        for step in range(int((right - left).max(initial=0))):  # over 1 only where digests collide or entries repeat
            open_ = np.flatnonzero(left + step < right)
            at = left[open_] + step
            same = self.strings[at] == strings[open_]
            asked.append(open_[same])
            entry.append(self.order[at[same]])
        return (np.concatenate(asked), np.concatenate(entry)) if asked else (np.zeros(0, dtype=int), np.zeros(0, dtype=int))


def probe(entries: DataFrame, questions: DataFrame) -> DataFrame:
    """``entries`` (text and further columns) whose text is asked for by ``questions`` (text)."""
    larger = max(entries.count(), questions.count())
    bits = max(4, int(np.ceil(np.log2(max(larger / BUCKET_ROWS, 1)))))
    digest = F.xxhash64("text")
    bucket = F.shiftrightunsigned(digest, 64 - bits)
    a = entries.withColumn("digest", digest).withColumn("bucket", bucket)
    b = questions.select("text", digest.alias("digest"), bucket.alias("bucket"))

    def search(entries: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(entries) or not len(asked):
            return entries.iloc[:0]
        with tempfile.TemporaryDirectory() as folder:
            array = DigestArray(entries["digest"].to_numpy().view(np.uint64), entries["text"].to_numpy(), folder)
            _, found = array.find(asked["digest"].to_numpy().view(np.uint64), asked["text"].to_numpy())
        return entries.iloc[np.unique(found)]

    met = a.groupBy("bucket").cogroup(b.groupBy("bucket")).applyInPandas(search, a.schema)
    return met.drop("digest", "bucket")


def judged(pages: DataFrame, rules: DataFrame, listed: DataFrame, id_col: str = "page_id", url: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages``.

    ``rules``: (host, path, verdict), the longest that fits decides; of equally long ones the
    first in order.  ``listed``: (host, path) of further entries that block where no rule
    fits; all else is allowed.  Null urls and those without ``://`` have empty host and path
    and fit nothing.  Null hosts in rules and list are left out, null paths are empty.
    """
    rows = written(pages.select(F.monotonically_increasing_id().alias("rid"), F.col(f"`{id_col}`").alias("page_id"), F.coalesce(F.col(f"`{url}`"), F.lit("")).alias("url")))
    rows = rows.select("rid", "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    path = F.coalesce(F.col("path"), F.lit(""))
    named = [
        rules.select("host", path.alias("path"), "verdict", F.lit(True).alias("is_rule")),
        listed.select("host", path.alias("path"), F.lit("block").alias("verdict"), F.lit(False).alias("is_rule")),
    ]
    entries = named[0].union(named[1]).where("host is not null").withColumn("text", F.concat("host", "path")).dropDuplicates(["text", "verdict", "is_rule"])
    entries = written(entries.select("text", "verdict", "is_rule", F.length("path").alias("path_length")))
    lengths = [r["path_length"] for r in entries.select("path_length").distinct().orderBy("path_length").collect()]  # bounded by the longest path

    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    heads = F.filter(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]), lambda p: p.isNotNull()) if lengths else F.array().cast("array<string>")
    each = rows.where("host <> ''").select("host", "path", F.explode(suffixes).alias("suffix")).select("host", "path", "suffix", F.explode(heads).alias("head"))
    # most urls of a host ask the same: hosts and heads are made different before they are dealt
    asked = written(each.select("host", "head", F.concat("suffix", "head").alias("text")).distinct())
    hits = written(probe(entries, asked.select("text").distinct()))
    answers = asked.join(hits, "text").groupBy("host", "head").agg(
        F.max(F.when(F.col("is_rule"), F.struct(F.length("text").alias("n"), "text", "verdict"))).alias("rule"), F.max(~F.col("is_rule")).alias("is_listed")
    )
    own = rows.where("host <> ''").select("rid", "host", F.explode(heads).alias("head")).join(answers, ["host", "head"])
    best = own.groupBy("rid").agg(F.max("rule").alias("rule"), F.max("is_listed").alias("is_listed"))
    verdict = F.coalesce(F.col("rule.verdict"), F.when(F.col("is_listed"), "block"), F.lit("allow"))
    return rows.join(best, "rid", "left").select("page_id", "host", "path", F.col("rule.text").alias("rule"), verdict.alias("verdict"))

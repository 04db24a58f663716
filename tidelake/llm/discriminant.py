"""Quality classifier: a regularised quadratic discriminant over document statistics.

Statistics of whole texts are transformed towards normal shape.  Per class, count, sums and
sums of products come from one grouped aggregation over all labelled rows; only those few
numbers reach the driver.  A class's covariance is shrunk towards the pooled one and that
towards a scaled identity.  A text's score is the posterior of class 1: the difference of
the two Mahalanobis log densities, from Cholesky factors computed once, and of the priors.
"""

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.llm.rules import statistics
from tidelake.llm.shared import written

#: Weight of the pooled covariance in each class's, and of the scaled identity in that.
TO_POOLED = 0.2
TO_IDENTITY = 0.02
ACCEPT = 0.7
#: Log odds at which a score lies halfway between even and certain; it puts ACCEPT at that posterior.
HALFWAY = math.log(ACCEPT / (1 - ACCEPT)) * (1 / (2 * ACCEPT - 1) - 1)

_EPS = 1e-3


def _logit(share: str) -> Column:
    return F.log((F.col(share) + _EPS) / (1 - F.least(F.col(share), F.lit(1.0)) + _EPS))


def transformed() -> dict[str, Column]:
    """The features, by name, of a row of ``statistics``."""
    return {
        "length": F.log1p(F.col("n_words")),
        "word_length": F.log1p(F.col("word_length")),
        "line_words": F.log1p(F.col("line_words")),
        # few distinct words are natural in a long text: Heaps' law takes the length out
        "distinct": F.log((F.col("distinct_share") + _EPS)) + 0.3 * F.log1p(F.col("n_words")),
        **{s: _logit(s) for s in ("symbol_share", "upper_share", "digit_share", "mark_share", "dup_line_share", "repeat_share")},
    }


@dataclass(frozen=True)
class Discriminant:
    """Mean, inverse Cholesky factor and log determinant of each class, and the log prior odds."""

    means: list[np.ndarray]
    factors: list[np.ndarray]
    logdets: list[float]
    odds: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """Of class 1, for each row of x."""
        logs = []
        for mean, factor, logdet in zip(self.means, self.factors, self.logdets):
            z = (x - mean) @ factor.T
            logs.append(-0.5 * ((z * z).sum(axis=1) + logdet))
        return logs[1] - logs[0] + self.odds

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds in the same order between 0 and 1."""
        odds = self.log_odds(x)
        return 0.5 + 0.5 * odds / (HALFWAY + np.abs(odds))


def fit(moments: dict[int, tuple[int, np.ndarray, np.ndarray]], to_pooled: float = TO_POOLED, to_identity: float = TO_IDENTITY) -> Discriminant | None:
    """From (count, sums, sums of products) of classes 0 and 1; None unless both have rows."""
    if set(moments) != {0, 1}:
        return None
    total = sum(m[0] for m in moments.values())
    means, spread = [], []
    for y in (0, 1):
        n, s, p = moments[y]
        means.append(s / n)
        spread.append(p - np.outer(s, s) / n)
    pooled = (spread[0] + spread[1]) / total
    d = len(pooled)
    factors, logdets = [], []
    for y in (0, 1):
        cov = (1 - to_pooled) * spread[y] / moments[y][0] + to_pooled * pooled
        cov = (1 - to_identity) * cov + to_identity * (max(np.trace(pooled), 1e-6) / d) * np.eye(d)
        low = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(low))
        logdets.append(2 * float(np.log(np.diag(low)).sum()))
    return Discriminant(means, factors, logdets, math.log(moments[1][0] / moments[0][0]))


def moments(rows: DataFrame, names: list[str], label: str) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Count, sums and sums of products of the columns ``names`` by label."""
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    sums = [F.sum(n).alias(f"s{i}") for i, n in enumerate(names)] + [F.sum(F.col(a) * F.col(b)).alias(f"p{i}") for i, (a, b) in enumerate(pairs)]
    out = {}
    for r in rows.groupBy(label).agg(F.count(F.lit(1)).alias("n"), *sums).collect():  # one row for each class
        products = np.zeros((len(names), len(names)))
        for i, (a, b) in enumerate(pairs):
            products[names.index(a), names.index(b)] = products[names.index(b), names.index(a)] = r[f"p{i}"]
        out[r[label]] = (r["n"], np.array([r[f"s{i}"] for i in range(len(names))]), products)
    return out


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """(id, score) for every row of ``docs``, learned from ``labels`` (id, label 0 or 1).

    All labelled rows count, once for each different label of their id; null ids and labels
    are left out.  Null and empty texts are scored by their (zero) statistics.  Without rows
    of both labels every score is 0.5.  Rows that repeat stay.
    """
    features = transformed()
    names = list(features)
    stats = statistics(docs, text, (id_col,))
    stats = written(stats.select(id_col, *[c.alias(f"f_{n}") for n, c in features.items()]))
    known = labels.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{label}`").cast("int").alias("__y")).where("__id is not null and __y in (0, 1)").distinct()
    columns = [f"f_{n}" for n in names]
    model = fit(moments(stats.join(known, F.col(id_col) == F.col("__id")), columns, "__y"))
    if model is None:
        return stats.select(id_col, F.lit(0.5).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(x: pd.DataFrame) -> pd.Series:
        return pd.Series(shared.value.score(x.to_numpy(dtype=np.float64)))

    return stats.select(id_col, score(F.struct(*columns)).alias("score"))

"""Toxicity of texts whose words may be disguised.

A noisy channel writes a letter as itself, as a look-alike (leetspeak), several times
(repetition) or with something between letters (spacing).  Stretches that look so are decoded
by Viterbi: every observed character becomes a set of arcs (letters it may stand for, nothing,
a word break), and the best path through that lattice under a character trigram model is the
restored text.  The model's trigrams are counted over all texts given.

Words of the plain and of the restored text, and their beginnings, are evidence as far as labels
make them so.  A word is either of the few that mark toxic texts or one that says nothing; how
often it stands in toxic and in clean texts gives the probability that it is a mark, and with it
the share of toxic texts to expect among those that have it.  The score combines the shares by
noisy-or over what is left for texts that have none.  No word is cut off for being rare: it
counts by what its few texts tell.  Words that begin alike are one stem and tell one thing, by
the strongest of their features; a second count gives each labelled text to that one alone, so
that words which only stand beside a mark are none.
"""

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.llm.shared import written

#: Labelled rows a lexicon is learned from at most (those first in the order of their ids' hashes).
FIT_ROWS = 50_000
#: Share of all words that mark toxic texts, and of toxic texts among those that have such a word.
MARKS = 0.002
PURITY = 0.95
#: What a feature must add to a score to be kept in the lexicon.
LEAST_SHARE = 0.02
#: Word beginnings that are features besides whole words.
PREFIXES = (3, 4, 5, 6, 7)
#: Different words with one beginning that are told apart.
MOST_WORDS = 4
REJECT = 0.7

#: Letters that a character may stand for besides itself (fixed values).
LOOKALIKES = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "(": "c", "£": "l", "¡": "i", "§": "s",
}
#: Costs of the channel, as negative logarithms of probabilities.
COST = {"self": 0.1, "lookalike": 1.0, "skip": 1.2, "dropped": 15.0, "break": 1.5, "double": 0.7}

_LEET = "".join(LOOKALIKES)
_LETTER = r"[^\W\d_]"
_ANY_LEET = f"[{re.escape(_LEET)}]"
#: A token with a look-alike before, between or after letters, or a letter three times running.
_ODD = re.compile(rf"{_LETTER}{_ANY_LEET}+{_LETTER}|(?:^|[^\w]){_ANY_LEET}+{_LETTER}{{2}}|({_LETTER})\1\1|{_LETTER}{{2}}[0-9@$+|€§]+$")
#: What may follow a token's last look-alike.
_AFTER = ".,;:!?)]}\"'»“”’…"
#: Three or more single characters with something between them, of any length.
_SPACED = re.compile(rf"(?<![\w{re.escape(_LEET)}])(?:[\w{re.escape(_LEET)}][^\w{re.escape(_LEET)}]+){{2,}}[\w{re.escape(_LEET)}](?!\w)")
#: A single character that no other stands beside.
_SINGLE = re.compile(rf"(?<![\w{re.escape(_LEET)}])[\w{re.escape(_LEET)}](?![\w{re.escape(_LEET)}])")
_SOLID = re.compile(rf"[\w{re.escape(_LEET)}]")
_WORD = re.compile(rf"{_LETTER}+")
#: Tokens of which a worker remembers what is in them.
REMEMBERED = 60_000

# --- character model --------------------------------------------------------------------

#: Letters of the model: a-z and the small letters of Latin-1; all else is a break (fixed values).
ALPHABET = " abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
_K = len(ALPHABET)
_CODE = {c: i for i, c in enumerate(ALPHABET)}
_TABLE = np.array([_CODE.get(bytes([i]).decode("latin-1"), 0) for i in range(256)], dtype=np.int64)


def trigram_counts(texts: DataFrame, text: str = "text") -> np.ndarray:
    """How often each letter triple occurs in all texts (a table of fixed size)."""

    def count(batches):
        sums = np.zeros(_K**3, dtype=np.int64)
        for batch in batches:
            joined = f"  {'  '.join(t for t in batch.column(0).to_pylist() if t)}  ".lower().encode("latin-1", "replace")
            for at in range(0, len(joined) - 2, 400_000):
                codes = _TABLE[np.frombuffer(joined, dtype=np.uint8, offset=at, count=min(400_002, len(joined) - at))]
                sums += np.bincount((codes[:-2] * _K + codes[1:-1]) * _K + codes[2:], minlength=_K**3)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["triple", "n"])

    out = np.zeros(_K**3)
    rows = texts.select(F.col(f"`{text}`").cast("string")).mapInArrow(count, "triple long, n long")
    for r in rows.groupBy("triple").agg(F.sum("n").alias("n")).toLocalIterator():
        out[r["triple"]] = r["n"]
    return out.reshape(_K, _K, _K)


def trigram_costs(counts: np.ndarray) -> np.ndarray:
    """Negative log probability of a letter after two others: trigrams, bigrams and letters interpolated."""
    three, two, one = counts, counts.sum(axis=0), counts.sum(axis=(0, 1))
    one = (one + 1) / (one.sum() + _K)
    two = (two + 20 * one) / (two.sum(axis=1, keepdims=True) + 20)
    three = (three + 20 * two) / (three.sum(axis=2, keepdims=True) + 20)
    return -np.log(three)


class Decoder:
    """Viterbi decoding of one disguised stretch at a time, of any length."""

    def __init__(self, costs: np.ndarray):
        self.costs = costs

    def arcs(self, text: str) -> list[list[tuple[str, float]]]:
        """For each character, what it may stand for and at what cost."""
        out = []
        for i, c in enumerate(text):
            options: list[tuple[str, float]] = []
            if c in _CODE and c != " ":
                options.append((c, COST["self"] + (COST["double"] if i and text[i - 1] == c else 0.0)))
                if i and text[i - 1] == c:
                    options.append(("", COST["skip"]))
            elif c in LOOKALIKES:
                options += [(x, COST["lookalike"]) for x in LOOKALIKES[c]]
                options.append(("", COST["dropped"]))
                options.append((" ", COST["dropped"]))
            else:
                options.append(("", COST["skip"]))
                options.append((" ", COST["break"]))
            out.append(options)
        return out

    def decode(self, text: str) -> str:
        """The cheapest path; states are the last two letters written."""
        states: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
        for options in self.arcs(text):
            following: dict[tuple[int, int], tuple[float, tuple]] = {}
            for (a, b), (cost, path) in states.items():
                for out, channel in options:
                    if not out or (out == " " and b == 0):
                        key, total, way = (a, b), cost + channel, path
                    else:
                        c = _CODE[out]
                        key, total, way = (b, c), cost + channel + self.costs[a, b, c], (path, c)
                    old = following.get(key)
                    if old is None or total < old[0]:
                        following[key] = (total, way)
            states = following
        best = min(((cost + self.costs[a, b, 0], path) for (a, b), (cost, path) in states.items()), key=lambda x: x[0])[1]
        letters = []
        while best:
            best, c = best
            letters.append(ALPHABET[c])
        return "".join(reversed(letters)).strip()


class Reader:
    """What the tokens of texts say: ``of`` maps the words found in a token or stretch, plain and
    restored, to whatever is asked; it runs once for each token while that is remembered."""

    def __init__(self, costs: np.ndarray, of):
        self.decode = Decoder(costs).decode
        self.of = of
        self.known: dict[str, tuple] = {}

    def token(self, t: str) -> tuple:
        """(whether it may be part of a spaced stretch, what it says)."""
        words = set(_WORD.findall(t))
        bare = t.rstrip(_AFTER)
        if _ODD.search(t) or (bare != t and _ODD.search(bare)):
            words.update(_WORD.findall(self.decode(t)))
        single = len(_SINGLE.findall(t))
        part = single if single or _SOLID.search(t) else -1  # -1: nothing but what may stand between
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        found = self.known[t] = (part, self.of(words))
        return found

    def __call__(self, text: str) -> list:
        """What each token of a text says, and each of its spaced stretches; empty answers are left out."""
        out, known = [], self.known
        tokens = text.lower().split()
        begin = singles = 0
        for i, t in enumerate(tokens):
            part, says = known.get(t) or self.token(t)
            if says:
                out.append(says)
            if part:
                singles += max(part, 0)
            else:
                if singles > 2:
                    out += self.stretches(tokens[begin:i])
                begin, singles = i + 1, 0
        if singles > 2:
            out += self.stretches(tokens[begin:])
        return out

    def stretches(self, tokens: list[str]) -> list:
        found = (self.of(set(_WORD.findall(self.decode(m[0])))) for m in _SPACED.finditer(" ".join(tokens)))
        return [x for x in found if x]


def features(words: set[str]) -> set[str]:
    """Words, and the beginnings of longer ones: ``abc*`` if a word begins so, ``abc*2`` and so on
    if that many different words do."""
    out = set(words)
    for beginning, n in Counter(w[:n] for w in words for n in PREFIXES if len(w) > n).items():
        out.add(beginning + "*")
        for k in range(2, min(n, MOST_WORDS) + 1):
            out.add(f"{beginning}*{k}")
    return out


def strongest(words: set[str], lexicon: dict[str, float]) -> dict[str, str]:
    """By stem, the feature with the largest share; of equal ones the longest, then the first by name."""
    best: dict[str, tuple[float, int, str]] = {}
    for f in features(words):
        share = lexicon.get(f)
        if share is not None:
            stem = f[: PREFIXES[0]]
            best[stem] = min(best.get(stem, (0.0, 0, "")), (-share, -len(f), f))
    return {stem: f for stem, (_, _, f) in best.items()}


# --- lexicon ----------------------------------------------------------------------------


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic", fit_rows: int = FIT_ROWS) -> dict:
    """A model: costs (the character model, from all of ``docs``), lexicon and base.

    ``labels``: (id, label 0 or 1), the rows that may be learned from; null ids and labels are
    left out, an id that is labelled both ways counts once for each and equal texts count once.
    ``fit_rows`` bounds what is broadcast and, with it, the lexicon.
    """
    costs = trigram_costs(trigram_counts(docs, text))
    known = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label}`").cast("int").alias("y")).where("id is not null and y in (0, 1)").distinct()
    sample = known.orderBy(F.xxhash64("id"), "id", "y").limit(fit_rows)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text")).join(F.broadcast(sample), "id").select("y", "text")
    # a text that is copied many times is one piece of evidence
    rows = written(rows.dropDuplicates(["y", "text"]))
    shared = rows.sparkSession.sparkContext.broadcast(costs)

    def count(batches):
        read = Reader(shared.value, tuple)
        toxic, clean = Counter(), Counter()
        for batch in batches:
            for y, t in zip(batch.column(0), batch.column(1)):
                found = features({w for words in read(t.as_py() or "") for w in words})
                found.add("")
                (toxic if y.as_py() else clean).update(found)
            if len(toxic) + len(clean) > 60_000:
                yield _counted(toxic, clean)
                toxic, clean = Counter(), Counter()
        yield _counted(toxic, clean)

    sums = rows.mapInArrow(count, "feature string, toxic long, clean long").groupBy("feature")
    sums = written(sums.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    total = sums.where("feature = ''").first()
    nt, nc = (total["toxic"], total["clean"]) if total else (0, 0)
    if not nt:
        return {"costs": costs, "lexicon": {}, "base": 0.0}
    rate = min(nt / (nt + nc), 0.9) if nc else 0.5
    first = {r["feature"]: (r["share"], r["clean"]) for r in sums.where("feature != '' and toxic > 1").withColumn("share", _share(rate)).where(F.col("share") >= LEAST_SHARE).toLocalIterator()}
    model = {"costs": costs, "lexicon": {f: x for f, (x, _) in first.items()}, "base": rate * 0.1}
    candidates = rows.sparkSession.sparkContext.broadcast(model)

    def credit(batches):
        read = Reader(candidates.value["costs"], relevant(candidates.value["lexicon"]))
        toxic = Counter()
        for batch in batches:
            for t in batch.column(0):
                toxic.update(strongest({w for words in read(t.as_py() or "") for w in words}, candidates.value["lexicon"]).values())
        yield _counted(toxic, Counter())

    credited = rows.where("y = 1").select("text").mapInArrow(credit, "feature string, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("toxic"))
    credited = credited.where("toxic > 1").join(sums.select("feature", "clean"), "feature").withColumn("share", _share(rate)).where(F.col("share") >= LEAST_SHARE)
    return model | {"lexicon": {r["feature"]: r["share"] for r in credited.toLocalIterator()}}


def _share(rate: float) -> Column:
    """Share of toxic texts to expect where a feature is, from its counts: Laplace's, as far as it is a mark."""
    k, rest = F.col("toxic"), F.col("clean")
    odds = math.log(MARKS / (1 - MARKS)) + k * math.log(PURITY / rate) + rest * math.log((1 - PURITY) / (1 - rate))
    return (k + 1) / (k + rest + 2) / (1 + F.exp(-odds))


def _counted(toxic: Counter, clean: Counter) -> pa.RecordBatch:
    names = list(toxic.keys() | clean.keys())
    return pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string()), pa.array([toxic[n] for n in names], pa.int64()), pa.array([clean[n] for n in names], pa.int64())],
        names=["feature", "toxic", "clean"],
    )


def relevant(lexicon: dict[str, float]):
    """Of words, those that have a part in some feature of the lexicon."""
    beginnings = {f.split("*")[0] for f in lexicon if "*" in f}
    return lambda words: tuple(w for w in words if w in lexicon or any(w[:n] in beginnings for n in PREFIXES if len(w) > n))


def scorer(model: dict):
    """A function that scores texts between 0 and 1, the higher the likelier toxic."""
    lexicon = model["lexicon"]
    read = Reader(model["costs"], relevant(lexicon))

    def score(text: str | None) -> float:
        found = strongest({w for words in read(text or "") for w in words}, lexicon)
        return 1.0 - (1.0 - model["base"]) * math.prod(1.0 - lexicon[f] for f in found.values())

    return score


def scored(docs: DataFrame, model: dict, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a further double column ``name``, which must be new.  Null and empty texts get
    the base score; whole texts of any length are read; rows that repeat are scored alike."""
    if name.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"there is a column {name} already")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        score = scorer(shared.value)
        for texts in parts:
            yield pd.Series([score(t) for t in texts], dtype="float64")

    return docs.withColumn(name, of(F.col(f"`{text}`").cast("string")))

"""A training corpus from ``documents``: five stages, each one operator of the subpackage.

Every stage takes (spark, docs, sf_dir) and works on all rows the stage before has kept.
All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm import mixing, packing, registry, simhash, suffix, toxicity
from tidelake.llm.shared import new_name, written

#: The keys at which near copies meet are those of fingerprints within so many differing bits.
STAGE_BITS = 4
#: Similarity of the sets of five-word shingles from which on documents are near copies.
SIMILAR = 0.8


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score rejects go.  Null and empty texts have the base score
    and stay; rows that repeat are judged alike; columns of any name stay as they are."""
    model = registry.toxic_model(docs, registry.table(spark, sf_dir, "labels"))
    name = new_name(docs, "toxic")
    return toxicity.scored(docs, model, name=name).where(F.col(name) < toxicity.REJECT).drop(name)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest id (null ids
    last, of equal ids the first row).  Five words make a shingle; texts link at a Jaccard
    similarity of SIMILAR of their sets of shingles.  Texts that are null or have no words are one
    group; rows that repeat are near copies of each other."""
    return simhash.keep_one(docs, max_bits=STAGE_BITS, shingle=5, similar=SIMILAR)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose each passage of over 50 words that also stands elsewhere; n_chars follows.
    Every row stays, also one whose whole text repeats; null texts stay null."""
    out = suffix.cleaned(docs, shape=suffix.PASSAGES)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it: a null source is a source of its
    own, null and empty texts of a source are taken at its rate, ties go by the ids' hashes."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Chunks in length buckets and batches; null and empty texts take one chunk of length 0."""
    return packing.packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: The stages of toxicity, fingerprints and suffixes have no equal in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows written before the next reads them."""
    docs = registry.table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

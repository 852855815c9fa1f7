"""The corpus pipeline: five stages, each one operator over all its predecessor kept."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from resultlake.llm import language, mixture, packing, pii, set_join
from resultlake.llm.common import col, fresh, numbered_rows, ship
from resultlake.session import stage

# Near copies of the pipeline: word shingles and percent of their union in common.
WORDS, PERCENT = 5, 80


def shipped(function):
    """A stage whose executors get the package first."""

    @wraps(function)
    def stage_of(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        return function(spark, docs, sf_dir)

    return stage_of


@shipped
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; texts without a letter, or without any gram of a
    learned language, go."""
    name = fresh(docs, "language")
    found = language.identify(docs, name=name)
    kept = found.where(language.accepted(F.col(name)))
    return kept.select(*(col(c) for c in docs.columns))


@shipped
def join_ngrams(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id's, of each group of near copies."""
    return set_join.survivors(docs, WORDS, PERCENT)


@shipped
def sanitise_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data and what reveals it taken out."""
    name = fresh(docs, "pii")
    found, text = pii.sanitise(docs, name=name), F.col(f"{name}.text")
    changed = {"text": text, "n_chars": F.length(text).cast("long")}
    return found.select(*(changed[c].alias(c) if c in changed else col(c) for c in docs.columns))


@shipped
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    uid, taken_uid, taken_copy = (fresh(docs, n) for n in ("uid", "taken_uid", "taken_copy"))
    rows = numbered_rows(docs, uid, "mixture-input")
    size = mixture.word_count(F.col("text")).alias("size")
    mixed = mixture.mix(rows.select(F.col(uid).alias("uid"), "doc_id", "source", size))
    each = F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias(taken_copy)
    copies = mixed.where("copies > 0").select(F.col("uid").alias(taken_uid), each)
    taken = rows.join(copies, F.col(uid) == F.col(taken_uid))
    return taken.select(*(col(c) for c in docs.columns))


@shipped
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in the sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", join_ngrams),
    ("PII", sanitise_text),
    ("source mixture", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: Language filters, shingle sets and token ids have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)

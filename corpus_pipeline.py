"""A corpus pipeline of five stages; each reads what the one before has written.

Every stage takes (spark, docs, sf_dir).  All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import ready
from tidewatch.llm import language, minhash, mixing, pieces, substrings
from tidewatch.llm._store import written


#: Columns of documents that stages read or write; all others are taken aside, whatever their names.
OWN = ("doc_id", "text", "lang", "source", "n_chars")


def _aside(docs: DataFrame, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``step`` of documents, with the columns of documents: those that are no stage's business come back as they were, so that
    no name of theirs clashes with one that a step takes for itself."""
    names = [c if c in OWN else f"_aside_{i}" for i, c in enumerate(docs.columns)]
    return step(docs.toDF(*names)).select(names).toDF(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which no language can be told (no text, or no letter in it); a missing label is filled in."""

    def step(docs: DataFrame) -> DataFrame:
        out = language.language_id(docs).where(F.col("lang_pred") != "und")
        return out.withColumn("lang", F.coalesce("lang", "lang_pred"))

    return _aside(docs, step)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates."""
    return _aside(docs, minhash.deduplicated)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that an earlier document has out of the texts; every document stays."""
    return _aside(docs, substrings.without_passages)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents of small sources, with at most 1.25 passes over a source; every document stays at least once."""
    return _aside(docs, lambda docs: mixing.mixture(docs, entropy=1.0, repeats=1.25, cover=True))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every text with their byte spans, and whether decoding gives the text back."""
    rows = pieces.encode(docs.select("doc_id", "lang", "source", "text"), pieces.model_path(), decoded=True)
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit(""))
    return rows.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "begins", "ends", same.alias("round_trip"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("source_mixing", source_mixing),
    ("sentencepiece", tokenize),
]

#: Suffix automata, Poisson arrivals, gear hashes and merges of pieces are beyond SQL: tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; what a stage returns is written and read again for the next."""
    docs = ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

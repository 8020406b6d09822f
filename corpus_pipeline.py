"""The corpus pipeline: documents in, packed training sequences out.

Each stage works on all that the one before kept, and learns and counts on its own input. All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm import langid, minhash, packing, quality, substrings
from tidewright.llm.common import stored, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts as good."""
    docs = docs.select(*COLUMNS)
    return quality.accepted(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the filters know."""
    docs = docs.select(*COLUMNS)
    return langid.accepted(docs, langid.learn(langid.split(docs).where(~F.col("held_out"))))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the least doc_id."""
    return minhash.one_of_each(docs.select(*COLUMNS))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 50-word passages that an earlier document has."""
    return substrings.cleaned(docs.select(*COLUMNS))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 ids."""
    return packing.best_fit(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("language ID", keep_languages),
    ("n-gram Jaccard join", one_of_near_copies),
    ("substring dedup", without_repeats),
    ("best-fit packing", packed),
]
#: Learned stages, stages over substrings and a tokenizer can't be put in SQL; tests hold run() against
#: brute-force versions of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn. Every stage's result but the last is written to the shared folder and read again,
    so stages are planned on what is there and a lost executor costs no more than a stage."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage{k}")
    return docs

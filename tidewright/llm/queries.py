"""The queries opN_<name> over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewright.llm import bytebpe, fingerprints, langid, lm, media, minhash, packing, quality, substrings, suffixes
from tidewright.llm.common import table


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.join(table(spark, sf_dir, "documents"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytebpe.round_trip(table(spark, sf_dir, "documents"))


def op3_substring_rlz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), with_text=False)


def op4_media_avi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_digests(table(spark, sf_dir, "documents"))


def op5_suffix_refinement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"), with_text=False)


def op6_lm_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit(table(spark, sf_dir, "documents"))


def op8_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_locally_consistent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_edits(table(spark, sf_dir, "documents"))


def op10_langid_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.detect(table(spark, sf_dir, "documents")).drop("known_share")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_ngram_jaccard, op2_byte_bpe, op3_substring_rlz, op4_media_avi, op5_suffix_refinement, op6_lm_attention, op7_best_fit_packing, op8_quality_fm, op9_locally_consistent, op10_langid_filters)
}
ORACLE_SQL: dict[str, str] = {}

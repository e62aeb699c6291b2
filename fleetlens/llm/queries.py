"""Registered queries of this package: ``name -> (spark, sf_dir) -> DataFrame``
and, where SQL can express them, their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fim, langid, lmscore, mixing, ngramjoin, ordermin, passages, quality, simhash, spm, toxicity, warc, whiten
from .common import fold, table
from .oracle import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]


def op1_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    return spm.encode_documents(table(spark, sf, "documents"))


def op2_simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents"))


def op3_language_id(spark: SparkSession, sf: str) -> DataFrame:
    held_out = F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False))
    return langid.identify(table(spark, sf, "documents"), held_out)


def op4_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_digest(table(spark, sf, "documents"))


def op5_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    held_out = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    return toxicity.detect(table(spark, sf, "documents"), table(spark, sf, "labels"), held_out)


def op6_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return passages.passage_rows(table(spark, sf, "documents"))


def op7_order_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return ordermin.edited_neighbours(table(spark, sf, "documents"))


def op8_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc.round_trip(table(spark, sf, "pages"))


def op9_source_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.taken_words(table(spark, sf, "documents"))


def op10_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    return lmscore.cross_entropy_difference(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op11_ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return ngramjoin.jaccard_classes(table(spark, sf, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    return fim.fill_in_middle_digest(table(spark, sf, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whiten.whitened_rows(table(spark, sf, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_language_id": op3_language_id,
    "op4_quality_rules": op4_quality_rules,
    "op5_toxicity": op5_toxicity,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_order_minhash": op7_order_minhash,
    "op8_warc": op8_warc,
    "op9_source_mixing": op9_source_mixing,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_ngram_jaccard": op11_ngram_jaccard,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_embedding_whitening": op13_embedding_whitening,
}

"""A training-data pipeline over ``documents``.

Toxic documents go, one document of each near-duplicate group stays, repeated
passages are cut out, sources are mixed to their target weights, and what is
left is encoded. Each stage is one operator of ``fleetlens.llm``; ``run``
writes each stage's rows to the shared folder and reads them back for the next.

Rows: null and empty texts, null and repeated ids and repeated rows are taken
as each operator says; extra columns pass through all but the last stage,
whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm import mixing, passages, simhash, spm, toxicity
from fleetlens.llm.common import fold, fresh, pick, shrink_heaps, table, written

TOXIC_FROM = 0.3  # score from which a document is rejected


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under ``TOXIC_FROM``; labels of the held-out fold are
    not learnt from."""
    labels = pick(table(spark, sf_dir, "labels"), doc_id="doc_id", toxic="toxic")
    model = toxicity.train(
        pick(docs, doc_id="doc_id", text="text"), labels.filter(fold(F.col("doc_id"), 4) != 2)
    )
    name = fresh(docs, "_toxicity")
    scored = toxicity.score(docs, model, docs.columns, name)
    return scored.filter(F.col(name) < TOXIC_FROM).drop(name)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return passages.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return spm.encode_documents(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def rested(stage: Stage) -> Stage:
    """``stage`` on executors that have given back the heap of the stage before."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        shrink_heaps(spark)
        return stage(spark, docs, sf_dir)

    return run


STAGES = [
    ("toxicity", rested(drop_toxic)),
    ("simhash_near_dedup", rested(drop_near_duplicates)),
    ("substring_dedup", rested(cut_repeated_passages)),
    ("source_mixing", rested(mix_sources)),
    ("sentencepiece", rested(encode)),
]

ORACLE_SQL = None  # hashing, label models and tokenizers: tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, name)
    return docs

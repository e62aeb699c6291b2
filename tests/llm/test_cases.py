"""Nulls, empty and very long texts, ties, repeated rows, empty tables and
clashing column names, for every operator and stage."""

from __future__ import annotations

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from common_cases import awkward, awkward_rows, empty, prose
from pyspark.sql import functions as F

from fleetlens.llm import langid, lmscore, mixing, ordermin, passages, quality, simhash, spm, toxicity, warc
from fleetlens.llm.common import fold

N = len(awkward_rows())


def labels(spark, rows=((1, 1, 0), (2, 0, 1), (4, None, None), (None, 1, 1), (101, 1, 1), (102, 1, 0), (103, 0, 0))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


OPERATORS = {
    "op1": lambda s, d: spm.encode_documents(d),
    "op2": lambda s, d: simhash.near_duplicates(d),
    "op3": lambda s, d: langid.identify(d, F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False))),
    "op4": lambda s, d: quality.quality_digest(d),
    "op5": lambda s, d: toxicity.detect(d, labels(s), F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))),
    "op7": lambda s, d: ordermin.edited_neighbours(d),
    "op9": lambda s, d: mixing.taken_words(d),
    "op10": lambda s, d: lmscore.cross_entropy_difference(d, labels(s)),
}


@pytest.mark.parametrize("op", sorted(OPERATORS))
def test_one_row_per_input_row(spark, op):
    got = OPERATORS[op](spark, awkward(spark)).select("doc_id").collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in awkward_rows())


@pytest.mark.parametrize("op", sorted(OPERATORS))
def test_empty_table(spark, op):
    assert OPERATORS[op](spark, empty(spark)).count() == 0


def test_substring_dedup_cases(spark):
    df = awkward(spark)
    found = passages.passage_rows(df).collect()
    assert {r.doc_id for r in found} == {1, 2}  # the copy, and no clean document
    out = passages.without_repeats(df)
    assert out.columns == df.columns and out.count() == N
    assert passages.passage_rows(empty(spark)).count() == 0
    assert passages.without_repeats(empty(spark)).count() == 0


def test_keep_one_cases(spark):
    df = awkward(spark)
    out = simhash.keep_one(df)
    assert out.columns == df.columns
    ids = [r.doc_id for r in out.select("doc_id").collect()]
    assert ids.count(1) == 1 and all(i in ids for i in range(100, 130))
    assert simhash.keep_one(empty(spark)).count() == 0


def test_keep_one_takes_unlinked_rows_for_different_documents(spark):
    rng = random.Random(8)
    a, b, c, d, e = (prose(rng, 60) for _ in range(5))
    rows = [(None, a), (None, b), (7, c), (7, d), (None, e), (9, e), (8, e)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in simhash.keep_one(df).collect()), key=str)
    assert got == sorted([(None, a), (None, b), (7, c), (7, d), (8, e)], key=str)


def test_mixed_documents_cases(spark):
    df = awkward(spark)
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    words = sum(len((r.text or "").split()) for r in out.select("text").collect())
    taken = mixing.taken_words(df).agg(F.sum("taken")).first()[0]
    assert words == taken > 0
    assert mixing.mixed_documents(empty(spark)).count() == 0


def test_warc_cases(spark):
    rows = [(1, "u", "same"), (2, None, "same"), (3, "a b\r\nc", ""), (4, "x", None), (None, None, "same"), (5, "ü", "ü" * 9), (5, "ü", "ü" * 9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS path", "2 AS _sha1")
    got = {(r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.round_trip(pages).collect()}
    assert got == {
        (2, "response", None, 4), (1, "revisit", 2, 4), (None, "revisit", 2, 4),
        (4, "response", None, 0), (3, "revisit", 4, 0), (5, "response", None, 18),
    }
    assert warc.round_trip(pages).count() == len(rows)
    assert warc.round_trip(pages.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["toxicity", "simhash_near_dedup", "substring_dedup", "source_mixing", "sentencepiece"])
def test_pipeline_stage_cases(spark, tmp_path, name):
    import corpus_pipeline

    labels(spark).write.parquet(str(tmp_path / "labels.parquet"))
    stage = dict(corpus_pipeline.STAGES)[name]
    df = awkward(spark)
    out = stage(spark, df, str(tmp_path))
    assert out.count() > 0
    if name != "sentencepiece":
        assert out.columns == df.columns
    assert stage(spark, empty(spark), str(tmp_path)).count() == 0

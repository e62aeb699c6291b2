"""Contracts of queries and stages: clashing internal names, null folds, whole
text parity, and the mix recomputed row by row."""

from __future__ import annotations

import os
import re
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from common_cases import awkward, awkward_rows

from fleetlens.llm import mixing, spm
from fleetlens.llm import queries as q
from fleetlens.llm.common import bit_filter, fresh, in_filter, table

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
INTERNAL = ["_simhash", "_stay_id", "_stay_fp", "_dk", "_cuts", "_nth", "_spans", "_pass", "_toxicity"]


def labels(spark):
    rows = [(1, 1, 0), (2, 0, 1), (4, None, None), (None, 1, 1), (101, 1, 1), (102, 1, 0), (103, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("name", ["toxicity", "simhash_near_dedup", "substring_dedup", "source_mixing"])
def test_stages_take_columns_with_internal_names(spark, tmp_path, name):
    import corpus_pipeline

    labels(spark).write.parquet(str(tmp_path / "labels.parquet"))
    stage = dict(corpus_pipeline.STAGES)[name]
    plain = awkward(spark, extra=False)
    marked = plain.select("*", *[F.lit(f"kept {c}").alias(c) for c in INTERNAL])
    out = stage(spark, marked, str(tmp_path))
    assert out.columns == marked.columns
    rows = out.collect()
    assert rows and all(r[c] == f"kept {c}" for r in rows for c in INTERNAL)
    want = sorted(map(str, (tuple(r) for r in stage(spark, plain, str(tmp_path)).collect())))
    assert sorted(str(tuple(r)[: len(plain.columns)]) for r in rows) == want


def test_fresh_names_ignore_case(spark):
    df = spark.createDataFrame([(1, 2)], "_DK long, _dk_ long")
    assert fresh(df, "_dk") == "_dk__" and fresh(df, "other") == "other"


def test_held_out_is_never_null(spark, tmp_path):
    awkward(spark, extra=False).write.parquet(str(tmp_path / "documents.parquet"))
    labels(spark).write.parquet(str(tmp_path / "labels.parquet"))
    for query in (q.op3_language_id, q.op5_toxicity):
        rows = query(spark, str(tmp_path)).select("doc_id", "held_out").collect()
        assert len(rows) == len(awkward_rows())
        assert all(isinstance(r.held_out, bool) for r in rows)
        assert not any(r.held_out for r in rows if r.doc_id is None)


def test_whole_texts_agree_with_sentencepiece():
    """``parity`` compares learnt words; here every text of sf0.01 is encoded
    as a whole by SentencePiece."""
    import pyarrow.parquet as pq
    import sentencepiece

    model = open(spm.DEFAULT_MODEL, "rb").read()
    exact = sentencepiece.SentencePieceProcessor(model_proto=model)
    codec = spm.Codec(model, exact=exact)
    texts = [t or "" for t in pq.read_table(f"{MEDIUM}/documents.parquet")["text"].to_pylist()]
    texts += ["  two  spaces ", "▁marker ▁▁ in text", "\ttab\n", "日本 🤔", "a" * 500, "", " "]
    for at in range(0, len(texts), 100):
        part = texts[at : at + 100]
        assert [x.tolist() for x in codec.encode(part)] == exact.encode(part)
        assert codec.agrees(part) == [True] * len(part)


def test_parity_is_a_real_comparison():
    """A processor that differs on one word is noticed, in its texts alone."""
    import sentencepiece

    model = open(spm.DEFAULT_MODEL, "rb").read()
    true = sentencepiece.SentencePieceProcessor(model_proto=model)

    class Other:
        @staticmethod
        def encode(text, num_threads=1):
            ids = true.encode(text)
            return ids[::-1] + [5] if text == "odd" else ids

    codec = spm.Codec(model, exact=Other)
    texts = ["an odd word", "no such word", "odd", "  odd", "", "oddly"]
    codec.encode(texts)
    assert codec.agrees(texts) == [False, True, False, True, True, True]


def test_words_are_compared_in_batches(monkeypatch):
    """SentencePiece is called a few times for each batch of rows, not once for
    each word, and a word that it encodes otherwise is still noticed."""
    from types import SimpleNamespace

    import pyarrow as pa
    import sentencepiece

    model = open(spm.DEFAULT_MODEL, "rb").read()
    true, calls = sentencepiece.SentencePieceProcessor(model_proto=model), []

    class Counted:
        def __init__(self, model_proto):
            assert model_proto == model

        def encode(self, text, num_threads=1):
            calls.append(text)
            change = lambda t, ids: ids[::-1] + [5] if t == "w77x" else ids
            return change(text, true.encode(text)) if isinstance(text, str) else [*map(change, text, true.encode(text))]

    monkeypatch.setattr(sentencepiece, "SentencePieceProcessor", Counted)
    texts = [" ".join(f"w{i}{x}" for x in ("x", ".\nThe", "日🤔", "")) for i in range(200)]
    texts += ["", None, " ", "a ", " a  b ", "▁ ▁▁m", "long" * 300 + " w3x", "long" * 300, "\ttab\n", "ü\0 <s> <0x41>"]
    rows = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts)})
    out = pa.Table.from_batches([*spm._coded(SimpleNamespace(value=model), True)(iter([rows, rows]))]).to_pylist()
    assert len(calls) < 20
    for row, text in zip(out, texts * 2, strict=True):
        assert row["token_ids"] == (None if text is None else true.encode(text))
        assert row["parity"] is (None if text is None else "w77x" not in text)


def test_unigram_words_compared_in_batches_or_one_by_one():
    """The same ids and verdicts; long words are forgotten after their batch."""
    import sentencepiece
    from test_operators import unigram_model

    model = unigram_model()
    exact = sentencepiece.SentencePieceProcessor(model_proto=model)
    one, many = spm.Codec(model, exact=exact), spm.Codec(model, exact=exact, exact_batch=exact.encode)
    texts = ["", "a", " a", "日本 a", "a 🤔", "ab  ba", "▁", "x" * 500 + " a"]
    for _ in range(2):
        got = [x.tolist() for x in many.encode(texts)]
        assert got == [x.tolist() for x in one.encode(texts)]
        assert many.wrong == one.wrong and many.agrees(texts) == one.agrees(texts)
    assert not any(len(w) > many.long_word for w in [*many.memo, *many.after_space])


def test_models_with_other_markers_are_refused():
    from test_operators import field, unigram_model

    with pytest.raises(ValueError):
        spm.Codec(unigram_model() + field(2, field(3, 1) + field(35, 1) + field(24, 1)))
    with pytest.raises(ValueError):
        spm.Codec(unigram_model() + field(1, field(1, "own".encode()) + field(2, -1.0) + field(3, 4)))


def test_taken_words_equal_a_row_by_row_mix(spark):
    """Documents laid end to end by source and id, every drawn slot applied."""
    p = mixing.Params(slots_per_shard=64, block=16)
    docs = table(spark, SMALL, "documents")
    sized = mixing._sized(docs)
    pl = mixing.plan(sized, p)
    slots = [(r.src, r.block) for r in mixing.draws(spark, pl, p).collect()]
    assert len(slots) == pl.total_slots and len({r[0] for r in slots}) == len(pl.names)
    rows = sorted(docs.select("doc_id", "text", "source").collect(), key=lambda r: r.doc_id)
    taken, start, ids = {}, dict.fromkeys(pl.names, 0), {}
    for r in rows:
        n = len(WORD.findall(r.text or ""))
        ids.setdefault(r.source, []).append((start[r.source], n, r.doc_id))
        start[r.source] += n
        taken[r.doc_id] = 0
    assert [start[s] for s in pl.names] == pl.sizes
    for src, block in slots:
        lo, hi = block * p.block, (block + 1) * p.block
        for at, n, doc_id in ids[pl.names[src]]:
            taken[doc_id] += max(0, min(hi, at + n) - max(lo, at))
    got = {r.doc_id: r for r in mixing.taken_words(docs, p).collect()}
    assert {k: r.taken for k, r in got.items()} == taken
    assert all(r.taken <= 2 * r["size"] for r in got.values())


@pytest.mark.parametrize("case", [(50, 70, 40), (5, 1000, 30), (3000, 2000, 1500), (10**6, 3 * 10**6, 10**5), (900, 10, 500)])
def test_large_draws_follow_the_same_law(case):
    rng = np.random.default_rng(1)
    ours = np.array([mixing.drawn(*case, rng, largest=0) for _ in range(5000)])
    theirs = rng.hypergeometric(*case, 5000)
    bins = np.append(np.unique(np.quantile(theirs, np.linspace(0, 1, 12))), np.inf)
    a, b = np.histogram(ours, bins)[0], np.histogram(theirs, bins)[0]
    assert ((a - b) ** 2 / np.maximum(a + b, 1)).sum() < 40
    assert max(0, case[2] - case[1]) <= ours.min() and ours.max() <= min(case[0], case[2])


def test_draws_beyond_the_sampler():
    rng = np.random.default_rng(3)
    counts = np.array([3 * 10**11, 6 * 10**11, 10**11])
    out = np.array([mixing.split_counts(counts, 2 * 10**11, rng) for _ in range(300)])
    assert (out.sum(axis=1) == 2 * 10**11).all()
    mean, sd = counts * 0.2, np.sqrt(2e11 * (counts / 1e12) * (1 - counts / 1e12) * 0.8)
    assert (np.abs(out.mean(axis=0) - mean) < 6 * sd / 300**0.5).all()
    assert (np.abs(out.std(axis=0) / sd - 1) < 0.2).all()


def test_bit_filter_has_no_false_negatives(spark):
    keys = spark.range(5000).selectExpr("xxhash64(id) AS key")
    words = np.frombuffer(bit_filter(keys, 18), np.uint64)
    own = np.array([r.key for r in keys.collect()], np.int64).view(np.uint64)
    assert in_filter(words, own, 18).all()
    other = np.random.default_rng(1).integers(0, 1 << 63, 20000).astype(np.uint64)
    assert in_filter(words, other, 18).mean() < 0.01
    assert not in_filter(np.frombuffer(bit_filter(keys.limit(0), 18), np.uint64), own, 18).any()

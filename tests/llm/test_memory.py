"""What Python workers hold between tasks."""

from __future__ import annotations

import random

import corpus_pipeline
import psutil

from fleetlens.llm import lmscore
from fleetlens.llm.common import frugal, written


def test_tasks_give_their_memory_back():
    pins = []

    def hold(batches):
        blocks = []
        for i in range(40_000):
            blocks.append(bytearray(5_000))
            if i % 400 == 399:  # small blocks that stay, so the heap cannot shrink from its end
                pins.append(bytearray(2_000))
        yield from batches

    rss = lambda: psutil.Process().memory_info().rss / 1e6
    before = rss()
    for _ in hold(iter([1])):
        pass
    kept = rss() - before
    assert list(frugal(hold)(iter([1, 2]))) == [1, 2]
    assert kept > 100 and rss() - before < 60


def test_language_model_exchanges_packed_rows(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{rng.randrange(5_000)}" for _ in range(400))) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(0, 100, 3)], "doc_id long, quality int")
    tables = []

    def kept(df, name):
        tables.append(written(df, name))
        return tables[-1]

    monkeypatch.setattr(lmscore, "written", kept)
    monkeypatch.setattr(lmscore, "BUCKET", 10_000)
    got = lmscore.cross_entropy_difference(docs, labels, lmscore.Params(chunk=9_000)).collect()
    assert sorted(r.doc_id for r in got) == list(range(100)) and {r.n_tokens for r in got} == {400}
    assert sum(t.count() for t in tables) < 200  # of 40,000 words and about as many bigrams: no row for each


def test_stages_begin_with_a_collected_heap(spark):
    docs = spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    beans = spark.sparkContext._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    full = lambda: sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())
    before = full()
    out = dict(corpus_pipeline.STAGES)["sentencepiece"](spark, docs, "")
    assert full() > before  # here the driver is the executor
    assert [r.round_trip for r in out.collect()] == [True]

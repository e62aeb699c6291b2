"""Fill-in-middle: against SQL, against a plain cut with ``re``, round trip."""

from __future__ import annotations

import os
import random
import re
import sys

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from common_cases import awkward, awkward_rows, empty

import __spark_entry__ as ep
from compare import duck_frame, same
from fleetlens.llm import fim

SMALL = "/root/testdata/sf0.001"
UNIT = re.compile(r"[^\n]*\n|[^\n]+")


def plain_cut(doc_id, text, p=fim.Params()):
    text = text or ""
    units = UNIT.findall(text)
    h1, h2, h3, h4 = fim.draws(doc_id, p.seed)
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    parts = ["".join(x) for x in (units[:a], units[a:b], units[b:])]
    marks = (p.prefix, p.suffix, p.middle)
    if not text or any(m in text for m in marks) or h3 % 100 >= p.rate:
        return len(units), "plain", None, None, text, text
    form = "spm" if h4 % 100 < p.spm else "psm"
    pre, mid, suf = parts
    out = f"<P>{pre}<S>{suf}<M>{mid}" if form == "psm" else f"<S>{suf}<P>{pre}<M>{mid}"
    return len(units), form, len(pre), len(mid), out, text


def run_batch(rows, p=fim.Params()):
    batch = pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], names=["doc_id", "text"]
    )
    return next(fim._transformed(p)(iter([batch]))).to_pylist()


def test_rows_equal_a_plain_cut():
    rng = random.Random(3)
    letters = ["a", "é", "日", "\U0001f600", "\n", "\n", "\r", " ", "<P", "<", ">", "\x0b", "\x7f", "\x00"]
    rows = [(i - 50, "".join(rng.choice(letters) for _ in range(rng.randrange(0, 60)))) for i in range(3000)]
    rows += [(9001, None), (9002, ""), (9003, "\n"), (9004, "\n" * 5000), (9005, "x" * 70_000), (None, "a\nb"), (9006, "x<M>\n")]
    for p in (fim.Params(), fim.Params(rate=40, spm=0), fim.Params(seed=8, spm=100)):
        for (doc_id, text), got in zip(rows, run_batch(rows, p)):
            assert tuple(got.values())[1:] == plain_cut(doc_id, text, p)


def test_batches_that_are_slices():
    texts = pa.array(["aa\nb", None, "", "ü\nü\n", "c"], pa.string())
    for a in range(5):
        part = texts.slice(a)
        raw, ends = fim._bytes_of(part)
        assert [raw[x:y].tobytes().decode() for x, y in zip(ends[:-1], ends[1:])] == [t or "" for t in part.to_pylist()]


def test_rank_and_select_agree_with_single_bytes():
    rng = np.random.default_rng(5)
    raw = rng.choice(np.array([10, 11, 138, 0, 255, 9], np.uint8), 8 * 500)
    m = fim.Marks(fim.line_ends(raw.view("<u8")))
    at = np.flatnonzero(raw == 10)
    assert (m.select(np.arange(1, len(at) + 1)) == at).all()
    ends = np.arange(len(raw))
    assert (m.rank(ends) == np.concatenate([[0], np.cumsum(raw == 10)])[:-1]).all()


def test_text_of_sentinel_halves_is_restored():
    p = fim.Params()
    for form in ("psm", "spm"):
        for pre, mid, suf in (("<", "S>", "<P"), ("<S", "<M", "M>"), ("", "", "<"), ("<<", ">", "")):
            parts = [x.encode() for x in (pre, mid, suf)]
            assert fim.restore(fim.arrange(form, *parts, p), form) == b"".join([parts[0], parts[1], parts[2]])


def test_output_without_sentinel_is_refused():
    with pytest.raises(ValueError):
        fim.restore(b"abc", "psm")


def test_awkward_rows(spark):
    got = fim.fill_in_middle(awkward(spark)).collect()
    want = sorted(((r[0], *plain_cut(r[0], r[1])) for r in awkward_rows()), key=str)
    assert sorted(map(tuple, got), key=str) == want
    assert fim.fill_in_middle_digest(empty(spark)).count() == 0


def test_query_matches_sql(spark, duck):
    duck.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet('{SMALL}/documents.parquet')")
    got = ep.queries()["op12_fill_in_middle"](spark, SMALL).toPandas()
    ok, why = same(got, duck_frame(duck, ep.oracle_sql()["op12_fill_in_middle"]))
    assert ok, why

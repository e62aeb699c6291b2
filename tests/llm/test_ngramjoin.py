"""N-gram Jaccard join against all pairs."""

from __future__ import annotations

import os
import random
import re
import sys
from itertools import combinations

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from common_cases import awkward, awkward_rows, empty, prose

import __spark_entry__ as ep
from fleetlens.llm import ngramjoin as nj

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Small tables: most of the time would go to empty tasks."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def plain_set(text, k=3):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def plain_classes(rows, percent=90):
    """Brute force: sorted (doc_id, n_shingles, component_id)."""
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        x, y = sets[i], sets[j]
        if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
            both = len(x & y)
            if 100 * both >= percent * (len(x) + len(y) - both):
                root[find(j)] = find(i)
    lows = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            lows[find(i)] = min(d, lows.get(find(i), d))
    return sorted(((d, len(s), lows.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def classes(spark, rows, p=nj.Params()):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((tuple(r) for r in nj.jaccard_classes(df, p).collect()), key=str)


def copies(rng, base, n, changes):
    words = base.split()
    out = []
    for _ in range(n):
        w = list(words)
        for _ in range(rng.randrange(changes + 1)):
            at = rng.randrange(len(w))
            if rng.random() < 0.3:
                del w[at]
            else:
                w[at] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def family(seed, n_bases, n_copies, sizes, changes):
    rng = random.Random(seed)
    texts = []
    for _ in range(n_bases):
        base = prose(rng, rng.choice(sizes))
        texts += [base, *copies(rng, base, n_copies, changes)]
    texts += ["", None, "One", "one", "one two", "ONE TWO", "one two three"]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_query_equals_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in ep.queries()["op11_ngram_jaccard"](spark, SMALL).collect()), key=str)
    assert got == plain_classes(rows)


def test_short_sets_near_the_threshold(spark):
    """Sizes at which one shingle decides: 8 to 22."""
    rows = family(1, 60, 6, range(8, 25), 2)
    assert classes(spark, rows) == plain_classes(rows)


def test_longer_near_copies(spark):
    rows = family(2, 10, 25, [60, 120, 300, 700], 9)
    assert classes(spark, rows) == plain_classes(rows)


@pytest.mark.parametrize("block", [2, 7])
def test_hot_buckets_are_cut_into_tiles(spark, block):
    """One family whose copies mostly link through others: many pairs fail, so
    the second round decides, too."""
    rows = family(3, 1, 110, [90], 5)
    assert classes(spark, rows, nj.Params(block=block)) == plain_classes(rows)


def test_other_threshold(spark):
    rows = family(4, 12, 12, [20, 50, 90], 6)
    assert classes(spark, rows, nj.Params(percent=70)) == plain_classes(rows, 70)


def test_awkward_rows(spark):
    want = plain_classes([(r[0], r[1]) for r in awkward_rows()])
    assert sorted((tuple(r) for r in nj.jaccard_classes(awkward(spark)).collect()), key=str) == want
    assert nj.jaccard_classes(empty(spark)).count() == 0
    assert nj.jaccard_classes(empty(spark)).columns == ["doc_id", "n_shingles", "component_id"]


def random_sets(seed, n, size):
    rng = np.random.default_rng(seed)
    x = rng.integers(1, 1 << 63, size=size + 200).astype(np.uint64)
    return [np.sort(rng.choice(x, size=int(rng.integers(max(1, int(size * 0.85)), size + 1)), replace=False)) for _ in range(n)]


@pytest.mark.parametrize("size", [10, 19, 30, 77, 400, 3000])
def test_linked_sets_share_a_bucket(size):
    """Any two sets at or over the threshold have a key in common, and their
    bitmaps pass the bound in every band they share."""
    p, bands = nj.Params(), nj.Bands(nj.Params())
    rng = np.random.default_rng(size)
    for _ in range(60 if size < 100 else 6):
        x = np.unique(rng.integers(1, 1 << 63, size=size).astype(np.uint64))
        y = x.copy()
        while True:  # as far apart as the threshold allows
            z = y.copy()
            if rng.random() < 0.5:
                z = np.delete(z, rng.integers(len(z)))
            else:
                z = np.unique(np.append(z, rng.integers(1, 1 << 63, size=1).astype(np.uint64)))
            both = len(np.intersect1d(x, z))
            if 100 * both < p.percent * (len(x) + len(z) - both):
                break
            y = z
        if len(x) == len(y) and (x == y).all():
            continue
        keys = []
        for s in (x, y):
            keys.append({int(k) for key, _, _ in nj.bucket_keys(s, np.array([len(s)]), bands, p) for k in key})
        assert keys[0] & keys[1]
        differ = len(x) + len(y) - 2 * len(np.intersect1d(x, y))
        for words in {int(w) for w in bands.words}:
            seen = int(np.bitwise_count(nj.bitmap(x, words) ^ nj.bitmap(y, words)).sum())
            assert seen <= differ and nj._passes(seen, len(x), len(y), p.percent)


def test_batched_keys_equal_single_ones():
    p, bands = nj.Params(weak=3), nj.Bands(nj.Params())
    sets = [s for size in (9, 14, 40, 200) for s in random_sets(size, 12, size)]
    sizes = np.array([len(s) for s in sets])
    together = {}
    for key, row, band in nj.bucket_keys(np.concatenate(sets), sizes, bands, p):
        for k, r, b in zip(key.tolist(), row.tolist(), band.tolist()):
            together.setdefault(r, []).append((k, b))
    for i, s in enumerate(sets):
        single = [(k, b) for key, _, band in nj.bucket_keys(s, sizes[i : i + 1], bands, p) for k, b in zip(key.tolist(), band.tolist())]
        assert sorted(single) == sorted(together.get(i, []))


def test_forest_spans_the_passing_pairs():
    rng = np.random.default_rng(6)
    sets = random_sets(6, 60, 40) + random_sets(7, 60, 40)
    sid = [int(x) for x in rng.permutation(len(sets))]
    bits = [nj.bitmap(s, 4).tobytes() for s in sets]
    n = [len(s) for s in sets]
    near = {
        (min(sid[i], sid[j]), max(sid[i], sid[j]))
        for i, j in combinations(range(len(sets)), 2)
        if nj._passes((int.from_bytes(bits[i]) ^ int.from_bytes(bits[j])).bit_count(), n[i], n[j], 60)
    }

    def classes_of(edges):
        label = {s: s for s in sid}
        for a, b in edges:
            x, y = label[a], label[b]
            label = {s: x if t == y else t for s, t in label.items()}
        return {frozenset(s for s in sid if label[s] == t) for t in label.values()}

    tree = {(min(a, b), max(a, b)) for a, b in nj.forest(sid, n, bits, 60)}
    assert tree <= near and classes_of(tree) == classes_of(near)
    every = nj.across(sid, n, bits, list(range(len(sid))), 60)
    assert {(min(a, b), max(a, b)) for a, b in every} == near

"""Whitening against a plain eigendecomposition and exact whole numbers."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as ep
from fleetlens.llm import bidiagonal, whiten

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>"


def plain(rows, k=8, scale=1024, offset=100_000):
    """Brute force: {(vec_id, component): values} with free signs."""
    x = [[math.floor(scale * float(c)) + offset for c in v] for _, v in rows]
    n, dim = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(dim)]
    y = np.array([[(n * r[j] - sums[j]) / n for j in range(dim)] for r in x])
    e, q = np.linalg.eigh(y.T @ y / n)
    e, q = e[::-1], q[:, ::-1]
    dev = [sum((n * r[j] - sums[j]) ** 2 for j in range(dim)) for r in x]
    return n, dev, y @ q[:, :k] / np.sqrt(np.maximum(e[:k], 1e-30)), e[:k] / e.sum()


def check(got, rows, k=8):
    n, dev, white, share = plain(rows, k)
    k = white.shape[1]
    assert len(got) == n * k
    by = {(r.vec_id, r.component): r for r in got}
    w = np.array([[by[i, c + 1].whitened for c in range(k)] for i, _ in rows])
    signs = np.sign((w * white).sum(axis=0))
    assert np.abs(w * signs - white).max() < 1e-6
    for (i, _), d in zip(rows, dev):
        assert {by[i, c + 1].deviation for c in range(k)} == {d} and by[i, 1].n == n
    assert np.allclose([by[rows[0][0], c + 1].explained for c in range(k)], share, rtol=1e-8)
    assert {r.identity_error for r in got} == {by[rows[0][0], 1].identity_error}
    cov = np.cov(w.T, bias=True) - np.eye(k)
    assert by[rows[0][0], 1].identity_error < 1e-9 and np.abs(cov).max() < 1e-9


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    check(ep.queries()["op13_embedding_whitening"](spark, SMALL).collect(), rows)


def test_many_partitions_and_blocks_merge_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(whiten, "BLOCK", 7)
    rng = np.random.default_rng(2)
    mix = rng.standard_normal((12, 12))
    rows = [(i, (rng.standard_normal(12) @ mix + 50).tolist()) for i in range(900)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(300)
    check(whiten.whitened_rows(df).collect(), rows)


def test_awkward_rows(spark):
    rng = np.random.default_rng(3)
    good = [(i, rng.standard_normal(3).tolist()) for i in range(40)]
    inf, nan = float("inf"), float("nan")
    bad = [(900, None), (901, []), (902, [1.0, None, 2.0]), (903, [nan, 0.0, 0.0]), (904, [0.0, -inf, 1.0]),
           (905, [1.0, 2.0]), (906, [1e300, 0.0, 0.0]), (None, None)]
    df = spark.createDataFrame(good + bad, SCHEMA).selectExpr("*", "'z' AS id", "1 AS state", "2 AS n", "3 AS component")
    check(whiten.whitened_rows(df).collect(), good, 3)
    assert whiten.whitened_rows(df.filter("vec_id >= 900")).count() == 2  # the two numbers of 905, its dimension
    assert whiten.whitened_rows(df.limit(0)).count() == 0
    assert whiten.whitened_rows(df.filter("vec_id = 900")).count() == 0


def test_components_without_variance(spark):
    rows = [(i, [float(i), 2.0 * i, 7.0]) for i in range(9)] + [(None, [3.0, 6.0, 7.0]), (3, [3.0, 6.0, 7.0])]
    got = whiten.whitened_rows(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 33
    assert all((r.whitened is None) == (r.component > 1) for r in got)
    assert {round(r.explained, 12) for r in got if r.component == 1} == {1.0}
    assert {r.explained for r in got if r.component > 1} == {0.0}
    one = whiten.whitened_rows(spark.createDataFrame([(1, [1.0, 2.0])], SCHEMA)).collect()
    assert [(r.whitened, r.explained, r.identity_error, r.deviation) for r in one] == [(None, 0.0, 0.0, 0)] * 2


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(i) * 2.0**40, 1.0 + i % 3]) for i in range(20)]
    got = whiten.whitened_rows(spark.createDataFrame(rows, SCHEMA)).collect()
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows]
    sums = [sum(r[j] for r in x) for j in range(2)]
    for r in got:
        want = sum((20 * x[r.vec_id][j] - sums[j]) ** 2 for j in range(2))
        assert r.deviation == (want if want < 1 << 63 else None)


def test_equal_eigenvalues_give_orthogonal_axes(spark):
    eye = np.eye(10)
    rows = [(i, v.tolist()) for i, v in enumerate(np.vstack([eye, -eye]))]
    got = whiten.whitened_rows(spark.createDataFrame(rows, SCHEMA)).collect()
    w = np.zeros((20, 8))
    for r in got:
        w[r.vec_id, r.component - 1] = r.whitened
    assert np.abs(np.cov(w.T, bias=True) - np.eye(8)).max() < 1e-9
    assert max(r.identity_error for r in got) < 1e-9
    assert np.allclose([r.explained for r in got], 0.1)


@pytest.mark.parametrize("kind", ["normal", "graded", "rank 3", "flat", "copies", "two rows"])
def test_solver_against_svd(kind):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((200, 24))
    x = {
        "normal": x, "graded": x * np.logspace(0, -8, 24), "rank 3": x[:, :3] @ rng.standard_normal((3, 24)),
        "flat": np.linalg.qr(x)[0], "copies": np.hstack([x[:, :8]] * 3), "two rows": x[:2],
    }[kind]
    r = whiten._triangle(x - x.mean(axis=0))
    values, axes = bidiagonal.principal_axes(r, 8)
    want = np.linalg.svd(r, compute_uv=False) ** 2
    assert np.abs(values - want).max() <= 1e-12 * want[0]
    assert np.abs(r.T @ (r @ axes) - axes * values[:8]).max() <= 1e-12 * want[0]
    assert np.abs(axes.T @ axes - np.eye(8)).max() < 1e-10


def test_small_values_are_accurate_in_themselves():
    """dqds: relative accuracy of every value, not only against the largest."""
    a, b = np.logspace(0, -12, 13), np.full(12, 1e-9) * np.logspace(0, -12, 12)
    got = bidiagonal.squared_singular_values(a, b)
    assert np.allclose(np.sqrt(got), a, rtol=1e-6)
    assert got.min() > 0


def test_result_keeps_the_id_type(spark):
    df = spark.createDataFrame([(str(i), [float(i % 3), float(i)]) for i in range(6)], "vec_id string, embedding array<float>")
    got = whiten.whitened_rows(df)
    assert dict(got.dtypes)["vec_id"] == "string" and got.agg(F.count("*")).first()[0] == 12

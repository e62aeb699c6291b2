"""Embedding whitening by a bidiagonal qd solver.

1. Every task cuts its vectors into blocks, centres a block on its own mean and
   reduces it to the triangle R of a QR factorisation. Two blocks meet as
   [R1; R2; sqrt(n1 n2 / (n1 + n2)) (m1 - m2)], factored again: the triangle
   of all rows centred on their common mean, without a second pass. Counts and
   sums are kept as whole numbers, so the means differ by no rounding.
2. The triangles of the tasks, one small row each, are merged ``FAN`` at a time
   in a tree; each level is a table in the shared folder.
3. The last triangle (dimension x dimension, whatever the rows) is made
   bidiagonal by Householder reflections; dqds gives its singular values,
   twisted factorisations the leading directions (``bidiagonal``).
4. A pass over the rows gathers the covariance of the whitened values, merged
   in the same tree, for ``identity_error``; another gives the rows.

An entry c becomes x = floor(1024 c) + 100000. All results are about x.

Rows: null vectors, empty ones and those with a null, a NaN, an infinity or an
entry of 2^50 or more (no x of 60 bits) are dropped. Vectors of another length
than the most frequent one (of equally frequent ones the longest) are dropped
too. A null vec_id stays; repeated rows count each time. A component without
variance has ``whitened`` null and ``explained`` 0; it is not part of
``identity_error``, which is 0 where no component has variance. A deviation
beyond 64 bits is null. An empty table gives an empty result; extra columns
are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from .bidiagonal import EPS, principal_axes
from .common import pick, written

BLOCK = 4096  # rows of a block
FAN = 16  # partial results merged by one step of a task
LIMIT = float(1 << 50)
I63 = 1 << 62


@dataclass(frozen=True)
class Params:
    components: int = 8
    scale: int = 1024
    offset: int = 100_000


@dataclass
class Model:
    """What a fit gives: rows, sums, axes (columns), eigenvalues of the
    covariance, falling, and its trace."""

    n: int
    sums: list[int]
    axes: np.ndarray
    values: np.ndarray
    trace: float


def integers(column: pa.Array, dim: int, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """(rows that remain, their x as int64)."""
    sizes = pc.fill_null(pc.list_value_length(column), -1).to_numpy()
    at = np.flatnonzero(sizes == dim)
    flat = column.take(pa.array(at)).flatten().cast(pa.float64())
    c = flat.to_numpy(zero_copy_only=False).reshape(len(at), dim)
    with np.errstate(invalid="ignore"):
        ok = (np.abs(c) < LIMIT).all(axis=1)  # false for null (NaN) and infinite entries, too
    return at[ok], np.floor(p.scale * c[ok]).astype(np.int64) + p.offset


def _sums(x: np.ndarray) -> np.ndarray:
    """Exact column sums as Python numbers."""
    high, low = (x >> 31).sum(axis=0), (x & 0x7FFFFFFF).sum(axis=0)
    return (high.astype(object) << 31) + low.astype(object)


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - sums, exact: int64 where that holds it, Python numbers elsewhere."""
    top = n * max(int(np.abs(x).max(initial=0)), 1) + max(abs(int(s)) for s in sums)
    if top < I63:
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums


def _triangle(m: np.ndarray) -> np.ndarray:
    """R of a QR factorisation, square."""
    r = np.linalg.qr(m, mode="r")
    return np.vstack([r, np.zeros((m.shape[1] - len(r), m.shape[1]))]) if len(r) < m.shape[1] else r


def block_state(x: np.ndarray) -> tuple:
    """(rows, sums, triangle of the centred rows)."""
    sums = _sums(x)
    return len(x), sums, _triangle(_deviations(x, len(x), sums).astype(float) / len(x))


def merge_states(a: tuple, b: tuple) -> tuple:
    (n, s, r), (m, t, q) = a, b
    apart = (s * m - t * n).astype(float) / np.sqrt(float(n) * m * (n + m))
    return n + m, s + t, _triangle(np.vstack([r, q, apart[None, :]]))


def merge_moments(a: tuple, b: tuple) -> tuple:
    """(rows, means, centred cross products) of two parts together."""
    (n, mean, m2), (m, other, o2) = a, b
    d = other - mean
    return n + m, mean + d * (m / (n + m)), m2 + o2 + np.outer(d, d) * (n * m / (n + m))


def _partials(df: DataFrame, block: Callable, merge: Callable, dim: int, p: Params) -> DataFrame:
    """One (id, state) row for each task that has rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        state = None
        for b in batches:
            _, x = integers(b.column("embedding"), dim, p)
            for i in range(0, len(x), BLOCK):
                own = block(x[i : i + BLOCK])
                state = own if state is None else merge(state, own)
        if state is not None:
            yield _state_row(TaskContext.get().partitionId(), state)

    return df.mapInArrow(run, "id long, state binary")


def _state_row(i: int, state: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([pickle.dumps(state)], pa.binary())], names=["id", "state"])


def _merged(merge: Callable):
    """Rows sorted by id -> one row for each ``FAN`` ids; holds one state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for b in batches:
            for i, raw in zip(b.column("id").to_pylist(), b.column("state").to_pylist()):
                if i // FAN != now and state is not None:
                    yield _state_row(now, state)
                    state = None
                now, own = i // FAN, pickle.loads(raw)
                state = own if state is None else merge(state, own)
        if state is not None:
            yield _state_row(now, state)

    return run


def tree(partials: DataFrame, merge: Callable, name: str) -> tuple | None:
    """All states as one; levels of ``FAN``, each a written table. Only the
    last state, whose size the rows do not change, reaches the driver."""
    level = written(partials, name)
    while True:
        most = level.agg(F.max("id")).first()[0]
        if most is None:
            return None
        if most < FAN:
            states = [pickle.loads(r["state"]) for r in level.orderBy("id").collect()]  # FAN rows at most
            return reduce(merge, states)
        home = F.expr(f"id div {FAN}")
        groups = level.repartition(max(1, (most + 1) // FAN), home).sortWithinPartitions("id")
        level = written(groups.mapInArrow(_merged(merge), "id long, state binary"), name)


def dimension(vectors: DataFrame) -> int | None:
    """The most frequent length of vectors without null or non-finite entries."""
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= F.lit(LIMIT))
    fine = vectors.filter("size(embedding) > 0").filter(~F.exists("embedding", lambda c: bad(c.cast("double"))))
    sizes = fine.groupBy(F.size("embedding").alias("size")).count()
    top = sizes.orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    return top[0]["size"] if top else None


def fit(df: DataFrame, p: Params = Params()) -> Model | None:
    """The whitening of ``df`` (embedding); None where no row remains."""
    vectors = pick(df, embedding="embedding")
    dim = dimension(vectors)
    if dim is None:
        return None
    n, sums, r = tree(_partials(vectors, block_state, merge_states, dim, p), merge_states, "triangles")
    values, axes = principal_axes(r, p.components)
    values = np.where(values > (dim * EPS) ** 2 * values[0], values, 0.0) / n
    return Model(n, [int(s) for s in sums], axes, values, float((r * r).sum()) / n)


def _whitened(x: np.ndarray, m: Model) -> tuple[np.ndarray, np.ndarray]:
    """(n x - S, whitened values of the components with variance)."""
    d = _deviations(x, m.n, np.array(m.sums, object))
    used = int((m.values[: m.axes.shape[1]] > 0).sum())
    return d, (d.astype(float) / m.n) @ (m.axes[:, :used] / np.sqrt(m.values[:used]))


def identity_error(df: DataFrame, m: Model, p: Params = Params()) -> float:
    """Largest absolute entry of the whitened values' covariance minus the
    identity, over the rows of ``df`` that remain."""

    def moments(x: np.ndarray) -> tuple:
        w = _whitened(x, m)[1]
        mean = w.mean(axis=0)
        return len(w), mean, (w - mean).T @ (w - mean)

    got = tree(_partials(pick(df, embedding="embedding"), moments, merge_moments, len(m.sums), p), merge_moments, "moments")
    return float(np.abs(got[2] / got[0] - np.eye(len(got[1]))).max(initial=0.0))


def _exact_squares(d: np.ndarray) -> pa.Array:
    """Row sums of squares as int64; null beyond 64 bits."""
    if d.dtype != object:
        top = np.abs(d).max(axis=1, initial=0).astype(float)
        if (top * top * d.shape[1] < 9.2e18).all():
            return pa.array((d * d).sum(axis=1), pa.int64())
        d = d.astype(object)
    sums = (d * d).sum(axis=1)
    return pa.array([int(s) if s < 1 << 63 else None for s in sums], pa.int64())


def transform(df: DataFrame, m: Model, error: float, p: Params = Params()) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a
    row for each remaining row of ``df`` and component."""
    vectors = pick(df, vec_id="vec_id", embedding="embedding")
    count, dim = m.axes.shape[1], len(m.sums)
    share = m.values[:count] / m.trace if m.trace > 0 else np.zeros(count)
    schema = _schema(df)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, x = integers(b.column("embedding"), dim, p)
            d, w = _whitened(x, m)
            rows, used = len(at), w.shape[1]
            white = np.zeros((rows, count))
            white[:, :used] = w
            none = np.zeros((rows, count), bool)
            none[:, used:] = True
            each = pa.array(np.repeat(np.arange(rows), count))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("vec_id").take(pa.array(np.repeat(at, count))),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * count, m.n, np.int64)),
                    _exact_squares(d).take(each),
                    pa.array(white.ravel(), mask=none.ravel()),
                    pa.array(np.tile(share, rows)),
                    pa.array(np.full(rows * count, error)),
                ],
                names=schema.names,
            )

    return vectors.mapInArrow(run, schema)


def _schema(df: DataFrame) -> StructType:
    kinds = {"component": IntegerType(), "n": LongType(), "deviation": LongType(), "whitened": DoubleType(),
             "explained": DoubleType(), "identity_error": DoubleType()}
    return StructType([StructField("vec_id", df.schema["vec_id"].dataType), *(StructField(k, t) for k, t in kinds.items())])


def whitened_rows(df: DataFrame, p: Params = Params()) -> DataFrame:
    """Fit on ``df`` and transform it."""
    model = fit(df, p)
    if model is None:
        return df.sparkSession.createDataFrame([], _schema(df))
    return transform(df, model, identity_error(df, model, p), p)

"""Order MinHash fingerprints of documents.

A text's k-mers (code points) are numbered by occurrence, so a k-mer that
comes three times gives three different elements. Each of ``sketches``
permutations selects its ``take`` smallest elements, puts them back in text
order and hashes the tuple of their k-mers. Two texts agree on an entry when
the same k-mers were selected *in the same order*; the share of equal entries
estimates a similarity that, unlike Jaccard's, falls when passages move, and so
follows edit distance.

Every sketch has an order of its own, by the product of an element and the
sketch's random odd number. Few elements can be among the smallest:
those under a threshold that about ``under`` elements of a text pass are looked
at, for all sketches at once; a sketch that has fewer than ``take`` of them
looks at all. k-mer hashes are polynomials, numbered with a second sort. Memory
is a few arrays of the longest single text, or of 2^18 values.

Rows: null text counts as empty; a text shorter than ``k`` has itself as its
only k-mer; equal texts have equal fingerprints. Null ids come first, equal ids
by text; the last row is followed by the first; an empty table gives an empty
result; other input columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import pick
from .neighbours import AHEAD, RANGE, ranged, runs


@dataclass(frozen=True)
class Params:
    k: int = 12
    take: int = 2
    sketches: int = 48
    seed: int = 7
    under: int = 12  # elements of a text that pass a sketch's threshold, on average


CELLS = 1 << 18  # values of elements and sketches held at a time
ROWS_PER_RANGE = 20_000
U = np.uint64
MIX1, MIX2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)  # splitmix64 finaliser


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * MIX1
    x = (x ^ (x >> U(27))) * MIX2
    return x ^ (x >> U(31))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def kmer_hashes(points: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of the k-mers, in text order (one for a shorter text)."""
    k = min(k, len(points))
    base = 0x9E3779B97F4A7C15
    with np.errstate(over="ignore"):
        # polynomials of 1, 2, 4, ... points, joined to one of k
        parts = {1: _mix(points.astype(U) + U(1))}
        size = 1
        while 2 * size <= k:
            one = parts[size]
            parts[2 * size] = one[:-size] * U(pow(base, size, 1 << 64)) + one[size:]
            size *= 2
        h, length = parts[size], size
        while length < k:
            size = 1 << ((k - length).bit_length() - 1)
            tail = parts[size][length:]
            h = h[: len(tail)] * U(pow(base, size, 1 << 64)) + tail
            length += size
        return _mix(h ^ U(k))


def occurrences(h: np.ndarray) -> np.ndarray:
    """How many equal values stand before each one."""
    ordered = np.sort(h)
    if not (ordered[1:] == ordered[:-1]).any():
        return np.zeros(len(h), U)
    by = np.argsort(h, kind="stable")
    s = h[by]
    start = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    rank = np.arange(len(h)) - np.repeat(start, np.diff(np.append(start, len(h))))
    out = np.empty(len(h), U)
    out[by] = rank
    return out


def signature(points: np.ndarray, p: Params = Params()) -> np.ndarray:
    """``sketches`` 32-bit entries; all zero for an empty text."""
    out = np.zeros(p.sketches, np.uint32)
    if not len(points):
        return out
    h = kmer_hashes(points, p.k)
    factors = _factors(p.seed, p.sketches)
    with np.errstate(over="ignore"):
        element = _mix(h + occurrences(h) * U(0xD6E8FEB86659FD93))
        take = min(p.take, len(h))
        group = max(1, CELLS // len(h))
        at = np.concatenate([_smallest(element, factors[i : i + group], take, p.under) for i in range(0, p.sketches, group)])
        at.sort(axis=1)  # back to text order
        tuples = np.arange(p.sketches, dtype=U)
        for j in range(take):
            tuples = tuples * U(0x9E3779B97F4A7C15) + h[at[:, j]]
        return (_mix(tuples) >> U(32)).astype(np.uint32)


@lru_cache
def _factors(seed: int, sketches: int) -> np.ndarray:
    """A random odd number for each sketch."""
    return np.random.default_rng(seed).integers(0, 1 << 63, size=sketches, dtype=np.int64).astype(U) << U(1) | U(1)


_SPACE = {"values": np.empty(0, np.uint32), "hits": np.empty(0, bool)}  # used again for every text


def _smallest(element: np.ndarray, factors: np.ndarray, take: int, under: int) -> np.ndarray:
    """(sketches, take) places of each order's smallest elements. An order
    compares the products of 32 bits first, then those of 64."""
    n = len(element)
    high = (element >> U(32)).astype(np.uint32)
    m = len(factors) * n
    if m > len(_SPACE["values"]):
        _SPACE.update(values=np.empty(2 * m, np.uint32), hits=np.zeros(2 * m + 8, bool))
    values, hits = _SPACE["values"][:m], _SPACE["hits"][: -(-m // 8) * 8]
    odd = (factors >> U(32) | U(1)).astype(np.uint32)
    np.multiply(high[None, :], odd[:, None], out=values.reshape(len(factors), n))
    if n > 2 * under:
        np.less(values, np.uint32((under << 32) // n), out=hits[:m])
        hits[m:] = False
        eight = np.flatnonzero(hits.view(U))  # eight cells a word, most without a hit
        hit = np.flatnonzero(hits.reshape(-1, 8)[eight].ravel())
        cell = 8 * eight[hit >> 3] + (hit & 7)
    else:
        cell = np.arange(m)
    sketch = cell // n
    place = cell - sketch * n
    found = np.bincount(sketch, minlength=len(factors))
    order = np.lexsort((element[place] * factors[sketch], values[cell], sketch))  # stable: equal values in text order
    first = np.cumsum(found) - found
    chosen = np.minimum(first[:, None] + np.arange(take), max(len(cell) - 1, 0))
    at = place[order][chosen] if len(cell) else np.zeros((len(factors), take), np.int64)
    for s in np.flatnonzero(found < take).tolist():
        at[s] = np.lexsort((element * factors[s], values[s * n : (s + 1) * n]))[:take]
    return at


def hexed(sig: np.ndarray) -> str:
    return sig.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def fingerprints(df: DataFrame, text_col: str = "text", p: Params = Params()) -> DataFrame:
    """``df`` with a ``fingerprint`` column (hex) of its whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [hexed(signature(code_points(t or ""), p)) for t in b.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(out, pa.string())], names=[*b.schema.names, "fingerprint"]
            )

    fields = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)
    return df.mapInArrow(run, f"{fields}, fingerprint string")


OUT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _edited_pairs(p: Params):
    """Sorted runs of documents -> each beside its edited text and successor."""

    def finish(doc: tuple, after: tuple) -> tuple:
        doc_id, text, points, sig = doc
        n = len(points)
        cut = n // 4
        taken = after[2][:cut]
        edited = np.concatenate([points[: n - cut], taken])
        edited_sig = signature(edited, p) if cut else sig
        raw = edited.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        sha = hashlib.sha256(raw.encode("utf-8", "surrogatepass")).hexdigest()
        return (
            doc_id, n, sha, hexed(sig), hexed(edited_sig),
            likeness(sig, edited_sig), likeness(sig, after[3]),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_range = None, None
        for b in batches:
            rows = []
            cols = [b.column(c).to_pylist() for c in (RANGE, AHEAD, "doc_id", "text")]
            for at, ahead, doc_id, text in zip(*cols):
                if held_range != at:
                    held, held_range = None, at
                if ahead and held is None:
                    continue
                points = code_points(text or "")
                doc = (doc_id, text, points, signature(points, p))
                if held is not None:
                    rows.append(finish(held, doc))
                held = None if ahead else doc
            names = [x.split()[0] for x in OUT.split(", ")]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            cells = zip(*rows) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds)], names=names)

    return run


def edited_neighbours(df: DataFrame, p: Params = Params()) -> DataFrame:
    """Each document's fingerprint against that of its edited text (the last
    quarter of the code points replaced by the start of the next document's)
    and against the next document's."""
    docs = pick(df, doc_id="doc_id", text="text")
    spark = df.sparkSession
    least = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(least, -(-docs.count() // ROWS_PER_RANGE))
    rows, _ = ranged(docs, "doc_id", ranges)
    return runs(rows, "doc_id", "text").mapInArrow(_edited_pairs(p), OUT)
